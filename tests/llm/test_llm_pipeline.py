"""The pipeline against plain versions of its stages."""

from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline as cp
import plain
from conftest import SF_SMALL
from keyfold.llm import op7_pack
from keyfold.llm.common import written
from keyfold.llm.queries import ORACLE


def test_stages_against_plain_versions(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(f"""SELECT doc_id, text, source FROM documents JOIN
        (SELECT doc_id AS d FROM ({ORACLE['op3_quality_rules']}) WHERE kept) ON d = doc_id
        ORDER BY doc_id""").fetchall()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_SMALL), "test")
        assert docs.columns == columns
        seen.append(sorted((r.doc_id, r.text, r.source) for r in docs.collect()))
    assert seen[0] == want and len(want) < 200

    comp = plain.components([plain.simhash(t) for _, t, _ in want])
    want = [r for i, r in enumerate(want) if comp[i] == i]
    assert seen[1] == want

    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    bad = {n for n, _ in plain.leaks([t for _, t, _ in want], items)}
    want = [r for i, r in enumerate(want) if i not in bad]
    assert seen[2] == want and bad

    copies = plain.mix([(i, s, len(plain.WORD.findall(t))) for i, t, s in want])
    want = sorted(r for r, n in zip(want, copies) for _ in range(n))
    assert seen[3] == want

    got, enc = Counter(), op7_pack.encoding(op7_pack.read_ranks(spark, op7_pack.TOKENIZER))
    for r in cp.STAGES[-1][1](spark, docs, SF_SMALL).collect():
        ids = np.frombuffer(r.ids, "<i4")
        for doc, piece, x, y in zip(r.doc_ids, r.pieces, r.lengths, r.lengths[1:]):
            got[doc, piece, tuple(ids[x:y].tolist())] += 1
    expect = Counter()
    for i, t, _ in want:
        ids = [*enc.encode_ordinary(t), op7_pack.END]
        for k in range(0, len(ids), op7_pack.LENGTH):
            expect[i, k // op7_pack.LENGTH, tuple(ids[k:k + op7_pack.LENGTH])] += 1
    assert got == expect


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES], ids=[n for n, _ in cp.STAGES])
def test_stage_on_odd_rows(spark, stage):
    """Nulls, empty and long texts, repeated rows, clashing column names, no rows."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              "fp long, key string, rank long, copies int, row string, at int, w string")
    good = " ".join(f"the quick brown fox number {i} jumps over and is lazy." for i in range(12))
    odd = [(1, good, "en", "a", 1), (1, good, "en", "a", 1), (2, good, None, None, None),
           (None, None, None, None, None), (3, "", "en", "a", 0), (None, good, "en", "b", 5),
           (4, " ".join(f"word{i} the of" for i in range(40_000)), "en", "b", 7),
           (5, "\n\n  \t", "en", "", 2), (6, "x" * 300_000, "en", "a", 3)]
    more = (1, "k", 2, 3, "r", 4, "w")
    df = spark.createDataFrame([o + more for o in odd], schema)
    out = stage(spark, df, SF_SMALL)
    n = out.count()
    if out.columns != df.columns:  # the packed matrix
        assert sum(len(r.doc_ids) for r in out.collect()) >= len(odd)
    else:
        assert n <= 3 * len(odd)
    assert stage(spark, df.limit(0), SF_SMALL).count() == 0


def test_near_duplicates_keep_one_of_each_group(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve"
    df = spark.createDataFrame([(2, a), (1, a), (1, a), (None, a), (None, b), (None, b), (7, None),
                                (8, "")], "doc_id long, text string")
    got = sorted(map(tuple, cp.near_duplicates(spark, df, SF_SMALL).collect()), key=repr)
    assert got == sorted([(1, a), (None, b), (7, None)], key=repr)
