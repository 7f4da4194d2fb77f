"""Every opN query against its SQL or a plain version, on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import plain
from conftest import SF_SMALL
from keyfold.llm import op7_pack, op10_secrets
from keyfold.llm.queries import ORACLE, QUERIES, secret_models


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v
                               for v in r)
                         for r in df[cols].astype(object).itertuples(index=False, name=None)),
                        key=repr)


def test_names_and_docs():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert all(f.__doc__ for f in QUERIES.values()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    got = rows(QUERIES[name](spark, SF_SMALL).toPandas())
    want = rows(con.execute(ORACLE[name]).df())
    assert got[0] == want[0]
    assert got == want


def test_decontamination(spark, con, docs):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_decontamination"](spark, SF_SMALL).collect()}
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    want = {(docs[n][0], i) for n, i in plain.leaks([t for _, t, _ in docs], items)}
    assert got == want and got


def test_mix_comes_near_its_targets(spark):
    out = QUERIES["op6_mix"](spark, SF_SMALL.replace("0.001", "0.01")).toPandas()
    src = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet") \
        .select("doc_id", "source").toPandas()
    for _, g in out.merge(src, on="doc_id").groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1.5 * g["size"].max()
        assert (g.taken <= 3 * g["size"]).all()
    again = QUERIES["op6_mix"](spark, SF_SMALL.replace("0.001", "0.01")).toPandas()
    assert rows(again) == rows(out)


def test_packing_round_trip(spark, docs):
    out = QUERIES["op7_packing"](spark, SF_SMALL)
    back = {r.doc: r.text for r in op7_pack.unpack(out).collect()}
    assert back == {i: t or "" for i, t, _ in docs}
    for r in out.collect():
        ids, pos = np.frombuffer(r.ids, "<i4"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == len(pos) == op7_pack.LENGTH and r.lengths[-1] == r.n_tokens
        for a, b in zip(r.lengths, r.lengths[1:]):
            assert (pos[a:b] == np.arange(b - a)).all()


def test_quotes_keep_every_message(spark, con):
    got = sorted((r.conv_id, r.position, r.turn, r.role, r.text) for r in
                 QUERIES["op8_quotes"](spark, SF_SMALL).collect())
    # no message of the test tables quotes another: reply order is turn order
    want = con.execute("""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn),
        turn, role, text FROM conversations ORDER BY 1, 2""").fetchall()
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == [w[4].strip("\n") for w in want]


def test_simhash(spark, docs):
    fps = [plain.simhash(t) for _, t, _ in docs]
    want = {d[0]: (f"{f:016x}", docs[c][0]) for d, f, c in zip(docs, fps, plain.components(fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in
           QUERIES["op9_simhash"](spark, SF_SMALL).collect()}
    assert got == want


def test_secret_scan(spark, docs):
    import hashlib
    for r in QUERIES["op10_secret_scan"](spark, SF_SMALL).collect():
        text = next(t for i, t, _ in docs if i == r.doc_id)
        base = plain.base_spans(text)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b[1] == k for b in base) for k in range(3)]
        joined = ",".join(f"{op10_secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_secret_models_find_held_out_strings(spark, docs):
    import pkgutil
    import random
    import string
    rng = random.Random(77)
    ratio = secret_models(spark, SF_SMALL)

    def flagged(values):
        return np.mean([op10_secrets.score(v, ratio) >= op10_secrets.MARGIN for v in values])

    low, alnum = string.ascii_lowercase + string.digits, string.ascii_letters + string.digits
    for prefix, letters, least in [
            ("", "0123456789abcdef", 0.9), ("", string.ascii_uppercase + "234567", 0.9), ("", low, 0.9),
            ("", alnum, 0.95), ("", alnum + "+/", 0.95), ("", alnum + "-_", 0.95),
            ("ghp_", alnum, 0.95), ("sk_live_", alnum, 0.95)]:
        n = 36 if prefix else rng.randrange(20, 41)
        got = flagged([prefix + "".join(rng.choices(letters, k=n)) for _ in range(400)])
        assert got >= least, (prefix, letters, got)
    # ordinary: names of the standard library, and what the documents hold
    names = {n for m in ("os", "logging", "unittest.mock", "socket", "ssl", "signal", "errno", "ast",
                         "http.client", "email.message", "argparse", "asyncio", "threading")
             for n in dir(pkgutil.resolve_name(m)) if len(n) >= op10_secrets.SHORTEST}
    assert len(names) > 100 and flagged(names) <= 0.02
    free = [t for _, x, _ in docs for _, _, t in
            op10_secrets._free_tokens(x or "", op10_secrets.base_spans(x or ""), op10_secrets.SHORTEST)]
    assert free and flagged(free) <= 0.02


def test_secrets_of_a_corpus_are_not_learnt_as_ordinary(spark):
    import random
    rng = random.Random(5)
    tokens = ["".join(rng.choices(op10_secrets.ALPHABET[:62], k=32)) for _ in range(500)]
    df = spark.createDataFrame([(f"the key {t} is here",) for t in tokens], "text string")
    ratio = op10_secrets.train(op10_secrets.count_labelled(op10_secrets.samples(spark)),
                               op10_secrets.count_words(df))
    assert np.mean([r.n_markov for r in op10_secrets.scan(df.selectExpr("1 doc_id", "text"), ratio)
                    .collect()]) >= 0.95


def test_word_pairs_of_odd_texts():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("ab1_ é\n="), 5000)) + " password=hunter22 AKIA" + "Z" * 16 + "x y"
    want = np.zeros(op10_secrets.STATES ** 2, dtype="i8")
    spans = op10_secrets.base_spans(text)
    for a, b, t in op10_secrets._free_tokens(text, spans, 1):
        if b - a < op10_secrets.SHORTEST:
            np.add.at(want, op10_secrets.pairs_of(t), 1)
    assert (op10_secrets.word_pairs(text) == want).all() and not op10_secrets.word_pairs("").any()
    keep, op10_secrets.PIECE = op10_secrets.PIECE, 7
    try:
        assert (op10_secrets.word_pairs(text) == want).all()
    finally:
        op10_secrets.PIECE = keep
