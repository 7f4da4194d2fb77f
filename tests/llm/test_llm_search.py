"""Ranked search against a plain version, at any size of block and bundle."""

import math
import random
import re

import pytest

from keyfold.llm import op11_search as op11


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def plain(docs, items, top=10):
    found = [re.findall(op11.TERM, lower(t or "")) for _, t in docs]
    held = [x for x in found if x]
    n, length = len(held), sum(map(len, held))
    out = []
    for item, text in dict.fromkeys(items):
        score = {}
        for term in set(re.findall(op11.TERM, lower(text or ""))):
            df = sum(term in x for x in found)
            w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
            for d, x in enumerate(found):
                tf = x.count(term)
                if tf:
                    m = 10 + 90 * len(x) * n // length
                    score[d] = score.get(d, 0) + w * (10 ** 9 * tf // (1000 * tf + 8 * m))
        best = sorted((-s, docs[d][0] is None, docs[d][0], d) for d, s in score.items() if s > 0)[:top]
        out += [(item, r, i, -s) for r, (s, _, i, _) in enumerate(best, 1)]
    return sorted(out, key=repr)


def searched(out):
    return sorted(map(tuple, out.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("block,bundle,owners,parts", [
    (4096, 256, op11.OWNERS, 3), (7, 3, (0.02, 0.1, 0.3), 2), (30, 256, (0.05,), 1), (5, 2, (), 4)])
def test_ranks_by_brute_force(spark, monkeypatch, block, bundle, owners, parts):
    for k, v in (("BLOCK", block), ("BUNDLE", bundle), ("OWNERS", owners)):
        monkeypatch.setattr(op11, k, v)
    rng = random.Random(block)
    words = [f"w{i}" for i in range(60)] + ["Der", "ÉTÉ", "naïve", "x1", "日本"]
    pick = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, pick(rng.randrange(1, 40))) for i in range(120)]
    docs += [(500 + i, docs[3][1]) for i in range(40)] + [(3, docs[3][1])] * 3  # copies and repeated rows
    docs += [(700, None), (701, ""), (702, "--- !!"), (None, pick(9)), (None, pick(9)), (3, pick(5))]
    items = [(i, pick(rng.randrange(1, 8))) for i in range(9)]
    items += [items[0], (0, "w1 w2"), (20, None), (21, "nowhere"), (None, "w5-w7,w9"), (22, docs[3][1])]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs],
                              "doc_id long, text string, term string, score int").repartition(parts)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    assert searched(op11.rank(d, q)) == plain(docs, items)
    if bundle == 3:
        assert searched(op11.rank(d, q, top=3)) == plain(docs, items, 3)


def test_empty_tables_and_long_texts(spark):
    d = spark.createDataFrame([("b", "a b " * 100_000), ("a", "a " * 200_000 + "z" * 300_000), ("", "b")],
                              "doc_id string, text string")
    q = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert searched(op11.rank(d, q)) == plain([(r[0], r[1]) for r in d.collect()], [(1, "a b")])
    assert op11.rank(d.limit(0), q).collect() == [] and op11.rank(d, q.limit(0)).collect() == []


def test_pruning_drops_accumulators(spark):
    import numpy as np
    import pyarrow as pa
    kinds = pa.schema([("items", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())),
                       ("scores", pa.list_(pa.int64()))])
    held = pa.Table.from_pylist([{"items": [0] * 50, "docs": list(range(50)), "scores": list(range(1, 51))}], kinds)
    lists = pa.table({"docs": pa.array([[0, 49]], pa.list_(pa.int32())), "counts": pa.array([[1, 1]], pa.list_(pa.int32())),
                      "lengths": pa.array([[5, 5]], pa.list_(pa.int64())), "weight": [0],
                      "of": [[{"item": 0, "rest": 4}]]})
    _, doc, score = op11.add(held, lists, 10, 50, 10, False)
    assert doc.tolist() == list(range(36, 50))  # the tenth best is 41: 37 can still reach it
    assert np.array_equal(op11.add(held, lists, 10, 50, 10, True)[2], np.arange(50, 40, -1))
