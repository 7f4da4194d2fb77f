"""Generic scans and ordered folds against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from keyfold.operators.count_window import count_chunk_fold
from keyfold.operators.running import running_total_max
from keyfold.operators.scan import CHUNK, Fold, affine, fold_groups, scan, total_and_peak

P = 1_000_003


def _maps(n, keys, seed=1):
    rng = random.Random(seed)
    seqs = rng.sample(range(-n, 5 * n), n)
    return [(s, rng.choice(keys), rng.randrange(P), rng.randrange(P)) for s in seqs]


def _plain(rows):
    """(seq, key) -> the map so far, one after another."""
    out, state = {}, {}
    for s, k, a, b in sorted(rows):
        x, y = state.get(k, (1, 0))
        state[k] = out[s] = (x * a % P, (a * y + b) % P)
    return out


@pytest.mark.parametrize("width,levels", [(1, 3), (3, 0), (3, 1), (3, 4), (CHUNK, 1), (4096, 1)])
def test_an_order_dependent_fold(spark, width, levels):
    rows = _maps(300, ["a", "b", None])
    df = spark.createDataFrame(rows, "s long, k string, a long, b long").repartition(5)
    out = scan(df, "k", "s", affine(F.col("a"), F.col("b"), P), "f", width, levels)
    assert out.columns == ["s", "k", "a", "b", "f"]
    assert {r.s: (r.f.a, r.f.b) for r in out.collect()} == _plain(rows)


def test_no_task_holds_more_than_a_bucket_and_there_is_no_window(spark):
    df = spark.range(5000).select(F.col("id").alias("s"), F.lit("hot").alias("k"), F.lit(1).cast("long").alias("v"))
    out = running_total_max(df, "k", "s", "v", 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert [(r.run_total, r.run_max_total) for r in out.orderBy("s").collect()] == [(i, i) for i in range(1, 5001)]
    # every array is one bucket's or one group of buckets'
    sizes = df.groupBy("k", F.expr("s div 10")).count().agg(F.max("count")).first()[0]
    assert sizes == 10


def test_texts_in_order_over_several_chunks(spark):
    # longer than a chunk of the array fold, and not commutative
    n = 3 * CHUNK + 5
    df = spark.range(n).select(F.col("id").alias("s"), F.lit(1).alias("k"), F.col("id").cast("string").alias("t"))
    join = Fold(F.col("t"), lambda a, b: F.concat(a, F.lit(","), b))
    out = {r.s: r.x for r in scan(df, "k", "s", join, "x", n).collect()}
    assert all(out[i] == ",".join(map(str, range(i + 1))) for i in range(n))


def test_total_and_peak_with_nulls_as_the_plain_loop(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), rng.choice([None, rng.randrange(-9, 9)])) for i in range(200)]
    rows = [(i, k, None if i < 6 else v) for i, k, v in rows]
    df = spark.createDataFrame(rows, "s long, k string, v long")
    out = {r.s: (r.run_total, r.run_max_total) for r in running_total_max(df, "k", "s", "v", 7).collect()}
    state = {}
    for s, k, v in rows:
        t, m = state.get(k, (None, None))
        if v is not None:
            t = v if t is None else t + v
            m = t if m is None else max(m, t)
        state[k] = (t, m)
        assert out[s] == (t, m)


def test_rows_without_a_sequence_come_first(spark):
    df = spark.createDataFrame([(None, 1, 5), (3, 1, 2), (-2, 1, 1)], "s long, k int, v long")
    out = scan(df, "k", "s", total_and_peak("v"), "f", 2)
    assert sorted((r.s is not None, r.s or 0, r.f.s) for r in out.collect()) == [(False, 0, 5), (True, -2, 6), (True, 3, 8)]
    assert scan(df.limit(0), "k", "s", total_and_peak("v"), "f", 2).collect() == []


@pytest.mark.parametrize("n,width", [(1, 4), (4, 2), (7, 100), (50, 3)])
def test_chunks_folded_in_order_of_arrival(spark, n, width):
    rows = _maps(220, ["a", "b"], 5)
    df = spark.createDataFrame(rows, "s long, k string, a long, b long")
    out = count_chunk_fold(df, "k", "s", n, affine(F.col("a"), F.col("b"), P), "f", width)
    got = {(r.k, r.chunk_no): (r.f.a, r.f.b) for r in out.collect()}
    want = {}
    for k in "ab":
        own = [r for r in sorted(rows) if r[1] == k]
        for c in range(len(own) // n):
            want[k, c] = _plain([(i, "", a, b) for i, (_, _, a, b) in enumerate(own[c * n:c * n + n])])[n - 1]
    assert got == want


def test_one_fold_per_group(spark):
    rows = _maps(120, ["a", "b", None], 8)
    df = spark.createDataFrame(rows, "s long, k string, a long, b long")
    for levels in (0, 1, 3):
        out = fold_groups(df, "k", "s", affine(F.col("a"), F.col("b"), P), "f", 4, levels)
        plain = _plain(rows)
        want = {k: plain[max(s for s, q, _, _ in rows if q == k)] for k in ("a", "b", None)}
        assert {r.k: (r.f.a, r.f.b) for r in out.collect()} == want
