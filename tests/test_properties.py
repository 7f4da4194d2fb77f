"""Property tests: count windows and sessions against brute force on random input."""

from datetime import datetime, timedelta

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from keyfold.operators.count_window import count_chunks
from keyfold.operators.sessions import session_windows


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-9, 9)), min_size=1, max_size=80),
       st.integers(1, 7), st.sampled_from([None, 1, 4, 50]))
def test_count_chunks_brute_force(spark, rows, n, width):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, k long, v long")
    got = sorted(tuple(r) for r in count_chunks(
        df, "k", "seq", n, lambda: [F.sum("v").alias("s")], width).collect())
    exp = []
    for k in {k for _, k, _ in data}:
        vals = [v for _, kk, v in sorted(data) if kk == k]
        exp += [(k, c, sum(vals[c * n:(c + 1) * n])) for c in range(len(vals) // n)]
    assert got == sorted(exp)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.integers(1, 6),
       st.booleans())
def test_sessions_brute_force(spark, gaps, parts, keyed):
    t0 = datetime(2024, 1, 1)
    ts, t = [], t0
    for i, g in enumerate(gaps):
        t += timedelta(seconds=g)
        ts.append((i, "a" if (not keyed or i % 3) else "b", t))
    df = spark.createDataFrame([(i, k, x, 1) for i, k, x in ts],
                               "seq long, k string, ts timestamp_ntz, v long")
    got = session_windows(df, "ts", "10 seconds", "v", "seq",
                          key="k" if keyed else None, partitions=parts)
    got = sorted((r["k"] if keyed else "", r.session_start, r.n) for r in got.collect())
    exp = []
    for key in sorted({k for _, k, _ in ts} if keyed else {""}):
        pts = sorted(x for _, k, x in ts if (not keyed or k == key))
        start, last, n = pts[0], pts[0], 0
        for x in pts:
            if x - last > timedelta(seconds=10):
                exp.append((key, start, n))
                start, n = x, 0
            last, n = x, n + 1
        exp.append((key, start, n))
    assert got == sorted(exp)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 30), st.integers(1, 3)),
                min_size=1, max_size=40), st.integers(1, 5))
def test_segments_merge_brute_force(spark, segs, parts):
    from keyfold.operators.sessions import session_segments
    gap = 10_000_000  # 10 s in micros
    rows = [("", s * 1_000_000, (s + d) * 1_000_000, c, c * 2, i)
            for i, (s, d, c) in enumerate(segs)]
    df = spark.createDataFrame(rows, "skey string, t long, t2 long, c long, v long, _seq long")
    got = sorted((r.s_start, r.s_last, r.n) for r in
                 session_segments(df, "10 seconds", partitions=parts).collect())
    exp = []
    for _k, t, t2, c, _v, _i in sorted(rows, key=lambda r: (r[1], r[5])):
        if exp and t <= exp[-1][1] + gap:
            exp[-1] = (exp[-1][0], max(exp[-1][1], t2), exp[-1][2] + c)
        else:
            exp.append((t, t2, c))
    assert got == sorted(exp)
