import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, lines_df
from fixtures import OTHER_NAMES, WORD_COUNTS
from keyfold.operators.aggregate import group_count, top_group
from keyfold.operators.sessions import session_windows
from keyfold.operators.window_change import large_delta, window_change, window_stats
from keyfold.operators.windows import sliding, tumbling, window_top


def test_prefix_word_count_golden(spark):
    words = [w for w, n in WORD_COUNTS.items() for _ in range(n)] + OTHER_NAMES * 3
    random.Random(3).shuffle(words)
    df = lines_df(spark, words).filter(F.col("value").startswith("N"))
    got = {r.value: r.n for r in group_count(df, "value", "n").collect()}
    assert got == WORD_COUNTS


def test_top_group_ties_smallest_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "k string, t long")
    assert tuple(top_group(df, "k", "t").first()) == ("a", 5)
    assert tuple(top_group(df, "k", "t", largest=False).first()) == ("c", 1)


def _sessions_brute(ts_list, gap):
    ts_list = sorted(ts_list)
    out, start, last, n = [], None, None, 0
    for t in ts_list:
        if last is None or t - last > gap:
            if last is not None:
                out.append((start, last + gap, n))
            start, n = t, 0
        last, n = t, n + 1
    out.append((start, last + gap, n))
    return out


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_global_sessions_match_brute_force(spark, parts):
    rnd = random.Random(parts)
    base = datetime(2024, 1, 1)
    ts = []
    t = base
    for i in range(400):
        t += timedelta(seconds=rnd.choice([1, 5, 30, 599, 600, 601, 3000]))
        ts.append(t)
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(ts)],
                               "seq long, ts timestamp_ntz, v long")
    got = session_windows(df, "ts", "10 minutes", "v", "seq", partitions=parts)
    got = sorted((r.session_start, r.session_end, r.n) for r in got.collect())
    assert got == _sessions_brute(ts, timedelta(minutes=10))


def test_session_gap_edges(spark):
    # gaps of 9,999 / 10,000 / 10,001 ms with a 10 s gap: merge, merge, split
    ms = [0, 9_999, 19_999, 30_000]
    df = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(milliseconds=m), 5)
                                for i, m in enumerate(ms)], "seq long, ts timestamp_ntz, v long")
    got = sorted((r.n, r.total) for r in session_windows(df, "ts", "10 seconds", "v", "seq", partitions=2).collect())
    assert got == [(1, 5), (3, 15)]


def test_keyed_sessions(spark):
    rows = [(0, "a", 0), (1, "b", 5), (2, "a", 30), (3, "a", 100), (4, "b", 200)]
    df = spark.createDataFrame([(i, k, datetime(2024, 1, 1) + timedelta(seconds=s), 1)
                                for i, k, s in rows], "seq long, k string, ts timestamp_ntz, v long")
    got = sorted((r.k, r.n) for r in session_windows(df, "ts", "1 minute", "v", "seq", key="k", partitions=3).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1), ("b", 1)]


def test_tumbling_and_sliding_counts(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    n = ev.count()
    t = tumbling(ev, "ts", "1 day", "event_type", [F.count(F.lit(1)).alias("n")])
    assert t.agg(F.sum("n")).first()[0] == n
    s = sliding(ev, "ts", "2 days", "1 day", "event_type", [F.count(F.lit(1)).alias("n")])
    assert s.agg(F.sum("n")).first()[0] == 2 * n
    top = window_top(t, "event_type", "n")
    assert top.count() == t.select("window_start").distinct().count()


def _trades(spark):
    # three 5-minute windows with data, an empty one between the 2nd and 3rd
    rows = [("06/10/2010", "08:00:00", 100.0, 10), ("06/10/2010", "08:03:00", 99.0, 12),
            ("06/10/2010", "08:06:00", 102.0, 9), ("06/10/2010", "08:07:00", 102.0, 20),
            ("06/10/2010", "08:16:00", 93.84, 5)]
    lines = [f"{d},{t},{p},{v}" for d, t, p, v in rows] + ["99/99/2010,08:00:00,1.0,1"]
    from keyfold.functions.parse import parse_trade
    good, bad = parse_trade(lines_df(spark, lines))
    assert bad.count() == 1
    return good


def test_window_stats_change_and_alert(spark):
    tr = _trades(spark)
    stamp = F.concat_ws(":", "date", "time")
    st = window_stats(tr, "ts", "5 minutes", "symbol", "seq", "price", "volume", stamp)
    ch = window_change(st, "symbol").orderBy("window_start").collect()
    assert [r.max_price for r in ch] == [100.0, 102.0, 93.84]
    assert [r.first_stamp for r in ch][1] == "06/10/2010:08:06:00"
    assert [r.last_stamp for r in ch][1] == "06/10/2010:08:07:00"
    assert ch[0].price_change_pct == 0.0
    assert round(ch[1].price_change_pct, 6) == 2.0
    assert round(ch[2].price_change_pct, 6) == -8.0
    al = large_delta(tr, "ts", "5 minutes", "symbol", "seq", "price", stamp, 5.0).collect()
    assert len(al) == 1 and round(al[0].change_pct, 6) == -8.0
    assert (al[0].prev_max, al[0].cur_max, al[0].max_stamp) == (102.0, 93.84, "06/10/2010:08:16:00")
    # max first reached at 08:06 in the second window (tie at 08:07)
    al2 = large_delta(tr, "ts", "5 minutes", "symbol", "seq", "price", stamp, 1.0) \
        .orderBy("window_start").collect()
    assert al2[0].max_stamp == "06/10/2010:08:06:00"
