import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, lines_df
from fixtures import RUNNING_AVG_FIRST8, SALES_SAMPLE
from keyfold.functions.parse import parse_sales
from keyfold.operators.running import (first_occurrence_flag, run_count, run_first, run_max,
                                       run_max_by, run_min, run_min_by, run_sum, running)

WIDTHS = [None, 1, 3, 100]


def _sales(spark, lines=SALES_SAMPLE):
    good, bad = parse_sales(lines_df(spark, lines))
    assert bad.count() == 0
    return good


@pytest.mark.parametrize("width", WIDTHS)
def test_running_folds_on_sales_sample(spark, width):
    aggs = [run_sum("profit", "s"), run_count("n"), run_min("profit", "mn"),
            run_max("profit", "mx"),
            run_min_by("profit", "seq", ["category", "product"], "minby_"),
            run_max_by("profit", "seq", ["category", "product"], "maxby_"),
            run_first("seq", ["category", "product"], "first_")]
    r = running(_sales(spark), "month", "seq", aggs, width).toPandas()
    last = r.sort_values("seq").groupby("month").tail(1).set_index("month")
    assert last.loc[["June", "July", "August"], "n"].tolist() == [9, 3, 6]
    assert last.loc[["June", "July", "August"], "s"].tolist() == [232, 89, 212]
    assert last.loc[["June", "July", "August"], "mn"].tolist() == [10, 12, 16]
    assert last.loc[["June", "July", "August"], "mx"].tolist() == [41, 50, 50]
    minby = [tuple(last.loc[m, ["minby_category", "minby_product"]]) for m in ("June", "July", "August")]
    assert minby == [("Category4", "Perfume"), ("Category1", "Pendrive"), ("Category2", "PC")]
    maxby = [tuple(last.loc[m, ["maxby_category", "maxby_product"]]) for m in ("June", "July", "August")]
    # June: Bat (line 5) and Tablet (line 10) both 41 -> the earliest wins
    assert maxby == [("Category5", "Bat"), ("Category1", "Television"), ("Category5", "Steamer")]
    first = [tuple(last.loc[m, ["first_category", "first_product"]]) for m in ("June", "July", "August")]
    assert first == [("Category5", "Bat"), ("Category1", "Television"), ("Category5", "PC")]


@pytest.mark.parametrize("width", WIDTHS)
def test_running_average_golden_prefix(spark, width):
    r = running(_sales(spark, SALES_SAMPLE[:8]), "month", "seq",
                [run_sum("profit", "s"), run_count("n")], width)
    got = r.select("seq", "month", (F.col("s") * 1.0 / F.col("n")).alias("avg")) \
           .orderBy("seq").collect()
    assert [(x.month, x.avg) for x in got] == RUNNING_AVG_FIRST8


def _brute(pdf, key, seq, value):
    out = {}
    for k, g in pdf.sort_values(seq).groupby(key, sort=False):
        s = 0
        mn = None
        for _, row in g.iterrows():
            s += row[value]
            mn = row[value] if mn is None else min(mn, row[value])
            out[row[seq]] = (s, mn)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60),
       st.sampled_from([1, 2, 5, 1000]))
def test_two_level_matches_brute_force(spark, rows, width):
    pdf = pd.DataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], columns=["seq", "k", "v"])
    df = spark.createDataFrame(pdf, "seq long, k long, v long")
    r = running(df, "k", "seq", [run_sum("v", "s"), run_min("v", "mn")], width).toPandas()
    exp = _brute(pdf, "k", "seq", "v")
    for row in r.itertuples():
        assert (row.s, row.mn) == exp[row.seq]


@pytest.mark.parametrize("width", [7, 64, 1000])
def test_bucketed_equals_simple_on_events(spark, width):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    aggs = [run_sum("value", "s"), run_count("n"), run_max("value", "mx"),
            run_min_by("value", "event_id", ["user_id"], "mb_")]
    a = running(ev, "event_type", "event_id", aggs).select("event_id", "s", "n", "mx", "mb_user_id")
    b = running(ev, "event_type", "event_id", aggs, width) \
        .select("event_id", "s", "n", "mx", "mb_user_id")
    pa = a.toPandas().sort_values("event_id").reset_index(drop=True)
    pb = b.toPandas().sort_values("event_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(pa[["event_id", "n", "mx", "mb_user_id"]],
                                  pb[["event_id", "n", "mx", "mb_user_id"]])
    assert ((pa.s - pb.s).abs() < 1e-6).all()


def test_first_occurrence_flag(spark):
    df = spark.createDataFrame([(1, "a", "u1"), (2, "a", "u2"), (3, "a", "u1"), (4, "b", "u1")],
                               "seq long, site string, user string")
    r = first_occurrence_flag(df, ["site", "user"], "seq", "f").orderBy("seq").collect()
    assert [x.f for x in r] == [1, 1, 0, 1]


def test_bucketed_plan_has_no_single_key_window(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    r = running(ev, "event_type", "event_id", [run_count("n")], 64)
    plan = r._jdf.queryExecution().executedPlan().toString()
    # the row-level window is partitioned by (key, bucket), not by the key alone
    assert "_bkt" in plan


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_carry_levels_match_brute_force(spark, levels):
    rows = [(i, i % 3, (i * 7919) % 23 - 11) for i in range(200)]
    pdf = pd.DataFrame(rows, columns=["seq", "k", "v"])
    df = spark.createDataFrame(pdf, "seq long, k long, v long")
    r = running(df, "k", "seq", [run_sum("v", "s"), run_min("v", "mn")], 2,
                carry_levels=levels).toPandas()
    exp = _brute(pdf, "k", "seq", "v")
    assert len(r) == 200
    for row in r.itertuples():
        assert (row.s, row.mn) == exp[row.seq]


def test_running_maximum_of_a_running_total(spark):
    import random

    from keyfold.operators.running import running_total_max
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, -5, -1, 2, 3])) for i in range(200)]
    df = spark.createDataFrame(rows, "s long, k string, v long")
    got = {r.s: (r.run_total, r.run_max_total)
           for r in running_total_max(df, "k", "s", "v", 16).collect()}
    total, top = {}, {}
    for s, k, v in rows:
        if v is not None:
            total[k] = total.get(k, 0) + v
        if k in total:
            top[k] = max(top.get(k, total[k]), total[k])
        assert got[s] == (total.get(k), top.get(k))
