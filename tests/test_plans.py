"""Plan properties the design relies on, read from ``explain()`` output."""

import contextlib
import io
import re

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)


def test_filter_and_columns_reach_the_orders_scan(spark):
    plan = _plan(E.queries()["q_avg_by_source"](spark, SF_SMALL))
    assert "EqualTo(o_orderstatus,F)" in plan
    (schema,) = _schemas(plan)
    assert "o_custkey" not in schema and "o_orderdate" not in schema


def test_orders_are_pre_aggregated_before_the_customer_join(spark):
    plan = _plan(E.queries()["q_group_sum"](spark, SF_SMALL))
    tree = plan.split("\n\n\n")[0]
    # the partial + final per-customer aggregate sits below the first join
    first_join = min(i for i, ln in enumerate(tree.splitlines()) if "Join" in ln)
    below = tree.splitlines()[first_join:]
    assert sum("HashAggregate" in ln for ln in below) >= 2
    assert any(s == "struct<o_custkey:bigint,o_totalprice:double>" for s in _schemas(plan))


def test_exclusion_list_is_a_broadcast_anti_join_with_pushed_filters(spark):
    plan = _plan(E.queries()["q_excluded_dept_count"](spark, SF_SMALL))
    assert "BroadcastHashJoin LeftAnti" in plan
    assert "EqualTo(event_type,error)" in plan and "GreaterThan(value,150.0)" in plan


def test_parser_splits_once_without_a_filter(spark):
    plan = _plan(E.queries()["q_parse_cab_strict"](spark, SF_SMALL))
    tree = plan.split("\n\n\n")[0]
    assert "Generate" in tree and "Filter" not in tree


def test_struct_folds_sort_no_raw_rows_again(spark):
    for name in ("q_running_sum", "q_running_min", "q_running_max", "q_running_min_by", "q_running_max_by"):
        df = E.queries()[name](spark, SF_SMALL)
        plan = _plan(df)
        # what is aggregated by sorting is the totals of buckets, by groups of buckets
        keys = re.findall(r"SortAggregate[^\n]*\nInput[^:]*: \[([^\n]*)\]", plan)
        assert keys and all("_sup" in k and "user_id" not in k for k in keys)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("Scan parquet") == 1 and "ReusedExchange" in final  # rows are shuffled once
    for name in ("q_large_delta", "q_alert_report"):
        assert "SortAggregate" not in _plan(E.queries()[name](spark, SF_SMALL))
