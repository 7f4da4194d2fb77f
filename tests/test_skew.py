"""A key (or an instant) holding a third or more of all rows must not land in one task."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from keyfold.operators.running import run_count, run_sum, running
from keyfold.operators.sessions import session_windows


def _hot(spark, n=6000):
    # key 0 holds half of the rows, keys 1..50 share the rest
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        (F.col("id") % 7).alias("v"))


def test_hot_key_running_is_spread_over_tasks(spark):
    # keep the shuffle layout visible, and plan as for large inputs (the tiny
    # test frame would otherwise be broadcast whole)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _hot(spark)
        r = running(df, "k", "seq", [run_sum("v", "s"), run_count("n")], bucket_width=500)
        def tasks_of_hot_key(out):
            # collect with the fold columns: an aggregate over the partition id
            # alone would let column pruning drop the window altogether
            rows = out.select("k", "s", "n", F.spark_partition_id().alias("p")) \
                      .filter("k = 0").collect()
            return len({r.p for r in rows})

        assert tasks_of_hot_key(r) >= 3
        simple = running(df, "k", "seq", [run_sum("v", "s"), run_count("n")])
        assert tasks_of_hot_key(simple) == 1
        assert r.exceptAll(simple).count() == 0 and simple.exceptAll(r).count() == 0
        # the row side is shuffled once: by (key, bucket) for the window, and
        # the carry join reuses that partitioning
        plan = r._jdf.queryExecution().executedPlan().toString()
        row_side = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(_key" in ln
                    and "_bkt" in ln]
        assert row_side
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_instant_sessions_split_across_range_partitions(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(i, t0, 1) for i in range(3000)]                      # one instant, 3000 rows
    rows += [(3000 + i, t0 + timedelta(minutes=30 * (i + 1)), 1) for i in range(100)]
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, v long")
    got = session_windows(df, "ts", "10 minutes", "v", "seq", partitions=8)
    res = sorted((r.session_start, r.n) for r in got.collect())
    assert res[0] == (t0, 3000) and len(res) == 101
    # the hot instant itself is cut into several range partitions before stitching
    slim = df.repartitionByRange(8, "ts", "seq").select("ts", F.spark_partition_id().alias("p"))
    assert len({r.p for r in slim.filter(F.col("ts") == t0).collect()}) >= 3
