import contextlib
import io

from keyfold.operators.exclude import exclude_static
from keyfold.sinks import to_console


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_exclusion_is_broadcast_by_bytes_and_runs_no_job_to_plan(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    side = spark.range(5).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(exclude_static(big, side, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    group = "planning"
    spark.sparkContext.setJobGroup(group, "")
    try:
        over = exclude_static(big, side, "k")
        assert "BroadcastHashJoin" not in _plan(over)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        assert over.count() == 95
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_console_sink_prints_rows(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        to_console(spark.createDataFrame([("June", 12.0)], "month string, avg double"))
    assert "June" in buf.getvalue()
