"""Values that earlier came out wrong without an error: nulls, large and odd inputs."""

import pytest
from pyspark.sql import functions as F

from keyfold.functions.format import int_div
from keyfold.operators.aggregate import top_group
from keyfold.operators.running import run_min_by, running
from keyfold.session import shared_dir
from keyfold.sinks import tuple_text, write_text
from keyfold.sources.text import read_lines
from keyfold.streaming.runner import replay


def test_integer_division_is_exact(spark):
    rows = [(2**53 + 1, 1), (2**60 + 1, 1), (-7, 2), (7, -2), (5, 0), (None, 1)]
    got = [r.q for r in spark.createDataFrame(rows, "a long, b long")
           .select(int_div(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [2**53 + 1, 2**60 + 1, -3, -3, None, None]


def test_a_group_without_a_total_never_wins(spark):
    df = spark.createDataFrame([("a", 5), ("b", None)], "k string, t long")
    assert [tuple(r) for r in top_group(df, "k", "t").collect()] == [("a", 5)]
    assert [tuple(r) for r in top_group(df, "k", "t", largest=False).collect()] == [("a", 5)]
    assert top_group(df.filter("t is null"), "k", "t").count() == 0


@pytest.mark.parametrize("width", [None, 2])
def test_null_is_not_the_running_minimum(spark, width):
    df = spark.createDataFrame([(0, 1, 5), (0, 2, None), (0, 3, 7), (0, 4, 5)], "k int, s long, v long")
    out = running(df, "k", "s", [run_min_by("v", "s", ["s", "v"], "min_")], width)
    assert [(r.min_s, r.min_v) for r in out.orderBy("s").collect()] == [(1, 5)] * 4


def test_null_fields_stay_in_the_text(spark, tmp_path):
    df = spark.createDataFrame([("June", None)], "m string, v double")
    assert df.select(tuple_text("m", "v").alias("x")).first().x == "(June,null)"
    for _ in range(2):  # replacing what is there
        write_text(df, str(tmp_path / "o"), mode="overwrite")
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == ["(June,null)"]


def test_lines_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a1\na2\n")
    (tmp_path / "b.txt").write_text("".join(f"b{i}\n" for i in range(1, 2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # many splits of one file
    try:
        got = {r.value: (r.line, r.seq) for r in read_lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got["a1"] == (1, 1) and got["a2"] == (2, 2)
    assert all(got[f"b{i}"] == (i, i + 2) for i in range(1, 2000))


def test_replay_keeps_rows_without_a_sequence(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "s long, v string")
    out = replay(spark, df, "s", 2, "null_seq", lambda s: s)
    assert sorted(r.v for r in out.collect()) == ["a", "b", "c"]
    assert replay(spark, df.limit(0), "s", 2, "no_rows", lambda s: s).count() == 0
    assert shared_dir(spark)
