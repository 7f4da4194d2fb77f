"""Sinks and text sources as queries: whole tables are written, read back and
compared (SNK-1..4, SRC-1, SRC-2, PRJ-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyfold.functions.parse import parse_number
from keyfold.operators.split import split_parity
from keyfold.plans.registry import events, query, table
from keyfold.session import shared_dir
from keyfold.sinks import run_to_files, write_delimited, write_text
from keyfold.sources.text import line_stream, read_lines

_TUPLES = """SELECT '(' || o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ')' AS line
FROM orders"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _lines(spark, path):
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("q_sink_text", _TUPLES)
def q_sink_text(spark, sf):
    """SNK-1: rows as tuple text in a new folder, read back."""
    path = shared_dir(spark, "sink-text")
    write_text(_orders(spark, sf), path)
    return _lines(spark, path)


@query("q_sink_overwrite", _TUPLES + " WHERE o_orderstatus = 'F'")
def q_sink_overwrite(spark, sf):
    """SNK-2: written twice; the second output replaces the first."""
    path = shared_dir(spark, "sink-overwrite")
    write_text(_orders(spark, sf), path, mode="overwrite")
    write_text(_orders(spark, sf).filter("o_orderstatus = 'F'"), path, mode="overwrite")
    return _lines(spark, path)


@query("q_sink_delimited", "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders")
def q_sink_delimited(spark, sf):
    """SNK-3: delimited text with one space between fields, read back typed."""
    path = shared_dir(spark, "sink-delimited")
    write_delimited(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"),
                    path)
    return spark.read.option("sep", " ").schema(
        "o_orderkey long, o_orderstatus string, o_custkey long").csv(path)


@query("q_text_lines", """
WITH r AS (SELECT event_id % 7 AS slot, event_id,
             row_number() OVER (PARTITION BY event_id % 7 ORDER BY event_id) AS line FROM events),
n AS (SELECT slot, count(*) AS n FROM r GROUP BY slot)
SELECT CAST(r.event_id AS VARCHAR) AS value, r.line,
       r.line + coalesce((SELECT sum(n.n) FROM n WHERE n.slot < r.slot), 0)::BIGINT AS seq
FROM r""")
def q_text_lines(spark, sf):
    """SRC-1: a table written as seven parts of sorted text files, read with line
    numbers in path order."""
    path = shared_dir(spark, "text-lines")
    for slot in range(7):  # each part in files by range, as many as its size asks for
        events(spark, sf).filter(F.col("event_id") % 7 == slot) \
            .repartitionByRange("event_id").sortWithinPartitions("event_id") \
            .select(F.col("event_id").cast("string").alias("value")) \
            .write.text(f"{path}/part={slot}")
    return read_lines(spark, path, within="part").select("value", "line", "seq")


def _numbers(spark, sf, name):
    path = shared_dir(spark, name)
    events(spark, sf).select(F.col("event_id").cast("string").alias("value")).write.text(path)
    return path


@query("q_split_lines", """
SELECT event_id AS number, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS side
FROM events""")
def q_split_lines(spark, sf):
    """PRJ-11 + SPL-1: lines parsed to numbers, then split by parity."""
    good, _bad = parse_number(spark.read.text(_numbers(spark, sf, "split-lines")))
    sides = split_parity(good.select("v"), "v")
    even, odd = [sides[k].select(F.col("v").cast("long").alias("number"), F.lit(k).alias("side"))
                 for k in ("even", "odd")]
    return even.union(odd)


@query("q_stream_text", "SELECT '(' || event_id || ',' || event_id % 10 || ')' AS line FROM events")
def q_stream_text(spark, sf):
    """SRC-2 + SNK-4: text lines streamed through the number parser into rolling
    text files."""
    path = _numbers(spark, sf, "stream-text-in")
    good, _bad = parse_number(line_stream(spark, "text", path, maxFilesPerTrigger=2))
    out = shared_dir(spark, "stream-text-out")
    run_to_files(good.select("v", (F.col("v") % 10).alias("last")), out,
                 shared_dir(spark, "stream-text-ckpt"), fmt="text")
    return _lines(spark, out)
