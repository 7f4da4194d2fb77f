"""Final per-key results (AGG-1..6) on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyfold.operators.aggregate import group_count, group_distinct, top_group
from keyfold.plans.q_running import _WORDS_SQL, WORD_PREFIX, words
from keyfold.plans.registry import CENTS_SQL, cents, events, money, query, table
from keyfold.session import shared_dir
from keyfold.sources.text import read_lines


@query("q_prefix_word_count", f"""
SELECT word, COUNT(*) AS n FROM {_WORDS_SQL} w GROUP BY word""")
def q_prefix_word_count(spark, sf):
    """AGG-1 + FLT-1: count of words starting with the prefix, whole documents."""
    return group_count(words(spark, sf), "word", "n")


_NATION_TOTAL_SQL = f"""
SELECT n_name, CAST(SUM({CENTS_SQL.format(c='o_totalprice')}) AS DOUBLE) / 100 AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name"""


def nation_totals(spark, sf):
    """AGG-2 plan: pre-aggregate orders per customer (partial agg before the
    shuffle), join customers on the key (shuffle join: both sides grow with
    the data), then the nation dimension, broadcast by its size in bytes."""
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(cents("o_totalprice")).alias("_c"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                            "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = o.join(c, "o_custkey").join(n, "c_nationkey")
    return j.groupBy("n_name").agg(F.sum("_c").alias("_c"))


@query("q_group_sum", _NATION_TOTAL_SQL)
def q_group_sum(spark, sf):
    """AGG-2: total per destination (nation)."""
    return nation_totals(spark, sf).select("n_name", money(F.col("_c")).alias("total"))


@query("q_top_group", f"""
SELECT n_name, total FROM ({_NATION_TOTAL_SQL}) t ORDER BY total DESC, n_name LIMIT 1""")
def q_top_group(spark, sf):
    """AGG-3: the group with the largest total (ties -> smallest name)."""
    t = top_group(nation_totals(spark, sf), "n_name", "_c", largest=True)
    return t.select("n_name", money(F.col("_c")).alias("total"))


_AVG_F = ("CAST(SUM({c}) AS DOUBLE) / COUNT(*) / 100 AS avg_price, COUNT(*) AS n_orders"
          .format(c=CENTS_SQL.format(c="o_totalprice")))


def _finished_orders(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F") \
        .select("o_orderpriority", "o_custkey", cents("o_totalprice").alias("_c"))


def _avg_cols():
    return [(F.sum("_c").cast("double") / F.count(F.lit(1)) / 100).alias("avg_price"),
            F.count(F.lit(1)).alias("n_orders")]


@query("q_avg_by_source", f"""
SELECT o_orderpriority, {_AVG_F} FROM orders WHERE o_orderstatus = 'F'
GROUP BY o_orderpriority""")
def q_avg_by_source(spark, sf):
    """AGG-4 + FLT-2: average per pickup (priority), ongoing (finished) only."""
    return _finished_orders(spark, sf).groupBy("o_orderpriority").agg(*_avg_cols())


@query("q_avg_by_driver", f"""
SELECT o_custkey, {_AVG_F} FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey""")
def q_avg_by_driver(spark, sf):
    """AGG-5: average per driver (customer), finished only."""
    return _finished_orders(spark, sf).groupBy("o_custkey").agg(*_avg_cols())


_CLICKS_SQL = "(SELECT event_type, COUNT(*) AS clicks FROM events GROUP BY event_type)"


def _clicks(spark, sf):
    return group_count(events(spark, sf), "event_type", "clicks")


@query("q_max_clicks_total", f"""
SELECT event_type, clicks FROM {_CLICKS_SQL} c ORDER BY clicks DESC, event_type LIMIT 1""")
def q_max_clicks_total(spark, sf):
    """AGG-6a: the site with the most clicks overall."""
    return top_group(_clicks(spark, sf), "event_type", "clicks", largest=True)


@query("q_min_clicks_total", f"""
SELECT event_type, clicks FROM {_CLICKS_SQL} c ORDER BY clicks ASC, event_type LIMIT 1""")
def q_min_clicks_total(spark, sf):
    """AGG-6b: the site with the fewest clicks overall."""
    return top_group(_clicks(spark, sf), "event_type", "clicks", largest=False)


@query("q_distinct_users", """
SELECT event_type, COUNT(DISTINCT user_id) AS n_users FROM events GROUP BY event_type""")
def q_distinct_users(spark, sf):
    """AGG-6c: distinct users per site."""
    return group_distinct(events(spark, sf), "event_type", "user_id", "n_users")


@query("q_avg_time", f"""
SELECT event_type, CAST(SUM({CENTS_SQL.format(c='value')}) AS DOUBLE) / COUNT(*) / 100
       AS avg_value
FROM events GROUP BY event_type""")
def q_avg_time(spark, sf):
    """AGG-6d: average time spent (value) per site."""
    e = events(spark, sf).select("event_type", cents("value").alias("_c"))
    return e.groupBy("event_type").agg(
        (F.sum("_c").cast("double") / F.count(F.lit(1)) / 100).alias("avg_value"))


@query("q_line_count", f"""
SELECT line, COUNT(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE starts_with(line, '{WORD_PREFIX}') GROUP BY line""")
def q_line_count(spark, sf):
    """SRC-1 + FLT-1 + AGG-1 on text files: the whole documents are written as
    text (Spark job, shared folder), read back as lines, and the lines that
    start with the prefix are counted per distinct line."""
    folder = shared_dir(spark, "text", "documents")
    table(spark, sf, "documents").select("text").write.text(folder)
    lines = read_lines(spark, folder, numbered=False)
    return group_count(lines.filter(F.col("value").startswith(WORD_PREFIX)), "value", "n") \
        .withColumnRenamed("value", "line")
