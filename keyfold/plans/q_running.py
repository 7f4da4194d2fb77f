"""Running aggregates over whole tables (RUN-1..14), two-level prefix plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyfold.operators.exclude import exclude_static
from keyfold.operators.running import (first_occurrence_flag, run_count, run_first, run_max,
                                       run_max_by, run_min, run_min_by, run_sum, running,
                                       running_total_max)
from keyfold.plans.registry import (CENTS_SQL, bucket_width, cents, events, money, query,
                                    table)

# Fixed query parameters
WORD_PREFIX = "N"
WORD_SPLIT = "[ \t\n\r\f]+"
WORD_DOC_BUCKET = 64            # documents per bucket in the word plans
EXCLUDE_TYPE = "error"          # users with an `error` event above the bound ...
EXCLUDE_ABOVE = 150.0           # ... are on the exclusion list

_W = ("PARTITION BY {k} ORDER BY {s} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
_EV = f"(SELECT *, {CENTS_SQL.format(c='value')} AS cents FROM events)"


def _ev(spark, sf):
    return events(spark, sf).select("event_id", "event_type", "user_id", "value",
                                    cents("value").alias("cents"))


def _money_finish(name):
    return lambda c: money(c).alias(name)


@query("q_running_sum", f"""
SELECT event_id, event_type, CAST(SUM(cents) OVER w AS DOUBLE) / 100 AS running_sum,
       FIRST_VALUE(user_id) OVER w AS first_user_id
FROM {_EV} e WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_sum(spark, sf):
    """RUN-1: running sum; other fields from the key's first record."""
    r = running(_ev(spark, sf), "event_type", "event_id",
                [run_sum("cents", "running_sum", _money_finish("running_sum")),
                 run_first("event_id", ["user_id"], "first_")], bucket_width(spark))
    return r.select("event_id", "event_type", "running_sum", "first_user_id")


@query("q_running_min", f"""
SELECT event_id, event_type, MIN(value) OVER w AS running_min,
       FIRST_VALUE(user_id) OVER w AS first_user_id
FROM events WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_min(spark, sf):
    """RUN-2: running minimum value."""
    r = running(_ev(spark, sf), "event_type", "event_id",
                [run_min("value", "running_min"),
                 run_first("event_id", ["user_id"], "first_")], bucket_width(spark))
    return r.select("event_id", "event_type", "running_min", "first_user_id")


@query("q_running_max", f"""
SELECT event_id, event_type, MAX(value) OVER w AS running_max,
       FIRST_VALUE(user_id) OVER w AS first_user_id
FROM events WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_max(spark, sf):
    """RUN-4: running maximum value."""
    r = running(_ev(spark, sf), "event_type", "event_id",
                [run_max("value", "running_max"),
                 run_first("event_id", ["user_id"], "first_")], bucket_width(spark))
    return r.select("event_id", "event_type", "running_max", "first_user_id")


@query("q_running_min_by", f"""
WITH r AS (
  SELECT event_id, event_type,
         arg_min(event_id, row(value, event_id)) OVER w AS mb
  FROM events WINDOW w AS ({_W.format(k='event_type', s='event_id')}))
SELECT r.event_id, r.event_type, e.event_id AS min_by_event_id,
       e.user_id AS min_by_user_id, e.value AS min_by_value
FROM r JOIN events e ON e.event_id = r.mb""")
def q_running_min_by(spark, sf):
    """RUN-3: whole record holding the running minimum; earliest wins ties."""
    ev = _ev(spark, sf).withColumn("event_id_", F.col("event_id"))
    r = running(ev, "event_type", "event_id",
                [run_min_by("value", "event_id", ["event_id_", "user_id", "value"],
                            "min_by_")], bucket_width(spark))
    return r.select("event_id", "event_type",
                    F.col("min_by_event_id_").alias("min_by_event_id"),
                    "min_by_user_id", "min_by_value")


@query("q_running_max_by", f"""
WITH r AS (
  SELECT event_id, event_type,
         arg_max(event_id, row(value, -event_id)) OVER w AS mb
  FROM events WINDOW w AS ({_W.format(k='event_type', s='event_id')}))
SELECT r.event_id, r.event_type, e.event_id AS max_by_event_id,
       e.user_id AS max_by_user_id, e.value AS max_by_value
FROM r JOIN events e ON e.event_id = r.mb""")
def q_running_max_by(spark, sf):
    """RUN-5: whole record holding the running maximum; earliest wins ties."""
    ev = _ev(spark, sf).withColumn("event_id_", F.col("event_id"))
    r = running(ev, "event_type", "event_id",
                [run_max_by("value", "event_id", ["event_id_", "user_id", "value"],
                            "max_by_")], bucket_width(spark))
    return r.select("event_id", "event_type",
                    F.col("max_by_event_id_").alias("max_by_event_id"),
                    "max_by_user_id", "max_by_value")


@query("q_running_avg", f"""
SELECT event_id, event_type,
       CAST(SUM(cents) OVER w AS DOUBLE) / COUNT(*) OVER w / 100 AS running_avg
FROM {_EV} e WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_avg(spark, sf):
    """RUN-6: running average = running sum / running count (PRJ-12)."""
    r = running(_ev(spark, sf), "event_type", "event_id",
                [run_sum("cents", "_s"), run_count("_n")], bucket_width(spark))
    return r.select("event_id", "event_type",
                    (F.col("_s").cast("double") / F.col("_n") / 100).alias("running_avg"))


@query("q_running_clicks", f"""
SELECT event_id, event_type, COUNT(*) OVER w AS clicks
FROM events WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_clicks(spark, sf):
    """RUN-11: running clicks per site (event type)."""
    r = running(_ev(spark, sf), "event_type", "event_id", [run_count("clicks")],
                bucket_width(spark))
    return r.select("event_id", "event_type", "clicks")


@query("q_running_clicks_max", f"""
WITH c AS (SELECT event_id, event_type, COUNT(*) OVER w AS clicks
           FROM events WINDOW w AS ({_W.format(k='event_type', s='event_id')}))
SELECT event_id, event_type, MAX(clicks) OVER w AS max_clicks
FROM c WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_clicks_max(spark, sf):
    """RUN-12: running clicks, then the running max of that count per site."""
    e = _ev(spark, sf).withColumn("one", F.lit(1).cast("long"))
    r = running_total_max(e, "event_type", "event_id", "one", bucket_width(spark),
                          "clicks", "max_clicks")
    return r.select("event_id", "event_type", "max_clicks")


@query("q_running_distinct", f"""
WITH f AS (SELECT event_id, event_type,
                  CASE WHEN ROW_NUMBER() OVER (PARTITION BY event_type, user_id
                                                ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS first
           FROM events)
SELECT event_id, event_type, SUM(first) OVER w AS distinct_users
FROM f WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_distinct(spark, sf):
    """RUN-13: running number of distinct users per site."""
    flagged = first_occurrence_flag(_ev(spark, sf), ["event_type", "user_id"], "event_id",
                                    "_first")
    r = running(flagged, "event_type", "event_id",
                [run_sum(F.col("_first").cast("long"), "distinct_users")],
                bucket_width(spark))
    return r.select("event_id", "event_type", "distinct_users")


# --- orders: running totals / averages (cab analysis on the order table) ---

_ORD = (f"(SELECT *, {CENTS_SQL.format(c='o_totalprice')} AS cents, "
        f"CASE WHEN o_orderstatus = 'F' THEN {CENTS_SQL.format(c='o_totalprice')} "
        f"ELSE 0 END AS fcents FROM orders)")


def _orders(spark, sf):
    o = table(spark, sf, "orders")
    c = cents("o_totalprice")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                    c.alias("cents"),
                    F.when(F.col("o_orderstatus") == "F", c).otherwise(F.lit(0).cast("long"))
                    .alias("fcents"))


@query("q_running_sum_max", f"""
WITH s AS (SELECT o_orderkey, o_orderpriority, SUM(cents) OVER w AS t
           FROM {_ORD} o WINDOW w AS ({_W.format(k='o_orderpriority', s='o_orderkey')}))
SELECT o_orderkey, o_orderpriority, CAST(t AS DOUBLE) / 100 AS running_total,
       CAST(MAX(t) OVER w AS DOUBLE) / 100 AS running_max_total
FROM s WINDOW w AS ({_W.format(k='o_orderpriority', s='o_orderkey')})""")
def q_running_sum_max(spark, sf):
    """RUN-8: running total per key, then the running max of that total."""
    r = running_total_max(_orders(spark, sf), "o_orderpriority", "o_orderkey", "cents",
                          bucket_width(spark), "_t", "_m")
    return r.select("o_orderkey", "o_orderpriority",
                    money(F.col("_t")).alias("running_total"),
                    money(F.col("_m")).alias("running_max_total"))


@query("q_running_avg_source", f"""
SELECT o_orderkey, o_orderpriority,
       CAST(SUM(fcents) OVER w AS DOUBLE) / COUNT(*) OVER w / 100 AS running_avg
FROM {_ORD} o WINDOW w AS ({_W.format(k='o_orderpriority', s='o_orderkey')})""")
def q_running_avg_source(spark, sf):
    """RUN-9: running average per pickup over all rows; idle rows count as 0."""
    r = running(_orders(spark, sf), "o_orderpriority", "o_orderkey",
                [run_sum("fcents", "_s"), run_count("_n")], bucket_width(spark))
    return r.select("o_orderkey", "o_orderpriority",
                    (F.col("_s").cast("double") / F.col("_n") / 100).alias("running_avg"))


@query("q_running_avg_driver", f"""
SELECT o_orderkey, o_custkey,
       CAST(SUM(fcents) OVER w AS DOUBLE) / COUNT(*) OVER w / 100 AS running_avg
FROM {_ORD} o WINDOW w AS ({_W.format(k='o_custkey', s='o_orderkey')})""")
def q_running_avg_driver(spark, sf):
    """RUN-10: running average per driver (customer) over all rows."""
    r = running(_orders(spark, sf), "o_custkey", "o_orderkey",
                [run_sum("fcents", "_s"), run_count("_n")], bucket_width(spark))
    return r.select("o_orderkey", "o_custkey",
                    (F.col("_s").cast("double") / F.col("_n") / 100).alias("running_avg"))


# --- words of whole documents ---

_WORDS_SQL = f"""(SELECT doc_id, pos, word FROM (
    SELECT doc_id, unnest(a) AS word, generate_subscripts(a, 1) - 1 AS pos
    FROM (SELECT doc_id, regexp_split_to_array(text, '{WORD_SPLIT}') AS a FROM documents))
  WHERE starts_with(word, '{WORD_PREFIX}'))"""


def words(spark, sf, prefix: str = WORD_PREFIX):
    """FLT-1 + PRJ-10: every token of every whole document starting with ``prefix``."""
    d = table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split(F.col("text"), WORD_SPLIT)).alias("pos", "word"))
    return d.filter(F.col("word").startswith(prefix)) \
            .select("doc_id", F.col("pos").cast("long").alias("pos"), "word")


@query("q_running_word_count", f"""
SELECT doc_id, pos, word,
       COUNT(*) OVER (PARTITION BY word ORDER BY doc_id, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM {_WORDS_SQL} w""")
def q_running_word_count(spark, sf):
    """RUN-7: running count of each word in arrival (document, position) order."""
    r = running(words(spark, sf), "word", ["doc_id", "pos"], [run_count("running_count")],
                WORD_DOC_BUCKET)
    return r.select("doc_id", "pos", "word", "running_count")


# --- exclusion list + running count ---

_EXCL_SQL = (f"(SELECT DISTINCT user_id FROM events WHERE event_type = '{EXCLUDE_TYPE}' "
             f"AND value > {EXCLUDE_ABOVE})")


def exclusion_list(spark, sf):
    ev = events(spark, sf)
    return ev.filter((F.col("event_type") == EXCLUDE_TYPE) & (F.col("value") > EXCLUDE_ABOVE)) \
             .select("user_id", "ts")


@query("q_running_dept_count", f"""
SELECT event_id, event_type, COUNT(*) OVER w AS running_count
FROM events WHERE user_id NOT IN {_EXCL_SQL}
WINDOW w AS ({_W.format(k='event_type', s='event_id')})""")
def q_running_dept_count(spark, sf):
    """RUN-14: running count per department after the exclusion list."""
    kept = exclude_static(_ev(spark, sf), exclusion_list(spark, sf), "user_id")
    r = running(kept, "event_type", "event_id", [run_count("running_count")],
                bucket_width(spark))
    return r.select("event_id", "event_type", "running_count")
