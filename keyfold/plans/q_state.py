"""Count windows, exclusion lists, side outputs and fixed batches (ST-1..3,
JN-1/2, SPL-1, SNK-6) on the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyfold.operators.count_window import (count_chunk_fold, count_chunk_list, count_chunks,
                                            fixed_batches)
from keyfold.operators.exclude import exclude_from, exclude_static
from keyfold.operators.scan import affine, scan
from keyfold.operators.split import split_parity
from keyfold.plans.q_running import _EXCL_SQL, EXCLUDE_ABOVE, EXCLUDE_TYPE, exclusion_list
from keyfold.plans.registry import CENTS_SQL, bucket_width, cents, events, money, query

# Fixed query parameters
CHUNK_N = 10          # values per count-triggered group
BATCH_N = 100         # rows per released batch
BATCH_BUCKETS = 4     # buffers the batches are spread over

_CENTS = CENTS_SQL.format(c="value")


def _ev(spark, sf):
    return events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value",
                                    cents("value").alias("cents"))


_CHUNKS_SQL = f"""(SELECT user_id, event_id, value, {_CENTS} AS c,
       (ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {CHUNK_N} AS chunk_no
FROM events)"""


@query("q_count_chunk_sum", f"""
SELECT user_id, chunk_no, CAST(SUM(c) AS DOUBLE) / 100 AS total
FROM {_CHUNKS_SQL} r GROUP BY user_id, chunk_no HAVING COUNT(*) = {CHUNK_N}""")
def q_count_chunk_sum(spark, sf):
    """ST-1: every 10 values of a key, emit their sum; incomplete group never."""
    g = count_chunks(_ev(spark, sf), "user_id", "event_id", CHUNK_N,
                     lambda: [F.sum("cents").alias("_c")], bucket_width(spark))
    return g.select("user_id", "chunk_no", money(F.col("_c")).alias("total"))


@query("q_count_chunk_list", f"""
SELECT user_id, chunk_no,
       ' ' || string_agg(CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR), ' ' ORDER BY event_id)
         AS values_text,
       CAST(SUM(c) AS DOUBLE) / 100 AS total
FROM {_CHUNKS_SQL} r GROUP BY user_id, chunk_no HAVING COUNT(*) = {CHUNK_N}""")
def q_count_chunk_list(spark, sf):
    """ST-2: the group's values (each after a space, arrival order) and their sum."""
    e = _ev(spark, sf).withColumn("dec", F.col("value").cast("decimal(18,2)"))
    g = count_chunk_list(e, "user_id", "event_id", F.col("dec"), CHUNK_N, bucket_width(spark))
    return g.select("user_id", "chunk_no", "values_text",
                    F.col("total").cast("double").alias("total"))


@query("q_count_chunk_reduce", f"""
SELECT event_type, chunk_no, SUM(user_id) AS total FROM (
  SELECT event_type, user_id,
         (ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {CHUNK_N}
           AS chunk_no
  FROM events) r
GROUP BY event_type, chunk_no HAVING COUNT(*) = {CHUNK_N}""")
def q_count_chunk_reduce(spark, sf):
    """ST-3: same trigger, a pluggable associative reducer (sum of long values)
    over (key, value) pairs; the hot keys here are the 5 event types."""
    g = count_chunks(_ev(spark, sf), "event_type", "event_id", CHUNK_N,
                     lambda: [F.sum("user_id").alias("total")], bucket_width(spark))
    return g.select("event_type", "chunk_no", "total")


FOLD_MODULUS = 1_000_003


def user_maps():
    """A reducer that depends on the order: x -> (2 + user % 97) * x + user."""
    return affine(2 + F.col("user_id") % 97, F.col("user_id"), FOLD_MODULUS)


_MAP_SQL = f"{{'a': (2 + user_id % 97) % {FOLD_MODULUS}, 'b': user_id % {FOLD_MODULUS}}}"
_THEN_SQL = (f"lambda x, y: {{'a': x['a'] * y['a'] % {FOLD_MODULUS}, "
             f"'b': (y['a'] * x['b'] + y['b']) % {FOLD_MODULUS}}}")


@query("q_count_chunk_fold", f"""
WITH c AS (SELECT event_type, event_id, {_MAP_SQL} AS m,
       (ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {CHUNK_N} AS chunk_no
FROM events),
g AS (SELECT event_type, chunk_no, list_reduce(list(m ORDER BY event_id), {_THEN_SQL}) AS f
      FROM c GROUP BY event_type, chunk_no HAVING COUNT(*) = {CHUNK_N})
SELECT event_type, chunk_no, CAST(f['a'] AS BIGINT) AS a, CAST(f['b'] AS BIGINT) AS b FROM g""")
def q_count_chunk_fold(spark, sf):
    """ST-3 with a reducer of the user's own, associative but not commutative: the
    affine maps of every 10 rows of an event type, one after another."""
    g = count_chunk_fold(_ev(spark, sf), "event_type", "event_id", CHUNK_N, user_maps(), "f",
                         bucket_width(spark))
    return g.select("event_type", "chunk_no", "f.a", "f.b")


@query("q_running_fold", f"""
WITH r AS (SELECT event_id, event_type, list_reduce(list({_MAP_SQL}) OVER (
    PARTITION BY event_type ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {_THEN_SQL}) AS f FROM events)
SELECT event_id, event_type, CAST(f['a'] AS BIGINT) AS a, CAST(f['b'] AS BIGINT) AS b FROM r""")
def q_running_fold(spark, sf):
    """RUN-*, ST-3: the running fold of the same reducer, one row per record."""
    r = scan(_ev(spark, sf).select("event_id", "event_type", "user_id"), "event_type", "event_id",
             user_maps(), "f", bucket_width(spark))
    return r.select("event_id", "event_type", "f.a", "f.b")


@query("q_excluded_dept_count", f"""
SELECT event_type, COUNT(*) AS n FROM events WHERE user_id NOT IN {_EXCL_SQL}
GROUP BY event_type""")
def q_excluded_dept_count(spark, sf):
    """JN-1 + FLT-6: count per department of rows not on the exclusion list."""
    kept = exclude_static(_ev(spark, sf), exclusion_list(spark, sf), "user_id")
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("q_excluded_asof", f"""
WITH x AS (SELECT user_id, MIN(ts) AS ex_from FROM events
           WHERE event_type = '{EXCLUDE_TYPE}' AND value > {EXCLUDE_ABOVE} GROUP BY user_id)
SELECT e.event_id, e.user_id, e.event_type FROM events e LEFT JOIN x USING (user_id)
WHERE x.ex_from IS NULL OR e.ts < x.ex_from""")
def q_excluded_asof(spark, sf):
    """JN-2: an exclusion drops only the id's rows from its first announcement on."""
    ex = exclusion_list(spark, sf).withColumnRenamed("ts", "ex_ts")
    kept = exclude_from(_ev(spark, sf), ex, "user_id", "ts", "ex_ts")
    return kept.select("event_id", "user_id", "event_type")


@query("q_split_all", "SELECT CAST(event_id AS INTEGER) AS v FROM events")
def q_split_all(spark, sf):
    """SPL-1 main output: every value as int."""
    return split_parity(events(spark, sf).select("event_id"), "event_id")["all"]


@query("q_split_even", """
SELECT CAST(CAST(event_id AS INTEGER) AS VARCHAR) AS v FROM events WHERE event_id % 2 = 0""")
def q_split_even(spark, sf):
    """SPL-1 side output: even values as text."""
    return split_parity(events(spark, sf).select("event_id"), "event_id")["even"]


@query("q_split_odd", """
SELECT CAST(event_id AS INTEGER) AS v FROM events WHERE event_id % 2 <> 0""")
def q_split_odd(spark, sf):
    """SPL-1 side output: odd values as int."""
    return split_parity(events(spark, sf).select("event_id"), "event_id")["odd"]


@query("q_fixed_batches", f"""
WITH r AS (SELECT event_id, user_id % {BATCH_BUCKETS} AS bucket,
                  (ROW_NUMBER() OVER (PARTITION BY user_id % {BATCH_BUCKETS}
                                      ORDER BY event_id) - 1) // {BATCH_N} AS batch_no
           FROM events),
t AS (SELECT bucket, COUNT(*) // {BATCH_N} AS full_batches FROM r GROUP BY bucket)
SELECT r.bucket, r.batch_no, COUNT(*) AS n_rows, MIN(event_id) AS first_event_id,
       MAX(event_id) AS last_event_id
FROM r JOIN t USING (bucket) WHERE r.batch_no < t.full_batches
GROUP BY r.bucket, r.batch_no""")
def q_fixed_batches(spark, sf):
    """SNK-6: rows released in batches of exactly 100 per buffer; the rest held."""
    b = fixed_batches(_ev(spark, sf), F.pmod(F.col("user_id"), F.lit(BATCH_BUCKETS)),
                      "event_id", BATCH_N, bucket_width(spark))
    return b.groupBy("bucket", "batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_event_id"),
        F.max("event_id").alias("last_event_id"))
