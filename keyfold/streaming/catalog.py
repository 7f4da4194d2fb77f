"""Streaming queries: the driver's tables replayed as file streams.

Each query replays a table in arrival order: the table arrives in a few pieces
and after each piece the streaming plan runs with ``availableNow`` on the same
checkpoint (so every piece is also a restart from state) into an exactly-once
sink under the shared checkpoint folder.  The query returns what the sink
holds; its oracle is the batch query's SQL: stream and table must agree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keyfold.functions.format import int_average
from keyfold.functions.parse import parse_sales
from keyfold.plans import q_state, q_windows  # noqa: F401  (batch oracles registered first)
from keyfold.plans.q_running import (EXCLUDE_ABOVE, EXCLUDE_TYPE, WORD_DOC_BUCKET, WORD_PREFIX,
                                     WORD_SPLIT)
from keyfold.operators.count_window import fold_chunks
from keyfold.operators.running import (run_count, run_first, run_max, run_max_by, run_min,
                                       run_min_by, run_sum)
from keyfold.operators.window_change import alerts, window_change
from keyfold.operators.windows import tumbling
from keyfold.plans.q_state import CHUNK_N, user_maps
from keyfold.plans.q_windows import DELTA_THRESHOLD_PCT, DELTA_WINDOW
from keyfold.plans.registry import ORACLE, bucket_width, cents, events, money, query, table
from keyfold.session import shared_dir
from keyfold.sinks import rolled_lines, rolling_writer
from keyfold.streaming.carry import (chunk_writer, distinct_flags, previous_window_writer,
                                     running_writer)
from keyfold.streaming.operators import (arrival_windows, event_time, exclude_asof_writer,
                                         exclude_sources_writer, exclude_stream, late_writer,
                                         reject_writer, session_stream, session_writer,
                                         split_stream, tumbling_stream, two_sources,
                                         window_top_stream)
from keyfold.streaming.runner import END_OF_INPUT_TS, one_row, play, replay

# Fixed query parameters
REPLAY_PIECES = 4         # arrivals (availableNow runs) per replay
LATENESS = "1 hour"       # bounded out-of-orderness of the event-time streams
END_EVENT_ID = -1         # id of the end-of-input row


def _events_replay(spark, sf, name, plan, end_marker=False, **kw):
    marker = None
    if end_marker:
        from datetime import datetime
        marker = {"event_id": END_EVENT_ID, "ts": datetime.fromisoformat(END_OF_INPUT_TS),
                  "event_type": "~end", "user_id": 0, "value": 0.0, "props": "{}"}
    return replay(spark, events(spark, sf), "event_id", REPLAY_PIECES, name, plan,
                  end_marker=marker, **kw)


def _real(df):
    """Drop the end-of-input row after the watermark has seen it.  The filter
    names the event-time column: Catalyst pushes filters on other columns
    below ``EventTimeWatermark`` (into the scan), where the end row would be
    gone before it could raise the watermark."""
    return df.filter(F.col("ts") < F.lit(END_OF_INPUT_TS).cast("timestamp"))


def _running_replay(spark, rows, name, plan, key, order, stages, keep, seq="event_id",
                    width=None, flags=None):
    """Replay ``rows`` through the running folds; what the stream wrote."""
    base = shared_dir(spark, "stream-out", name)
    prepare = distinct_flags(spark, key, order, flags, base) if flags else None
    writer = running_writer(spark, key, order, stages, keep, base,
                            width or bucket_width(spark), prepare)
    replay(spark, rows, seq, REPLAY_PIECES, name, plan, foreach_batch=writer)
    return spark.read.parquet(f"{base}/out").drop("epoch")


def _running_events(spark, sf, name, stages, plan=None, **kw):
    def columns(s):
        return s.select("event_id", F.col("event_id").alias("event_id_"), "event_type", "user_id",
                        "value", cents("value").alias("cents"))
    return _running_replay(spark, events(spark, sf), name, plan or columns, "event_type",
                           "event_id", stages, ["event_id", "event_type"], **kw)


@query("q_stream_running_avg", ORACLE["q_running_avg"])
def q_stream_running_avg(spark, sf):
    """RUN-6 as a stream: running average per key, one row per input row."""
    out = _running_events(spark, sf, "q_stream_running_avg",
                          [[run_sum("cents", "_s"), run_count("_n")]])
    return out.select("event_id", "event_type",
                      (F.col("_s").cast("double") / F.col("_n") / 100).alias("running_avg"))


@query("q_stream_running_clicks", ORACLE["q_running_clicks"])
def q_stream_running_clicks(spark, sf):
    """RUN-11 as a stream: running clicks per site, per record."""
    return _running_events(spark, sf, "q_stream_running_clicks", [[run_count("clicks")]])


@query("q_stream_running_clicks_max", ORACLE["q_running_clicks_max"])
def q_stream_running_clicks_max(spark, sf):
    """RUN-12 as a stream: running clicks, then the running maximum of that count."""
    out = _running_events(spark, sf, "q_stream_running_clicks_max",
                          [[run_count("clicks")], [run_max("clicks", "max_clicks")]])
    return out.drop("clicks")


@query("q_stream_running_min_max", """
SELECT event_id, event_type, MIN(value) OVER w AS running_min, MAX(value) OVER w AS running_max
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_stream_running_min_max(spark, sf):
    """RUN-2/4 as a stream: running minimum and maximum per key, as doubles."""
    return _running_events(spark, sf, "q_stream_running_min_max",
                           [[run_min("value", "running_min"), run_max("value", "running_max")]])


@query("q_stream_running_min_by", ORACLE["q_running_min_by"])
def q_stream_running_min_by(spark, sf):
    """RUN-3 as a stream: the record holding the running minimum (earliest wins)."""
    out = _running_events(spark, sf, "q_stream_running_min_by", [[run_min_by(
        "value", "event_id", ["event_id_", "user_id", "value"], "min_by_")]])
    return out.withColumnRenamed("min_by_event_id_", "min_by_event_id")


@query("q_stream_running_max_by", ORACLE["q_running_max_by"])
def q_stream_running_max_by(spark, sf):
    """RUN-5 as a stream: the record holding the running maximum (earliest wins)."""
    out = _running_events(spark, sf, "q_stream_running_max_by", [[run_max_by(
        "value", "event_id", ["event_id_", "user_id", "value"], "max_by_")]])
    return out.withColumnRenamed("max_by_event_id_", "max_by_event_id")


@query("q_stream_running_sum", ORACLE["q_running_sum"])
def q_stream_running_sum(spark, sf):
    """RUN-1 as a stream: running sum with the key's first record's field."""
    out = _running_events(spark, sf, "q_stream_running_sum", [[
        run_sum("cents", "_s"), run_first("event_id", ["user_id"], "first_")]])
    return out.select("event_id", "event_type", money(F.col("_s")).alias("running_sum"),
                      "first_user_id")


def _running_orders(spark, sf, name, key, stages):
    rows = table(spark, sf, "orders")

    def plan(s):
        c = cents("o_totalprice")
        return s.select("o_orderkey", key, c.alias("cents"),
                        F.when(F.col("o_orderstatus") == "F", c)
                        .otherwise(F.lit(0).cast("long")).alias("fcents"))
    return _running_replay(spark, rows, name, plan, key, "o_orderkey", stages,
                           ["o_orderkey", key], seq="o_orderkey")


@query("q_stream_running_sum_max", ORACLE["q_running_sum_max"])
def q_stream_running_sum_max(spark, sf):
    """RUN-8 as a stream: running total per key, then the running maximum of it."""
    out = _running_orders(spark, sf, "q_stream_running_sum_max", "o_orderpriority",
                          [[run_sum("cents", "_t")], [run_max("_t", "_m")]])
    return out.select("o_orderkey", "o_orderpriority", money(F.col("_t")).alias("running_total"),
                      money(F.col("_m")).alias("running_max_total"))


def _finished_avg(spark, sf, name, key):
    out = _running_orders(spark, sf, name, key, [[run_sum("fcents", "_s"), run_count("_n")]])
    return out.select("o_orderkey", key,
                      (F.col("_s").cast("double") / F.col("_n") / 100).alias("running_avg"))


@query("q_stream_running_avg_source", ORACLE["q_running_avg_source"])
def q_stream_running_avg_source(spark, sf):
    """RUN-9 as a stream: running average per pickup, idle rows as 0."""
    return _finished_avg(spark, sf, "q_stream_running_avg_source", "o_orderpriority")


@query("q_stream_running_avg_driver", ORACLE["q_running_avg_driver"])
def q_stream_running_avg_driver(spark, sf):
    """RUN-10 as a stream: running average per driver over all rows."""
    return _finished_avg(spark, sf, "q_stream_running_avg_driver", "o_custkey")


@query("q_stream_word_count", ORACLE["q_running_word_count"])
def q_stream_word_count(spark, sf):
    """RUN-7 as a stream: running count of each prefix word over whole documents."""
    def plan(s):
        w = s.select("doc_id", F.posexplode(F.split("text", WORD_SPLIT)).alias("pos", "word"))
        return w.filter(F.col("word").startswith(WORD_PREFIX)).select(
            "doc_id", F.col("pos").cast("long").alias("pos"), "word")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return _running_replay(spark, docs, "q_stream_word_count", plan, "word", ["doc_id", "pos"],
                           [[run_count("running_count")]], ["doc_id", "pos", "word"],
                           seq="doc_id", width=WORD_DOC_BUCKET)


@query("q_stream_distinct", ORACLE["q_running_distinct"])
def q_stream_distinct(spark, sf):
    """RUN-13 as a stream: running distinct users per site, per record."""
    return _running_events(spark, sf, "q_stream_distinct", [[run_sum("is_new", "distinct_users")]],
                           lambda s: s.select("event_id", "event_type", "user_id"),
                           flags="user_id")


def _chunks(spark, sf, name, key, plan, emit, n=10):
    base = shared_dir(spark, "stream-out", name)
    writer = chunk_writer(spark, key, "event_id", n, emit, base, bucket_width(spark))
    _events_replay(spark, sf, name, plan, foreach_batch=writer)
    return spark.read.parquet(f"{base}/out").drop("epoch")


@query("q_stream_count_chunk", ORACLE["q_count_chunk_sum"])
def q_stream_count_chunk(spark, sf):
    """ST-1 as a stream: sum of every 10 values per key."""
    return _chunks(spark, sf, "q_stream_count_chunk", "user_id",
                   lambda s: s.select("event_id", "user_id", cents("value").alias("cents")),
                   lambda d: d.groupBy("user_id", "chunk_no").agg(
                       money(F.sum("cents")).alias("total")))


@query("q_stream_count_chunk_list", ORACLE["q_count_chunk_list"])
def q_stream_count_chunk_list(spark, sf):
    """ST-2 as a stream: the 10 values as text and their sum."""
    def emit(d):
        v = F.sort_array(F.collect_list(F.struct("arrival_no", "dec")))
        g = d.groupBy("user_id", "chunk_no").agg(v.alias("v"), F.sum("dec").alias("t"))
        return g.select("user_id", "chunk_no", F.concat(F.lit(" "), F.array_join(
            F.transform("v", lambda x: x["dec"].cast("string")), " ")).alias("values_text"),
            F.col("t").cast("double").alias("total"))
    return _chunks(spark, sf, "q_stream_count_chunk_list", "user_id", lambda s: s.select(
        "event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("dec")), emit)


@query("q_stream_count_chunk_reduce", ORACLE["q_count_chunk_reduce"])
def q_stream_count_chunk_reduce(spark, sf):
    """ST-3 as a stream: every 10 (key, value) pairs of an event type folded by
    the sum reducer; the hot keys are the 5 event types."""
    return _chunks(spark, sf, "q_stream_count_chunk_reduce", "event_type",
                   lambda s: s.select("event_id", "event_type", "user_id"),
                   lambda d: d.groupBy("event_type", "chunk_no").agg(
                       F.sum("user_id").alias("total")))


@query("q_stream_count_chunk_fold", ORACLE["q_count_chunk_fold"])
def q_stream_count_chunk_fold(spark, sf):
    """ST-3 as a stream with a reducer of the user's own: every 10 affine maps of an
    event type, one after another in order of arrival."""
    def emit(d):
        out = fold_chunks(d, "event_type", CHUNK_N, user_maps(), "f", bucket_width(spark))
        return out.select("event_type", "chunk_no", "f.a", "f.b")
    return _chunks(spark, sf, "q_stream_count_chunk_fold", "event_type",
                   lambda s: s.select("event_id", "event_type", "user_id"), emit)


def _bucketed(s):
    return s.select("event_id", F.pmod(F.col("user_id"), F.lit(4)).alias("bucket"))


@query("q_stream_fixed_batches", ORACLE["q_fixed_batches"])
def q_stream_fixed_batches(spark, sf):
    """SNK-6 as a stream: batches of exactly 100 per buffer; the rest waits."""
    return _chunks(spark, sf, "q_stream_fixed_batches", "bucket", _bucketed,
                   lambda d: d.groupBy("bucket", F.col("chunk_no").alias("batch_no")).agg(
                       F.count(F.lit(1)).alias("n_rows"),
                       F.min("event_id").alias("first_event_id"),
                       F.max("event_id").alias("last_event_id")), 100)


@query("q_stream_released_rows", f"""
WITH r AS (SELECT event_id, user_id % 4 AS bucket,
                  (ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1) // 100
                    AS batch_no FROM events),
t AS (SELECT bucket, COUNT(*) // 100 AS full_batches FROM r GROUP BY bucket)
SELECT r.bucket, r.batch_no, r.event_id FROM r JOIN t USING (bucket)
WHERE r.batch_no < t.full_batches""")
def q_stream_released_rows(spark, sf):
    """SNK-6 as a stream, row form: every row released in a batch of exactly 100
    per buffer, with its batch number; the incomplete remainder waits."""
    return _chunks(spark, sf, "q_stream_released_rows", "bucket", _bucketed,
                   lambda d: d.select("bucket", F.col("chunk_no").alias("batch_no"), "event_id"),
                   100)


@query("q_released_rows", ORACLE.get("q_stream_released_rows") or "")
def q_released_rows(spark, sf):
    """SNK-6 batch form, row level: the rows of every full batch of 100 per buffer."""
    from keyfold.operators.count_window import fixed_batches
    from keyfold.plans.registry import bucket_width
    b = fixed_batches(events(spark, sf).select("event_id", "user_id"),
                      F.pmod(F.col("user_id"), F.lit(4)), "event_id", 100, bucket_width(spark))
    return b.select("bucket", "batch_no", "event_id")


def _windowed(size, slide=None):
    def plan(s):
        s = _real(event_time(s, "ts", LATENESS)).withColumn("cents", cents("value"))
        return tumbling_stream(s, "ts", size, "event_type", [
            F.min_by("user_id", "event_id").alias("first_user_id"),
            F.count(F.lit(1)).alias("n"), F.sum("cents").alias("_c")], slide=slide)
    return plan


@query("q_stream_tumbling", ORACLE["q_tumbling"])
def q_stream_tumbling(spark, sf):
    """WIN-1 as a stream: event-time tumbling windows with a watermark."""
    out = _events_replay(spark, sf, "q_stream_tumbling", _windowed("1 day"), end_marker=True)
    return out.select("window_start", "window_end", "event_type", "first_user_id", "n",
                      money(F.col("_c")).alias("total_value"))


@query("q_stream_sliding", ORACLE["q_sliding"])
def q_stream_sliding(spark, sf):
    """WIN-2 as a stream: sliding windows (2 days every day)."""
    out = _events_replay(spark, sf, "q_stream_sliding", _windowed("2 days", "1 day"),
                         end_marker=True)
    return out.select("window_start", "window_end", "event_type", "first_user_id", "n",
                      money(F.col("_c")).alias("total_value"))


@query("q_stream_window_avg_time", ORACLE["q_window_avg_time"])
def q_stream_window_avg_time(spark, sf):
    """WIN-6 + PRJ-13 as a stream: integer average time per site and window."""
    def plan(s):
        s = _real(event_time(s, "ts", LATENESS)).withColumn("t", F.floor("value").cast("long"))
        return tumbling_stream(s, "ts", "1 day", "event_type", [
            F.sum("t").alias("t"), F.count(F.lit(1)).alias("n")])
    out = _events_replay(spark, sf, "q_stream_window_avg_time", plan, end_marker=True)
    return out.select("window_start", "window_end", "event_type",
                      int_average(F.col("t"), F.col("n")).alias("avg_time"))


def _previous_windows(spark, sf, name, plan, with_previous):
    """Closed windows beside the key's previous one; what the writer wrote."""
    base = shared_dir(spark, "stream-out", name)
    writer = previous_window_writer(spark, "event_type", with_previous, base)
    _events_replay(spark, sf, name, plan, end_marker=True, foreach_batch=writer)
    return spark.read.parquet(f"{base}/out").drop("epoch")


@query("q_stream_large_delta", ORACLE["q_large_delta"])
def q_stream_large_delta(spark, sf):
    """WIN-10 as a stream: alert when a window's maximum moved more than the threshold."""
    def plan(s):
        s = _real(event_time(s, "ts", LATENESS))
        return tumbling_stream(s, "ts", DELTA_WINDOW, "event_type", [
            F.max("value").alias("cur_max"),
            F.min_by(F.col("ts").cast("timestamp_ntz"), F.struct(
                (-F.col("value")).alias("p"), F.col("event_id").alias("s"))).alias("max_stamp")])
    return _previous_windows(spark, sf, "q_stream_large_delta", plan,
                             lambda w: alerts(w, "event_type", DELTA_THRESHOLD_PCT))


def _window_top(largest):
    def plan(s):
        return window_top_stream(_real(event_time(s, "ts", LATENESS)), "ts", "1 day",
                                 "event_type", largest)
    return plan


@query("q_stream_window_max_clicks", ORACLE["q_window_max_clicks"])
def q_stream_window_max_clicks(spark, sf):
    """WIN-3 -> WIN-4 as a stream: per window, the site with the most clicks."""
    return _events_replay(spark, sf, "q_stream_window_max_clicks", _window_top(True),
                          end_marker=True)


@query("q_stream_window_min_clicks", ORACLE["q_window_min_clicks"])
def q_stream_window_min_clicks(spark, sf):
    """WIN-3 -> WIN-5 as a stream: per window, the site with the fewest clicks."""
    return _events_replay(spark, sf, "q_stream_window_min_clicks", _window_top(False),
                          end_marker=True)


@query("q_stream_session", ORACLE["q_session_sum"])
def q_stream_session(spark, sf):
    """WIN-7 as a stream: global event-time sessions, gap 10 minutes, each
    micro-batch sessionised by the distributed batch operator (open sessions
    kept as state between epochs)."""
    base = shared_dir(spark, "stream-out", "session")
    writer = session_writer(spark, "ts", "10 minutes", "cents", "event_id", LATENESS,
                            f"{base}/state", f"{base}/out")
    _events_replay(spark, sf, "q_stream_session",
                   lambda s: s.select("event_id", "ts", cents("value").alias("cents")),
                   foreach_batch=writer, end_marker=True)
    out = spark.read.parquet(f"{base}/out")
    return out.select("session_start", "session_end", "n",
                      money(F.col("total")).alias("total_value"))


def _disorder_sql(slices: int = 4, gap: str = "INTERVAL 10 MINUTE", late: str = "INTERVAL 3 DAY"):
    """The same arrivals step by step: slice p of the events (event_id modulo
    ``slices``) meets the sessions still open, what ended before the watermark
    of the slices before it is dropped, what the next watermark passes is out."""
    steps = [f"""a AS (SELECT event_id, ts, CAST(ROUND(value * 100) AS BIGINT) AS c,
      event_id % {slices} AS p FROM events),
    open0 AS (SELECT ts AS s, ts AS e, 0 AS n, c, event_id AS i FROM a WHERE false)"""]
    for p in range(slices):
        mark = lambda k: f"(SELECT max(ts) - {late} FROM a WHERE p < {k})"
        last = p == slices - 1
        steps.append(f"""
    in{p} AS (SELECT ts AS s, ts AS e, 1 AS n, c, event_id AS i FROM a WHERE p = {p}
      UNION ALL SELECT * FROM open{p}),
    far{p} AS (SELECT *, max(e) OVER (ORDER BY s, i ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING) AS reach FROM in{p}),
    isl{p} AS (SELECT *, sum(CASE WHEN reach IS NULL OR s - reach > {gap} THEN 1 ELSE 0 END)
      OVER (ORDER BY s, i ROWS UNBOUNDED PRECEDING) AS g FROM far{p}),
    ses{p} AS (SELECT * FROM (SELECT min(s) AS s, max(e) AS e, sum(n) AS n, sum(c) AS c,
      min(i) AS i FROM isl{p} GROUP BY g)
      WHERE {mark(p)} IS NULL OR e + {gap} >= {mark(p)}),
    done{p} AS (SELECT * FROM ses{p} WHERE {str(last).lower()} OR e + {gap} < {mark(p + 1)}),
    open{p + 1} AS (SELECT * FROM ses{p} WHERE NOT {str(last).lower()}
      AND e + {gap} >= {mark(p + 1)})""")
    found = " UNION ALL ".join(f"SELECT * FROM done{p}" for p in range(slices))
    return f"""WITH {",".join(steps)}
    SELECT s AS session_start, e + {gap} AS session_end, CAST(n AS BIGINT) AS n,
           CAST(c AS DOUBLE) / 100 AS total_value FROM ({found})"""


@query("q_stream_session_disorder", _disorder_sql())
def q_stream_session_disorder(spark, sf):
    """WIN-7, WM-1, WM-3: sessions of rows that arrive out of order, some within
    the lateness (3 days) and many behind it."""
    base = shared_dir(spark, "stream-out", "session_disorder")
    writer = session_writer(spark, "ts", "10 minutes", "cents", "event_id", "3 days",
                            f"{base}/state", f"{base}/out")
    rows = events(spark, sf).select("event_id", "ts", cents("value").alias("cents")) \
        .withColumn("slice", F.col("event_id") % 4)
    from datetime import datetime
    replay(spark, rows, "slice", 4, "q_stream_session_disorder", lambda s: s,
           foreach_batch=writer, end_marker={
               "event_id": END_EVENT_ID, "ts": datetime.fromisoformat(END_OF_INPUT_TS), "cents": 0})
    out = spark.read.parquet(f"{base}/out")
    return out.filter(F.col("session_start") < F.lit(END_OF_INPUT_TS).cast("timestamp_ntz")).select(
        "session_start", "session_end", "n", money(F.col("total")).alias("total_value"))


@query("q_stream_session_keyed", """
WITH o AS (SELECT event_type, ts, event_id, CAST(ROUND(value * 100) AS BIGINT) AS c,
                  LAG(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_ts
           FROM events),
f AS (SELECT *, CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 1 HOUR
                     THEN 1 ELSE 0 END AS brk FROM o),
i AS (SELECT *, SUM(brk) OVER (PARTITION BY event_type ORDER BY ts, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM f)
SELECT event_type, MIN(ts) AS session_start, MAX(ts) + INTERVAL 1 HOUR AS session_end,
       COUNT(*) AS n, CAST(SUM(c) AS DOUBLE) / 100 AS total_value
FROM i GROUP BY event_type, isl""")
def q_stream_session_keyed(spark, sf):
    """WIN-7 keyed form as a stream: Spark's own session window per key
    (gap 1 hour) with a watermark; per-key state in the state store."""
    def plan(s):
        s = _real(event_time(s, "ts", LATENESS)).withColumn("cents", cents("value"))
        return session_stream(s, "ts", "1 hour",
                              [F.count(F.lit(1)).alias("n"), F.sum("cents").alias("_c")],
                              key="event_type")
    out = _events_replay(spark, sf, "q_stream_session_keyed", plan, end_marker=True)
    return out.select("event_type", "session_start", "session_end", "n",
                      money(F.col("_c")).alias("total_value"))


_CHANGE_COLS = ["window_start", "window_end", "event_type", "first_stamp", "last_stamp",
                "max_price", "min_price", "max_volume", "min_volume"]


@query("q_stream_window_change", ORACLE["q_window_change"])
def q_stream_window_change(spark, sf):
    """WIN-9 as a stream: window statistics beside those of the key's previous window."""
    def plan(s):
        s = _real(event_time(s, "ts", LATENESS)).withColumn(
            "volume", F.get_json_object("props", "$.k").cast("int"))
        return tumbling_stream(s, "ts", "1 day", "event_type", [
            F.min_by("ts", "event_id").cast("timestamp_ntz").alias("first_stamp"),
            F.max_by("ts", "event_id").cast("timestamp_ntz").alias("last_stamp"),
            F.max("value").alias("max_price"), F.min("value").alias("min_price"),
            F.max("volume").alias("max_volume"), F.min("volume").alias("min_volume")])
    out = _previous_windows(spark, sf, "q_stream_window_change", plan,
                            lambda w: window_change(w, "event_type"))
    return out.select(*_CHANGE_COLS, "price_change_pct", "volume_change_pct")


@query("q_stream_exclude", f"""
SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = '{EXCLUDE_TYPE}' AND value > {EXCLUDE_ABOVE})""")
def q_stream_exclude(spark, sf):
    """JN-1 as a stream: stream-static anti join against the exclusion list."""
    ex = events(spark, sf).filter((F.col("event_type") == EXCLUDE_TYPE)
                                  & (F.col("value") > EXCLUDE_ABOVE))

    def plan(s):
        return exclude_stream(s.select("event_id", "user_id", "event_type"), ex, "user_id")
    out = _events_replay(spark, sf, "q_stream_exclude", plan)
    return out.select("event_id", "user_id", "event_type")


@query("q_stream_running_dept_count", ORACLE["q_running_dept_count"])
def q_stream_running_dept_count(spark, sf):
    """RUN-14 as a stream: exclusion list (stream-static anti join), then the
    running count per department, one row per surviving record."""
    ex = events(spark, sf).filter((F.col("event_type") == EXCLUDE_TYPE)
                                  & (F.col("value") > EXCLUDE_ABOVE))

    return _running_events(
        spark, sf, "q_stream_running_dept_count", [[run_count("running_count")]],
        lambda s: exclude_stream(s.select("event_id", "user_id", "event_type"), ex, "user_id"))


@query("q_stream_excluded_asof", ORACLE["q_excluded_asof"])
def q_stream_excluded_asof(spark, sf):
    """JN-2 as a stream: the exclusion list grows while the stream runs; an
    announcement affects only rows handled after it."""
    base = shared_dir(spark, "stream-out", "excluded_asof")
    writer = exclude_asof_writer(
        spark, "user_id", "ts",
        (F.col("event_type") == EXCLUDE_TYPE) & (F.col("value") > EXCLUDE_ABOVE),
        f"{base}/list", f"{base}/out")
    _events_replay(spark, sf, "q_stream_excluded_asof",
                   lambda s: s.select("event_id", "user_id", "event_type", "ts", "value"),
                   foreach_batch=writer)
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type")


@query("q_stream_excluded_sources", ORACLE["q_excluded_asof"])
def q_stream_excluded_sources(spark, sf):
    """JN-1/2, ST-7 with two live sources: events arrive in four pieces, the list of
    excluded users from a source of its own in three, which first lags and then leads."""
    ev = events(spark, sf)
    rows = ev.select("event_id", "user_id", "event_type", "ts")
    ex = ev.filter((F.col("event_type") == EXCLUDE_TYPE) & (F.col("value") > EXCLUDE_ABOVE)) \
        .select("user_id", "ts", "event_id")
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    if lo is None:
        return rows.drop("ts")

    def part(df, a, b):  # a to b: shares of the range of ids, the last one open
        at = (F.col("event_id") - lo) / (hi - lo + 1)
        return df.filter((at >= a) & (at < b))

    from datetime import datetime
    end = {"ts": datetime.fromisoformat(END_OF_INPUT_TS)}
    last = {"main": one_row(spark, rows, {**end, "event_id": END_EVENT_ID, "event_type": "~end"}),
            "list": one_row(spark, ex, {**end, "user_id": -1})}
    steps = [{"main": part(rows, 0, .25)}, {"main": part(rows, .25, .5), "list": part(ex, 0, .1)},
             {"list": part(ex, .1, .9)}, {"main": part(rows, .5, .75), "list": part(ex, .9, 1)},
             {"main": part(rows, .75, 1)}, last, last]

    def plan(s):
        return two_sources(s["main"], s["list"], "user_id", "ts", "ts")
    base = shared_dir(spark, "stream-out", "excluded_sources")
    play(spark, steps, "q_stream_excluded_sources", plan, foreach_batch=exclude_sources_writer(
        spark, "user_id", "ts", LATENESS, f"{base}/state", f"{base}/out"))
    out = spark.read.parquet(f"{base}/out")
    return out.filter(F.col("event_id") != END_EVENT_ID).select("event_id", "user_id", "event_type")


ARRIVALS = [1_000_000_000 + t for t in (0, 1, 3, 3, 7)]  # seconds since 1970
_ARRIVAL_SQL = f"""(
  SELECT *, TIMESTAMP '1970-01-01' + to_seconds(list_value({", ".join(map(str, ARRIVALS))})
    [1 + CAST((event_id - lo) // step AS INTEGER)]) AS arrived
  FROM events, (SELECT min(event_id) AS lo,
    (max(event_id) - min(event_id)) // {len(ARRIVALS)} + 1 AS step FROM events))"""


def _arrivals(spark, sf, name, slide=None):
    """Windows of 2 s on the modification times of the files that events come in."""
    ev = events(spark, sf)
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    n = len(ARRIVALS)
    step = ((hi or 0) - (lo or 0)) // n + 1
    steps = [{"in": ev.filter(F.expr(f"(event_id - {lo or 0}) div {step} = {i}"))} for i in range(n)]
    marker = {"in": one_row(spark, ev, {"event_type": "~end"})}

    def plan(s):
        s = s["in"].withColumn("arrival", F.col("_metadata.file_modification_time")) \
            .withColumn("cents", cents("value"))
        return arrival_windows(s, "2 seconds", "event_type", [
            F.min_by("user_id", "event_id").alias("first_user_id"), F.sum("cents").alias("_c"),
            F.count(F.lit(1)).alias("n")], slide, "arrival")
    out = play(spark, [*steps, marker, marker], name, plan,
               times=[*ARRIVALS, ARRIVALS[-1] + 3600, ARRIVALS[-1] + 7200])
    return out.filter(F.col("event_type") != "~end").select(
        "window_start", "window_end", "event_type", "first_user_id", "n",
        money(F.col("_c")).alias("total_value"))


@query("q_stream_arrival_tumbling", f"""
SELECT time_bucket(INTERVAL 2 SECOND, arrived, TIMESTAMP '1970-01-01') AS window_start,
       window_start + INTERVAL 2 SECOND AS window_end, event_type,
       arg_min(user_id, event_id) AS first_user_id, COUNT(*) AS n,
       CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_value
FROM {_ARRIVAL_SQL} e GROUP BY ALL""")
def q_stream_arrival_tumbling(spark, sf):
    """WIN-1 as written: tumbling windows of 2 s on the time of arrival, which is
    the modification time of the file a row came in."""
    return _arrivals(spark, sf, "q_stream_arrival_tumbling")


@query("q_stream_arrival_sliding", f"""
SELECT time_bucket(INTERVAL 1 SECOND, arrived, TIMESTAMP '1970-01-01') - to_seconds(o) AS window_start,
       window_start + INTERVAL 2 SECOND AS window_end, event_type,
       arg_min(user_id, event_id) AS first_user_id, COUNT(*) AS n,
       CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_value
FROM {_ARRIVAL_SQL} e, (VALUES (0), (1)) AS t(o) GROUP BY ALL""")
def q_stream_arrival_sliding(spark, sf):
    """WIN-2 as written: windows of 2 s every second on the time of arrival."""
    return _arrivals(spark, sf, "q_stream_arrival_sliding", "1 second")


_SALES = """(SELECT event_id, strftime(ts, '%d-%m-%Y') || ',' || monthname(ts)
  || CASE WHEN event_id % 17 = 0 THEN '' ELSE ',' || event_type || ',u' || user_id || ','
     || CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END END AS line
FROM events)"""


@query("q_stream_rejects", f"""
SELECT CASE WHEN event_id % 17 = 0 OR event_id % 13 = 0 THEN 'rejected' ELSE 'good' END AS output,
       line, CASE WHEN event_id % 17 = 0 THEN 'bad field: category;product;profit'
                  WHEN event_id % 13 = 0 THEN 'bad field: profit' END AS reason
FROM {_SALES} s""")
def q_stream_rejects(spark, sf):
    """PRJ-1 on a stream, with its rejects: text lines, some too short or not numbers,
    go to a table of good rows and to one of bad lines with the reason."""
    e = events(spark, sf)
    rest = F.concat(F.lit(","), "event_type", F.lit(",u"), F.col("user_id").cast("string"), F.lit(","),
                    F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.col("event_id").cast("string")))
    line = F.concat(F.date_format("ts", "dd-MM-yyyy"), F.lit(","), F.date_format("ts", "MMMM"),
                    F.when(F.col("event_id") % 17 == 0, "").otherwise(rest))
    base = shared_dir(spark, "stream-out", "rejects")
    replay(spark, e.select("event_id", line.alias("value")), "event_id", REPLAY_PIECES,
           "q_stream_rejects", lambda s: s.select("value"),
           foreach_batch=reject_writer(parse_sales, f"{base}/good", f"{base}/bad"))
    good, bad = spark.read.parquet(f"{base}/good"), spark.read.parquet(f"{base}/bad")
    return good.select(F.lit("good").alias("output"), F.concat_ws(
        ",", "date", "month", "category", "product", "profit").alias("line"),
        F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.lit("rejected").alias("output"), F.col("bad_line").alias("line"), "reason"))


_LATE_SQL = """(
  SELECT e.event_id, event_type, ts, event_id % 4 AS slice, m.top - INTERVAL 3 DAY AS watermark,
         coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= m.top - INTERVAL 3 DAY, false) AS late
  FROM events e LEFT JOIN (SELECT s.x AS x, max(ts) AS top FROM (VALUES (0), (1), (2), (3)) s(x)
    JOIN events ON event_id % 4 < s.x GROUP BY s.x) m ON m.x = event_id % 4)"""


def _late(spark, sf, name):
    base = shared_dir(spark, "stream-out", name)
    writer = late_writer(spark, "ts", "1 day", "3 days", *[f"{base}/{x}" for x in (
        "state", "on_time", "late", "counts")])
    rows = events(spark, sf).select("event_id", "event_type", "ts", (F.col("event_id") % 4).alias("slice"))
    replay(spark, rows, "slice", 4, name, lambda s: s, foreach_batch=writer)
    return base


@query("q_stream_late_rows", f"""
SELECT event_id, event_type, CAST(ts AS TIMESTAMP) AS ts, CAST(watermark AS TIMESTAMP) AS watermark
FROM {_LATE_SQL} l WHERE late""")
def q_stream_late_rows(spark, sf):
    """WM-3 with the late rows kept: rows out of order, of whose daily window the
    watermark in force (3 days behind) says that it is closed, with that watermark."""
    base = _late(spark, sf, "q_stream_late_rows")
    return spark.read.parquet(f"{base}/late").select("event_id", "event_type", "ts", "watermark")


@query("q_stream_on_time_windows", f"""
SELECT 'window' AS kind, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type,
       COUNT(*) AS n FROM {_LATE_SQL} l WHERE NOT late GROUP BY ALL
UNION ALL
SELECT CASE WHEN late THEN 'late' ELSE 'on time' END, NULL, NULL, COUNT(*) FROM {_LATE_SQL} l
GROUP BY late""")
def q_stream_on_time_windows(spark, sf):
    """WM-3, WIN-3: keyed daily windows of the rows that are on time, and how many
    rows were and were not, as observed while they were written."""
    base = _late(spark, sf, "q_stream_on_time_windows")
    rows = spark.read.parquet(f"{base}/on_time")
    per = tumbling(rows, "ts", "1 day", "event_type", [F.count(F.lit(1)).alias("n")])
    seen = spark.read.parquet(f"{base}/counts").agg(F.sum("on_time").alias("on time"),
                                                    F.sum("late").alias("late"))
    seen = seen.unpivot([], ["on time", "late"], "kind", "n").filter("n > 0")
    return per.select(F.lit("window").alias("kind"), "window_start", "event_type", "n").unionByName(
        seen, allowMissingColumns=True)


@query("q_stream_rolled_files", """
WITH p AS (
  SELECT event_id, (event_id - lo) // step AS piece,
         length(CAST(event_id AS VARCHAR)) + 1
           + CASE WHEN event_id % 50 = 0 THEN 3000 ELSE event_id % 10 END AS bytes
  FROM events, (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) // 4 + 1 AS step FROM events)),
r AS (SELECT *, SUM(bytes) OVER (PARTITION BY piece ORDER BY event_id) - bytes AS start FROM p)
SELECT CAST(piece AS INTEGER) AS epoch, CAST(start // 4096 AS INTEGER) AS file_no, COUNT(*) AS n,
       CAST(SUM(bytes) AS BIGINT) AS bytes, MIN(event_id) AS first_id, MAX(event_id) AS last_id
FROM r GROUP BY ALL""")
def q_stream_rolled_files(spark, sf):
    """SNK-4 rolled by bytes: lines of very different length in files of 4 KB and one
    line more at most; the bytes are those of the files written."""
    path = shared_dir(spark, "stream-out", "rolled")
    long = F.when(F.col("event_id") % 50 == 0, 3000).otherwise(F.col("event_id") % 10).cast("int")
    line = F.concat(F.col("event_id").cast("string"), F.repeat(F.lit("."), long))
    replay(spark, events(spark, sf).select("event_id"), "event_id", REPLAY_PIECES,
           "q_stream_rolled_files", lambda s: s, foreach_batch=rolling_writer(
               path, "event_id", 4096, bucket_width(spark), line))
    return rolled_summary(spark, path)


def rolled_summary(spark, path):
    """Lines, bytes, first and last id of every file that ``rolling_writer`` wrote."""
    def per_file(lines):
        return lines.withColumn("id", F.regexp_extract("value", r"^-?\d+", 0).cast("long")) \
            .groupBy("epoch", "file_no", "file").agg(
                F.count(F.lit(1)).alias("n"), F.max("size").alias("bytes"),
                F.min("id").alias("first_id"), F.max("id").alias("last_id"))

    return rolled_lines(spark, path, per_file).groupBy("epoch", "file_no").agg(
        F.sum("n").alias("n"), F.max("bytes").alias("bytes"), F.min("first_id").alias("first_id"),
        F.max("last_id").alias("last_id"), F.count_distinct("file").alias("_files")) \
        .filter("_files = 1").drop("_files")


@query("q_stream_split", """
SELECT 'all' AS output, CAST(CAST(event_id AS INTEGER) AS VARCHAR) AS v FROM events
UNION ALL
SELECT 'even', CAST(CAST(event_id AS INTEGER) AS VARCHAR) FROM events WHERE event_id % 2 = 0
UNION ALL
SELECT 'odd', CAST(CAST(event_id AS INTEGER) AS VARCHAR) FROM events WHERE event_id % 2 <> 0""")
def q_stream_split(spark, sf):
    """SPL-1 as a stream: one foreachBatch writes the main and both side outputs."""
    from keyfold.operators.split import split_parity
    base = shared_dir(spark, "stream-out", "split")
    targets = {k: f"{base}/{k}" for k in ("all", "even", "odd")}
    outputs = {k: (lambda b, k=k: split_parity(b, "event_id")[k]) for k in targets}
    _events_replay(spark, sf, "q_stream_split", lambda s: s.select("event_id"),
                   foreach_batch=split_stream(outputs, targets))
    parts = [spark.read.parquet(t).select(F.lit(k).alias("output"),
                                          F.col("v").cast("string").alias("v"))
             for k, t in targets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
