"""Time windows on the events table (WIN-1..10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyfold.functions.format import alert_report, int_average, stamp, window_report
from keyfold.operators.sessions import session_windows
from keyfold.operators.window_change import large_delta, window_change, window_stats
from keyfold.operators.windows import sliding, tumbling, window_top
from keyfold.plans.registry import CENTS_SQL, cents, events, money, query

# Fixed query parameters
DAY = "1 day"
SLIDE_SIZE, SLIDE_STEP = "2 days", "1 day"
SESSION_GAP = "10 minutes"
DELTA_WINDOW = "1 day"
DELTA_THRESHOLD_PCT = 5.0

_CENTS = CENTS_SQL.format(c="value")
_DAY_START = "CAST(date_trunc('day', ts) AS TIMESTAMP)"
_VOLUME_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _ev(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", "ts", "user_id", "event_type", "value",
                    cents("value").alias("cents"),
                    F.get_json_object("props", "$.k").cast("int").alias("volume"))


def _window_aggs():
    return [F.min_by("user_id", "event_id").alias("first_user_id"),
            F.sum("cents").alias("_c"), F.count(F.lit(1)).alias("n")]


def _finish(df):
    return df.select(*[c for c in df.columns if c != "_c"],
                     money(F.col("_c")).alias("total_value"))


@query("q_tumbling", f"""
SELECT {_DAY_START} AS window_start, {_DAY_START} + INTERVAL 1 DAY AS window_end, event_type,
       arg_min(user_id, event_id) AS first_user_id, COUNT(*) AS n,
       CAST(SUM({_CENTS}) AS DOUBLE) / 100 AS total_value
FROM events GROUP BY ALL""")
def q_tumbling(spark, sf):
    """WIN-1: tumbling window per key: first record's field, sum, count."""
    return _finish(tumbling(_ev(spark, sf), "ts", DAY, "event_type", _window_aggs()))


@query("q_sliding", f"""
WITH x AS (SELECT *, {_DAY_START} - INTERVAL (o) DAY AS window_start
           FROM events, (VALUES (0), (1)) AS t(o))
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, event_type,
       arg_min(user_id, event_id) AS first_user_id, COUNT(*) AS n,
       CAST(SUM({_CENTS}) AS DOUBLE) / 100 AS total_value
FROM x GROUP BY ALL""")
def q_sliding(spark, sf):
    """WIN-2: sliding windows (2 days every day); a row is in two windows."""
    return _finish(sliding(_ev(spark, sf), "ts", SLIDE_SIZE, SLIDE_STEP, "event_type",
                           _window_aggs()))


_WCLICKS_SQL = (f"(SELECT {_DAY_START} AS window_start, {_DAY_START} + INTERVAL 1 DAY "
                f"AS window_end, event_type, COUNT(*) AS clicks FROM events GROUP BY ALL)")


def _window_clicks(spark, sf):
    return tumbling(_ev(spark, sf), "ts", DAY, "event_type",
                    [F.count(F.lit(1)).alias("clicks")])


@query("q_window_clicks", f"SELECT * FROM {_WCLICKS_SQL} c")
def q_window_clicks(spark, sf):
    """WIN-3: clicks per site per window."""
    return _window_clicks(spark, sf)


@query("q_window_max_clicks", f"""
SELECT window_start, window_end, event_type, clicks FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start
                               ORDER BY clicks DESC, event_type) AS rn
  FROM {_WCLICKS_SQL} c) WHERE rn = 1""")
def q_window_max_clicks(spark, sf):
    """WIN-4: per window, the site with the most clicks (ties -> smallest)."""
    return window_top(_window_clicks(spark, sf), "event_type", "clicks", largest=True)


@query("q_window_min_clicks", f"""
SELECT window_start, window_end, event_type, clicks FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start
                               ORDER BY clicks ASC, event_type) AS rn
  FROM {_WCLICKS_SQL} c) WHERE rn = 1""")
def q_window_min_clicks(spark, sf):
    """WIN-5: per window, the site with the fewest clicks."""
    return window_top(_window_clicks(spark, sf), "event_type", "clicks", largest=False)


@query("q_window_avg_time", f"""
SELECT {_DAY_START} AS window_start, {_DAY_START} + INTERVAL 1 DAY AS window_end, event_type,
       SUM(CAST(FLOOR(value) AS BIGINT)) // COUNT(*) AS avg_time
FROM events GROUP BY ALL""")
def q_window_avg_time(spark, sf):
    """WIN-6 + PRJ-13: integer average time spent per site per window."""
    e = _ev(spark, sf).withColumn("t", F.floor("value").cast("long"))
    g = tumbling(e, "ts", DAY, "event_type",
                 [F.sum("t").alias("_t"), F.count(F.lit(1)).alias("_n")])
    return g.select("window_start", "window_end", "event_type",
                    int_average(F.col("_t"), F.col("_n")).alias("avg_time"))


@query("q_session_sum", f"""
WITH o AS (SELECT ts, event_id, {_CENTS} AS c,
                  LAG(ts) OVER (ORDER BY ts, event_id) AS prev_ts FROM events),
f AS (SELECT *, CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 10 MINUTE
                     THEN 1 ELSE 0 END AS brk FROM o),
i AS (SELECT *, SUM(brk) OVER (ORDER BY ts, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM f)
SELECT MIN(ts) AS session_start, MAX(ts) + INTERVAL 10 MINUTE AS session_end,
       COUNT(*) AS n, CAST(SUM(c) AS DOUBLE) / 100 AS total_value
FROM i GROUP BY isl""")
def q_session_sum(spark, sf):
    """WIN-7: global event-time session windows (gap 10 min), sum of values."""
    s = session_windows(_ev(spark, sf), "ts", SESSION_GAP, "cents", "event_id")
    return s.select("session_start", "session_end", "n",
                    money(F.col("total")).alias("total_value"))


_STATS_SQL = f"""(
SELECT {_DAY_START} AS window_start, {_DAY_START} + INTERVAL 1 DAY AS window_end, event_type,
       arg_min(ts, event_id) AS first_stamp, arg_max(ts, event_id) AS last_stamp,
       MAX(value) AS max_price, MIN(value) AS min_price,
       MAX({_VOLUME_SQL}) AS max_volume, MIN({_VOLUME_SQL}) AS min_volume
FROM events GROUP BY ALL)"""


def _stats(spark, sf):
    return window_stats(_ev(spark, sf), "ts", DAY, "event_type", "event_id", "value",
                        "volume", F.col("ts"))


@query("q_window_stats", f"SELECT * FROM {_STATS_SQL} s")
def q_window_stats(spark, sf):
    """WIN-8: per window and symbol: first/last stamp, max/min price and volume."""
    return _stats(spark, sf)


@query("q_window_change", f"""
SELECT *,
  CASE WHEN LAG(max_price) OVER w IS NULL OR LAG(max_price) OVER w = 0 THEN 0.0
       ELSE (max_price - LAG(max_price) OVER w) / LAG(max_price) OVER w * 100.0 END
    AS price_change_pct,
  CASE WHEN LAG(max_volume) OVER w IS NULL OR LAG(max_volume) OVER w = 0 THEN 0.0
       ELSE CAST(max_volume - LAG(max_volume) OVER w AS DOUBLE)
            / CAST(LAG(max_volume) OVER w AS DOUBLE) * 100.0 END AS volume_change_pct
FROM {_STATS_SQL} s WINDOW w AS (PARTITION BY event_type ORDER BY window_start)""")
def q_window_change(spark, sf):
    """WIN-9: percent change of max price / max volume vs the previous window."""
    return window_change(_stats(spark, sf), "event_type")


@query("q_large_delta", f"""
WITH p AS (
  SELECT {_DAY_START} AS window_start, {_DAY_START} + INTERVAL 1 DAY AS window_end, event_type,
         MAX(value) AS cur_max, arg_min(ts, row(-value, event_id)) AS max_stamp
  FROM events GROUP BY ALL),
q AS (SELECT *, LAG(cur_max) OVER (PARTITION BY event_type ORDER BY window_start) AS prev_max
      FROM p)
SELECT window_start, window_end, event_type, (cur_max - prev_max) / prev_max * 100.0
       AS change_pct, prev_max, cur_max, max_stamp
FROM q WHERE prev_max IS NOT NULL AND prev_max <> 0
  AND abs((cur_max - prev_max) / prev_max * 100.0) > {DELTA_THRESHOLD_PCT}""")
def q_large_delta(spark, sf):
    """WIN-10: alert when the window's max moved more than the threshold."""
    return large_delta(_ev(spark, sf), "ts", DELTA_WINDOW, "event_type", "event_id", "value",
                       F.col("ts"), DELTA_THRESHOLD_PCT)


_STAMP_SQL = "strftime({c}, '%d/%m/%Y') || ':' || strftime({c}, '%H:%M:%S')"
# Java's %.2f rounds an exact binary tie (x * 8 integral, third decimal 5) away
# from zero; printf rounds it to even.  The oracle nudges exactly those ties.
_JAVA_2F = ("CASE WHEN {x} * 8 = floor({x} * 8) AND abs({x} * 1000) % 10 = 5 "
            "THEN printf('%.2f', {x} + sign({x}) * 0.001) ELSE printf('%.2f', {x}) END")


def _stamp(c):
    return stamp(F.date_format(c, "dd/MM/yyyy"), F.date_format(c, "HH:mm:ss"))


@query("q_window_report", f"""
WITH c AS (
  SELECT *,
    CASE WHEN LAG(max_price) OVER w IS NULL OR LAG(max_price) OVER w = 0 THEN 0.0
         ELSE (max_price - LAG(max_price) OVER w) / LAG(max_price) OVER w * 100.0 END AS pc,
    CASE WHEN LAG(max_volume) OVER w IS NULL OR LAG(max_volume) OVER w = 0 THEN 0.0
         ELSE CAST(max_volume - LAG(max_volume) OVER w AS DOUBLE)
              / CAST(LAG(max_volume) OVER w AS DOUBLE) * 100.0 END AS vc
  FROM {_STATS_SQL} s WINDOW w AS (PARTITION BY event_type ORDER BY window_start))
SELECT window_start, event_type,
       {_STAMP_SQL.format(c='first_stamp')} || ' - ' || {_STAMP_SQL.format(c='last_stamp')}
       || ', ' || CAST(max_price AS VARCHAR) || ', ' || CAST(min_price AS VARCHAR) || ', '
       || {_JAVA_2F.format(x='pc')} || ', ' || CAST(max_volume AS VARCHAR) || ', '
       || CAST(min_volume AS VARCHAR) || ', ' || {_JAVA_2F.format(x='vc')} AS report
FROM c""")
def q_window_report(spark, sf):
    """WIN-8/9 + PRJ-16: the per-window report line (``%.2f`` changes)."""
    ch = window_change(_stats(spark, sf), "event_type")
    line = window_report({
        "first": _stamp(F.col("first_stamp")), "last": _stamp(F.col("last_stamp")),
        "max_price": F.col("max_price"), "min_price": F.col("min_price"),
        "price_change": F.col("price_change_pct"), "max_volume": F.col("max_volume"),
        "min_volume": F.col("min_volume"), "volume_change": F.col("volume_change_pct")})
    return ch.select("window_start", "event_type", line.alias("report"))


@query("q_alert_report", f"""
WITH p AS (
  SELECT {_DAY_START} AS window_start, event_type,
         MAX(value) AS cur_max, arg_min(ts, row(-value, event_id)) AS max_stamp
  FROM events GROUP BY ALL),
q AS (SELECT *, LAG(cur_max) OVER (PARTITION BY event_type ORDER BY window_start) AS prev_max
      FROM p)
SELECT window_start, event_type,
       'Large Change Detected of '
       || {_JAVA_2F.format(x='((cur_max - prev_max) / prev_max * 100.0)')} || '% (' || CAST(prev_max AS VARCHAR) || ' - ' || CAST(cur_max AS VARCHAR) || ') at  '
       || {_STAMP_SQL.format(c='max_stamp')} AS alert
FROM q WHERE prev_max IS NOT NULL AND prev_max <> 0
  AND abs((cur_max - prev_max) / prev_max * 100.0) > {DELTA_THRESHOLD_PCT}""")
def q_alert_report(spark, sf):
    """WIN-10 + PRJ-16: the large-change alert line."""
    d = large_delta(_ev(spark, sf), "ts", DELTA_WINDOW, "event_type", "event_id", "value",
                    F.col("ts"), DELTA_THRESHOLD_PCT)
    return d.select("window_start", "event_type",
                    alert_report(F.col("change_pct"), F.col("prev_max"), F.col("cur_max"),
                                 _stamp(F.col("max_stamp"))).alias("alert"))
