"""Line parsers (PRJ-1..11) on lines built from the driver's tables.

Each query renders table rows in the original comma-separated line formats
with ``concat_ws``, parses them back with the library parser, and returns the
typed columns (or the rejects).  The oracle computes the same typed columns
straight from the table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyfold.functions.parse import (parse_cab, parse_cab_strict, parse_click,
                                     parse_employee, parse_event_pair, parse_pair,
                                     parse_sales, parse_trade)
from keyfold.plans.registry import events, query

# Fixed values of the rendered lines
BAD_PROFIT = "n/a"              # profit text of `error` events: not a number
IDLE = "'null'"                 # pickup/destination/passengers text of idle cabs
US_SITES = ("click", "view")    # event types rendered as US clicks
_IDLE_SQL = IDLE.replace("'", "''")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _lines(spark, sf, *parts: Column, carry: tuple[str, ...] = ()):
    e = events(spark, sf)
    return e.select(F.concat_ws(",", *parts).alias("value"), F.col("event_id").alias("seq"),
                    *carry)


def sales_lines(spark, sf):
    profit = F.when(F.col("event_type") == "error", F.lit(BAD_PROFIT)) \
              .otherwise(_s(F.floor("value").cast("int")))
    return _lines(spark, sf, F.date_format("ts", "dd-MM-yyyy"), F.date_format("ts", "MMMM"),
                  F.col("event_type"), F.concat(F.lit("p"), _s("user_id")), profit)


@query("q_parse_sales", """
SELECT strftime(ts, '%d-%m-%Y') AS date, monthname(ts) AS month, event_type AS category,
       'p' || user_id AS product, CAST(FLOOR(value) AS INTEGER) AS profit, event_id AS seq
FROM events WHERE event_type <> 'error'""")
def q_parse_sales(spark, sf):
    """PRJ-1/2: sales lines -> (date, month, category, product, profit)."""
    return parse_sales(sales_lines(spark, sf))[0]


@query("q_parse_rejects", f"""
SELECT strftime(ts, '%d-%m-%Y') || ',' || monthname(ts) || ',' || event_type || ',p'
       || user_id || ',{BAD_PROFIT}' AS bad_line,
       'bad field: profit' AS reason, event_id AS seq
FROM events WHERE event_type = 'error'""")
def q_parse_rejects(spark, sf):
    """Reject rows of the sales parser: the line, the failing field, its seq."""
    return parse_sales(sales_lines(spark, sf))[1]


def _ongoing():
    return F.col("event_type") == "purchase"


def cab_lines(spark, sf):
    on = _ongoing()
    return _lines(
        spark, sf, F.concat(F.lit("id_"), _s("user_id")), F.concat(F.lit("PB"), _s("event_id")),
        F.col("event_type"), F.concat(F.lit("d"), _s("user_id")),
        F.when(on, F.lit("yes")).otherwise(F.lit("no")),
        F.when(on, F.concat(F.lit("Sector "), _s(F.expr("user_id div 10")))).otherwise(F.lit(IDLE)),
        F.when(on, F.concat(F.lit("Sector "), _s(F.expr("event_id div 1000"))))
         .otherwise(F.lit(IDLE)),
        F.when(on, _s(F.floor(F.col("value") / 50).cast("int"))).otherwise(F.lit(IDLE)))


_CAB_COMMON = f"""'id_' || user_id AS cab_id, 'PB' || event_id AS plate, event_type AS cab_type,
       'd' || user_id AS driver"""
_CAB_PLACES = f"""CASE WHEN event_type = 'purchase' THEN 'Sector ' || (user_id // 10)
            ELSE '{_IDLE_SQL}' END AS pickup,
       CASE WHEN event_type = 'purchase' THEN 'Sector ' || (event_id // 1000)
            ELSE '{_IDLE_SQL}' END AS destination"""


@query("q_parse_cab", f"""
SELECT {_CAB_COMMON},
       CASE WHEN event_type = 'purchase' THEN 'yes' ELSE 'no' END AS ongoing, {_CAB_PLACES},
       CASE WHEN event_type = 'purchase' THEN CAST(CAST(FLOOR(value / 50) AS INTEGER) AS DOUBLE)
            ELSE 0.0 END AS passengers, event_id AS seq
FROM events""")
def q_parse_cab(spark, sf):
    """PRJ-3: tolerant cab parser; idle cabs' ``'null'`` passengers count 0.0."""
    return parse_cab(cab_lines(spark, sf))[0]


@query("q_parse_cab_strict", f"""
SELECT {_CAB_COMMON}, event_type = 'purchase' AS ongoing, {_CAB_PLACES},
       CASE WHEN event_type = 'purchase' THEN CAST(FLOOR(value / 50) AS INTEGER) ELSE 0 END
         AS passengers, event_id AS seq
FROM events""")
def q_parse_cab_strict(spark, sf):
    """PRJ-4: status -> boolean; passengers parsed only for ongoing trips."""
    return parse_cab_strict(cab_lines(spark, sf))[0]


def click_lines(spark, sf):
    us = F.col("event_type").isin(*US_SITES)
    return _lines(spark, sf, F.concat(F.lit("u"), _s("user_id")),
                  F.concat(F.lit("net"), _s(F.expr("user_id div 50"))),
                  F.concat(F.lit("10.0.0."), _s("user_id")),
                  F.when(us, F.lit("US")).otherwise(F.lit("IN")),
                  F.concat(F.col("event_type"), F.lit(".com")),
                  _s(F.floor("value").cast("long")))


_CLICK_SQL = """(SELECT 'u' || user_id AS user_id, 'net' || (user_id // 50) AS network_name,
       '10.0.0.' || user_id AS user_ip,
       CASE WHEN event_type IN ('click', 'view') THEN 'US' ELSE 'IN' END AS user_country,
       event_type || '.com' AS website, CAST(FLOOR(value) AS BIGINT) AS time_spent,
       event_id AS seq FROM events)"""


@query("q_parse_click", f"""
SELECT *, user_id || ',' || network_name || ',' || user_ip || ',' || user_country || ','
          || website || ',' || time_spent AS line
FROM {_CLICK_SQL} c""")
def q_parse_click(spark, sf):
    """PRJ-5/6: click record with named fields; the raw line is kept."""
    return parse_click(click_lines(spark, sf))[0]


def clicks_outside(spark, sf, country: str = "US", exclude: bool = False):
    """FLT-3 (decision D4): keep one country (the comment's intent, default) or
    drop it (``exclude=True``, the code as written)."""
    c = parse_click(click_lines(spark, sf))[0]
    cond = F.col("user_country") != country if exclude else F.col("user_country") == country
    return c.filter(cond)


@query("q_country_filter", f"""
SELECT website, COUNT(*) AS clicks, SUM(time_spent) AS time_spent
FROM {_CLICK_SQL} c WHERE user_country <> 'US' GROUP BY website""")
def q_country_filter(spark, sf):
    """FLT-3 as written: clicks and time per website with the US dropped."""
    return clicks_outside(spark, sf, exclude=True).groupBy("website").agg(
        F.count(F.lit(1)).alias("clicks"), F.sum("time_spent").alias("time_spent"))


@query("q_country_only", f"""
SELECT website, COUNT(*) AS clicks, SUM(time_spent) AS time_spent
FROM {_CLICK_SQL} c WHERE user_country = 'US' GROUP BY website""")
def q_country_only(spark, sf):
    """FLT-3 as intended (D4 default): clicks and time per website, US only."""
    return clicks_outside(spark, sf).groupBy("website").agg(
        F.count(F.lit(1)).alias("clicks"), F.sum("time_spent").alias("time_spent"))


def trade_lines(spark, sf, carry: tuple[str, ...] = ()):
    return _lines(spark, sf, F.date_format("ts", "dd/MM/yyyy"), F.date_format("ts", "HH:mm:ss"),
                  _s("value"), F.get_json_object("props", "$.k"), carry=carry)


@query("q_parse_trade", """
SELECT strftime(ts, '%d/%m/%Y') AS date, strftime(ts, '%H:%M:%S') AS time, value AS price,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS volume,
       date_trunc('second', ts) AS ts, event_type AS symbol, event_id AS seq
FROM events""")
def q_parse_trade(spark, sf):
    """PRJ-7 + WM-2: trade lines -> price, volume and event time; symbol column."""
    lines = trade_lines(spark, sf, carry=("event_type",))
    return parse_trade(lines, symbol=F.col("event_type"))[0].drop("event_type")


@query("q_parse_pair", """
SELECT user_id AS key, event_id AS value_n, event_id AS seq FROM events""")
def q_parse_pair(spark, sf):
    """PRJ-8: ``key,value`` lines, both long."""
    return parse_pair(_lines(spark, sf, _s("user_id"), _s("event_id")))[0]


@query("q_parse_event_pair", """
SELECT epoch_us(ts) // 1000 AS ts_ms, CAST(FLOOR(value) AS INTEGER) AS value_n,
       epoch_ms(epoch_us(ts) // 1000) AS ts, event_id AS seq
FROM events""")
def q_parse_event_pair(spark, sf):
    """``ts_ms,value`` lines -> event time at millisecond precision."""
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                         F.col("ts"))
    return parse_event_pair(_lines(spark, sf, _s(ms), _s(F.floor("value").cast("int"))))[0]


@query("q_parse_employee", """
SELECT 'E' || user_id AS emp_id, 'name' || user_id AS name, 'r' || (user_id // 30) AS role,
       event_type AS dept, 'C' || event_id AS code,
       'E' || user_id || ',name' || user_id || ',r' || (user_id // 30) || ',' || event_type
       || ',C' || event_id AS line, event_id AS seq
FROM events""")
def q_parse_employee(spark, sf):
    """PRJ-9: employee lines; dept = field 3, id = field 0, the line kept."""
    return parse_employee(_lines(
        spark, sf, F.concat(F.lit("E"), _s("user_id")), F.concat(F.lit("name"), _s("user_id")),
        F.concat(F.lit("r"), _s(F.expr("user_id div 30"))), F.col("event_type"),
        F.concat(F.lit("C"), _s("event_id"))))[0]
