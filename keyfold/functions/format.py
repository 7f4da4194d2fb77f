"""Result finishing and report formatting (PRJ-12..17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    """Exact integer division truncating toward zero (Java ``a / b`` on ints);
    null when ``b`` is 0."""
    return F.call_function("div", a.cast("long"), F.nullif(b.cast("long"), F.lit(0).cast("long")))


def int_average(total: Column, count: Column) -> Column:
    """PRJ-13: truncating integer average (``sum / count`` on integers)."""
    return int_div(total, count)


def two_decimals(x: Column) -> Column:
    """PRJ-16: ``%.2f`` text (Spark rounds half up: 0.125 -> 0.13)."""
    return F.format_string("%.2f", x)


def stamp(date: Column, time: Column) -> Column:
    """PRJ-16: ``date:time`` stamp text."""
    return F.concat_ws(":", date, time)


# The wording of the report and alert lines below.
def window_report(r) -> Column:
    """PRJ-16: the per-window statistics line, numeric columns kept beside it.

    ``r`` maps names to columns: first, last, max_price, min_price,
    price_change, max_volume, min_volume, volume_change.
    """
    return F.concat(r["first"], F.lit(" - "), r["last"], F.lit(", "),
                    r["max_price"].cast("string"), F.lit(", "), r["min_price"].cast("string"),
                    F.lit(", "), two_decimals(r["price_change"]), F.lit(", "),
                    r["max_volume"].cast("string"), F.lit(", "), r["min_volume"].cast("string"),
                    F.lit(", "), two_decimals(r["volume_change"]))


def alert_report(change: Column, prev: Column, cur: Column, at: Column) -> Column:
    """PRJ-16: the large-change alert line."""
    return F.concat(F.lit("Large Change Detected of "), two_decimals(change), F.lit("% ("),
                    prev.cast("string"), F.lit(" - "), cur.cast("string"), F.lit(") at  "), at)
