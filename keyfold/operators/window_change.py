"""Window-over-window statistics, change and alerts (WIN-8..10, ST-4).

Per (window, key) statistics are one grouped aggregate (partial before the
shuffle).  The previous non-empty window of the same key is a ``lag`` over the
statistics table -- one row per (key, window), so its size is set by the time
span and window length, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.operators.windows import tumbling


def pct_change(cur: Column, prev: Column) -> Column:
    """PRJ-17: ``(cur - prev) / prev * 100``; 0.0 without a usable previous."""
    return F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise(
        (cur - prev).cast("double") / prev.cast("double") * F.lit(100.0))


def window_stats(df: DataFrame, ts: str, size: str, key: str, seq: str,
                 price: str, volume: str, stamp: Column) -> DataFrame:
    """WIN-8: first/last record's stamp, max/min price, max/min volume per window."""
    return tumbling(df, ts, size, key, [
        F.min_by(stamp, F.col(seq)).alias("first_stamp"),
        F.max_by(stamp, F.col(seq)).alias("last_stamp"),
        F.max(price).alias("max_price"), F.min(price).alias("min_price"),
        F.max(volume).alias("max_volume"), F.min(volume).alias("min_volume"),
    ])


def window_change(stats: DataFrame, key: str) -> DataFrame:
    """WIN-9: change of max price and max volume vs the key's previous window."""
    w = Window.partitionBy(key).orderBy("window_start")
    return stats.select(
        "*",
        pct_change(F.col("max_price"), F.lag("max_price").over(w)).alias("price_change_pct"),
        pct_change(F.col("max_volume"), F.lag("max_volume").over(w)).alias("volume_change_pct"))


def large_delta(df: DataFrame, ts: str, size: str, key: str, seq: str, price: str,
                stamp: Column, threshold: float) -> DataFrame:
    """WIN-10: alert when the window max price moved more than ``threshold`` %.

    Reports percent, previous and current max, and the stamp of the first
    record reaching the current max.  Maxima are aggregated first; only rows that hold
    one are aggregated for the stamp.  Both are hash aggregates, where a minimum over
    (price, sequence) pairs would sort all rows.
    """
    w = F.window(F.col(ts), size)
    rows = df.select(w["start"].alias("window_start"), w["end"].alias("window_end"), key,
                     F.col(price).alias("_p"), F.col(seq).alias("_s"), stamp.alias("_stamp"))
    top = rows.groupBy("window_start", "window_end", key).agg(F.max("_p").alias("cur_max"))
    side = top.select(F.col("window_start").alias("_w"), F.col(key).alias("_k"), "cur_max")
    # a window of null prices keeps its first record
    held = rows.join(side, (F.col("window_start") == F.col("_w")) & F.col(key).eqNullSafe(F.col("_k"))
                     & F.col("_p").eqNullSafe(F.col("cur_max")))
    per = held.groupBy("window_start", "window_end", key, "cur_max").agg(
        F.min_by("_stamp", "_s").alias("max_stamp"))
    return alerts(per, key, threshold)


def alerts(per: DataFrame, key: str, threshold: float) -> DataFrame:
    """Windows whose ``cur_max`` moved more than ``threshold`` % from that of
    the key's previous window, with ``change_pct`` and ``prev_max``."""
    w = Window.partitionBy(key).orderBy("window_start")
    with_prev = per.withColumn("prev_max", F.lag("cur_max").over(w))
    pct = (F.col("cur_max") - F.col("prev_max")) / F.nullif(F.col("prev_max"), F.lit(0.0)) * F.lit(100.0)
    found = with_prev.withColumn("change_pct", pct).filter(F.abs("change_pct") > F.lit(float(threshold)))
    first = ["window_start", "window_end", key, "change_pct", "prev_max", "cur_max", "max_stamp"]
    return found.select(*first, *[c for c in per.columns if c not in first])
