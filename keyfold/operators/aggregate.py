"""Final per-key results over a whole table (AGG-1..6).

All are ``groupBy().agg()``: a partial hash aggregate runs before the shuffle,
so a key holding a third of the rows costs one row per map task on the wire.
Top/bottom group uses ``min`` over a struct (ties -> smallest key), also a
partial aggregate -- no global sort and no single-task window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def group_count(df: DataFrame, key, name: str = "n") -> DataFrame:
    """AGG-1: rows per key."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias(name))


def group_distinct(df: DataFrame, key, value: str, name: str) -> DataFrame:
    """AGG-6c: distinct values per key (exact)."""
    return df.groupBy(*_cols(key)).agg(F.count_distinct(F.col(value)).alias(name))


def top_group(df: DataFrame, key: str, total: str, largest: bool = True,
              by: Sequence[str] | None = None) -> DataFrame:
    """AGG-3 / WIN-4/5: the key with the largest (or smallest) ``total``.

    ``df`` holds one row per key; keys without a total (null) never win;
    ``by`` optionally makes it per group (e.g. per window).  Ties go to the
    smallest key.  ``min`` over ``struct(order, key)`` is a partial aggregate.
    """
    t = F.col(total)
    order = -t if largest else t
    best = F.min(F.struct(order.alias("_o"), F.col(key).alias("_k"), t.alias("_v")))
    g = df.filter(t.isNotNull()).groupBy(*(by or [])).agg(best.alias("_best"))
    if not by:  # a global aggregate gives a row even when no key has a total
        g = g.filter(F.col("_best").isNotNull())
    return g.select(*(by or []), F.col("_best._k").alias(key), F.col("_best._v").alias(total))
