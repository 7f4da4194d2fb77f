"""Time windows in batch form (WIN-1..6).

``groupBy(window(ts, size[, slide]), key).agg(...)``: tumbling and sliding
windows are grouping keys, so partial aggregation runs before the shuffle and
a hot key costs one partial row per map task.  A sliding window expands each
row into size/slide copies (the ``Expand`` node) before the partial aggregate.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.operators.aggregate import top_group


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _flatten(g: DataFrame, key: list[str], aggs: Sequence[Column]) -> DataFrame:
    return g.select(F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"), *key,
                    *[F.col(c) for c in g.columns if c not in key and c != "_w"])


def tumbling(df: DataFrame, ts: str, size: str, key, aggs: Sequence[Column]) -> DataFrame:
    """WIN-1/3/6: one row per (window, key) with ``aggs``."""
    key = _cols(key)
    g = df.groupBy(F.window(F.col(ts), size).alias("_w"), *key).agg(*aggs)
    return _flatten(g, key, aggs)


def sliding(df: DataFrame, ts: str, size: str, slide: str, key,
            aggs: Sequence[Column]) -> DataFrame:
    """WIN-2: windows of ``size`` every ``slide``; a row is in size/slide windows."""
    key = _cols(key)
    g = df.groupBy(F.window(F.col(ts), size, slide).alias("_w"), *key).agg(*aggs)
    return _flatten(g, key, aggs)


def window_top(per_window: DataFrame, key: str, measure: str, largest: bool = True) -> DataFrame:
    """WIN-4/5: per window, the key with the most (fewest) ``measure``.

    Input: one row per (window, key).  Ties go to the smallest key.
    """
    return top_group(per_window, key, measure, largest=largest,
                     by=["window_start", "window_end"])
