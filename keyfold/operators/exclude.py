"""Exclusion lists (JN-1, JN-2, FLT-6, RUN-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude_static(main: DataFrame, exclusion: DataFrame, on: str) -> DataFrame:
    """JN-1: drop main rows whose ``on`` id is in the exclusion list.

    A left-anti join that Spark broadcasts by the list's size in bytes
    (``spark.sql.autoBroadcastJoinThreshold``) and shuffles otherwise.
    """
    return main.join(exclusion.select(on).distinct(), on, "left_anti")


def exclude_from(main: DataFrame, exclusion: DataFrame, on: str, ts: str, ex_ts: str
                 ) -> DataFrame:
    """JN-2: an exclusion affects only main rows after it took effect.

    A main row survives when its id was never excluded, or its time is before
    the id's first exclusion (``ts < min(ex_ts)``).
    """
    first = exclusion.groupBy(on).agg(F.min(ex_ts).alias("_ex_from"))
    j = main.join(first, on, "left")
    return j.filter(F.col("_ex_from").isNull() | (F.col(ts) < F.col("_ex_from"))) \
            .drop("_ex_from")
