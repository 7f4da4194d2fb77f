"""Query registry: ``@query(name, sql)`` binds a Spark plan to its oracle SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Rows per bucket of the leading sequence column in the two-level running
# plans.  Bounds every local group; the carry table has one row per (key, bucket).
# Small under a local master, so that small tables have several buckets.
# Overridable per session with ``keyfold.running.bucketWidth``.
RUN_BUCKET_WIDTH, CLUSTER_BUCKET_WIDTH = 4096, 1 << 17


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def bucket_width(spark: SparkSession) -> int:
    default = RUN_BUCKET_WIDTH if spark.sparkContext.master.startswith("local") \
        else CLUSTER_BUCKET_WIDTH
    return int(spark.conf.get("keyfold.running.bucketWidth", str(default)))


def cents(col: str) -> Column:
    """Money as exact integer cents, so sums do not depend on row order."""
    return F.round(F.col(col) * 100).cast("long")


def money(c: Column) -> Column:
    return c.cast("double") / 100


# SQL spelling of the same two helpers
CENTS_SQL = "CAST(ROUND({c} * 100) AS BIGINT)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


def load_all() -> None:
    """Import every query module so it registers."""
    from keyfold.plans import (q_aggregate, q_parse, q_roundtrip, q_running,  # noqa: F401
                               q_state, q_windows)
    from keyfold.streaming import catalog  # noqa: F401
