"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyfold.session import shared_dir

#: A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """``df`` as a table in the cluster's shared folder, read back.

    Cuts the lineage: what is read later does not depend on executors that may
    be lost meanwhile, and rows keep the values of one evaluation.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    w = df.write.mode("errorifexists")
    (w.partitionBy(*by) if by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a whole text; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ordered_rank(df: DataFrame, group: list[str], order: list[Column], name: str,
                 rank: str = "rank") -> DataFrame:
    """Rank (1-based) of each row in its group by ``order``, without a window
    over a group.

    Rows are dealt by range of (group, order) and sorted, so a group of any
    size spreads over many tasks; each row takes its number within its
    partition, the table is written, and the partitions' counts per group
    (at most one row per group and partition) are summed to offsets.
    ``order`` should be unique within a group; rows that tie in everything are
    interchangeable.  Keep ``df`` narrow: it is shuffled and written once.
    """
    keys = [F.col(c) for c in group] + order
    dealt = (df.repartitionByRange(*[k.asc_nulls_last() for k in keys])
             .sortWithinPartitions(*[k.asc_nulls_last() for k in keys])
             .withColumn("_seq", F.monotonically_increasing_id()))
    dealt = written(dealt, name)
    part = F.shiftright("_seq", 33)
    parts = (dealt.withColumn("_part", part).groupBy(*group, "_part")
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first")))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    parts = parts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
                         "_part", "_first", "_before")
    on = F.col("_dealt_part") == F.col("_part")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = (dealt.withColumn("_dealt_part", part).join(parts, on)
           .withColumn(rank, F.col("_before") + F.col("_seq") - F.col("_first") + 1))
    return out.drop("_seq", "_dealt_part", "_part", "_first", "_before",
                    *[f"_g{i}" for i in range(len(group))])
