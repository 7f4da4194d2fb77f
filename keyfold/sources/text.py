"""Text line sources (SRC-1, SRC-2, SRC-3).

``read_lines`` is the batch table of lines; ``line_stream`` the same lines as a
stream.  Either feeds the same parsers and operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_line_numbers(df: DataFrame, file: str = "file", line: str = "line",
                      name: str = "seq", within: str | None = None) -> DataFrame:
    """Number the rows of a file scan: ``line`` within its file and ``name``
    over all files, both from 1, files in order of their path.  With ``within``,
    a partition column of the path, ``line`` counts over all files of its value.

    A split of a file (path and start offset) is read by one task in order, so
    a row's place in it is its running row number there; splits are counted
    (one row per split), prefix sums in path and offset order become offsets,
    and rows join their split's.  No task holds more than its own split.
    """
    m = F.col("_metadata")
    tagged = df.select(*df.columns, m["file_path"].alias(file),
                       m["file_block_start"].alias("_start"),
                       F.monotonically_increasing_id().alias("_mid"))
    part = F.first(within) if within else F.lit(None)
    counts = tagged.groupBy(file, "_start").agg(part.alias("_part"), F.count(F.lit(1)).alias("_n"),
                                                F.min("_mid").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(file, "_start").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    in_file = F.coalesce(F.sum("_n").over(Window.partitionBy("_part" if within else file).orderBy(
        file, "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = counts.select(file, "_start", "_first", before.alias("_all"), in_file.alias("_own"))
    at = F.col("_mid") - F.col("_first") + 1
    return tagged.join(splits, [file, "_start"]).select(
        *df.columns, file, (F.col("_own") + at).alias(line), (F.col("_all") + at).alias(name))


def read_lines(spark: SparkSession, path: str, numbered: bool = True,
               within: str | None = None) -> DataFrame:
    """SRC-1: lines of text files as ``value`` (+ ``file``, ``line`` within it, or
    within the partition column ``within``, and ``seq`` over all files in path
    order, both from 1)."""
    df = spark.read.text(path)
    return with_line_numbers(df, within=within) if numbered else df


def line_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                **options) -> DataFrame:
    """SRC-2/SRC-3: a stream of lines as ``value``.

    ``fmt="text"`` reads new files of a folder (``maxFilesPerTrigger`` paces
    replays); ``"socket"`` or ``"kafka"`` take their usual options.  Kafka's
    binary ``value`` is cast to text, so every format yields the same column.
    """
    r = spark.readStream.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path) if path is not None else r.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"),
                       F.col("timestamp").alias("arrival_ts"))
    return df
