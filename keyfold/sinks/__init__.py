"""Sinks (SNK-1..5): text, delimited text, rolling stream files, console."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.running import run_sum, running
from keyfold.session import shared_dir

# Files of a rolled sink that one folder holds, and that are listed and read at
# once: the driver keeps some 4 KB for each file of a table that it reads.
FOLDER_FILES, READ_FILES = 10_000, 20_000


def tuple_text(*cols) -> Column:
    """A row rendered like a printed tuple: ``(June,12.0)``; a null field as ``null``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null"))
             for c in cols]
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def write_text(df: DataFrame, path: str, line: Column | None = None,
               mode: str = "errorifexists") -> None:
    """SNK-1/2: one text line per row; ``mode="overwrite"`` replaces old output.

    Without ``line`` every column is rendered as a tuple.
    """
    text = line if line is not None else tuple_text(*df.columns)
    df.select(text.alias("value")).write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, row_delim: str = "\n", field_delim: str = " ",
                    mode: str = "errorifexists") -> None:
    """SNK-3: delimited text with chosen row and field separators."""
    (df.write.mode(mode).option("sep", field_delim).option("lineSep", row_delim)
       .option("header", "false").csv(path))


def roll_by_bytes(df: DataFrame, order: str, size: Column, max_bytes: int, width: int,
                  name: str = "file_no") -> DataFrame:
    """``name``: the file each row goes to, if rows are laid out one after another by
    ``order`` (integral, unique) and a new file begins every ``max_bytes``.

    A file holds at most ``max_bytes`` and one more row, however uneven the rows
    are.  The running sum of bytes is the two-level running fold.
    """
    rows = df.withColumn("_all", F.lit(0)).withColumn("_size", size.cast("long"))
    out = running(rows, "_all", order, [run_sum("_size", "_end")], width)
    return out.withColumn(name, F.expr(f"(_end - _size) div {int(max_bytes)}")) \
        .drop("_all", "_size", "_end")


def write_rolled(df: DataFrame, path: str, order: str, max_bytes: int, width: int,
                 line: Column | None = None, mode: str = "errorifexists") -> None:
    """SNK-4: text lines by ``order`` in files of about ``max_bytes``, as
    ``path``/file_group=0, 1, .../file_no=0, 1, ...; a group is ``FOLDER_FILES``
    numbers, so that a reader can list the files a folder at a time.

    The cost is the files, not the bytes.  So they are dealt to a given number of
    tasks, which AQE does not merge for holding few bytes, and every task puts its
    own files in place (committer version 2) instead of the driver all of them
    at the end; a task that is repeated replaces what it wrote.
    """
    text = line if line is not None else tuple_text(*df.columns)
    lines = df.select(F.col(order).alias("_order"), text.alias("value"))
    rolled = roll_by_bytes(lines, "_order", F.octet_length("value") + 1, max_bytes, width) \
        .withColumn("file_group", F.expr(f"file_no div {FOLDER_FILES}"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rolled.repartition(tasks, "file_no").sortWithinPartitions("file_group", "file_no", "_order") \
        .select("value", "file_group", "file_no").write.mode(mode) \
        .partitionBy("file_group", "file_no") \
        .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)


def rolled_lines(spark: SparkSession, path: str,
                 each: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> DataFrame:
    """The lines of many small text files that ``write_rolled`` left under ``path`` as
    ``value``, with the partition columns of the path, ``file`` and its ``size`` in bytes.

    The driver holds the names of all files of a table that it reads.  So the files
    are read some ``READ_FILES`` at a time, all of a folder's at once, and what ``each`` makes
    of their lines is kept as a table in the shared folder: that is returned.
    """
    out, start = shared_dir(spark, "rolled-lines"), spark._jvm.org.apache.hadoop.fs.Path(path)
    parts = list(_some_at_a_time(_folders(
        start.getFileSystem(spark._jsc.hadoopConfiguration()), start)))
    if not parts:
        return each(spark.createDataFrame(
            [], "epoch int, file_no int, file string, size long, value string"))
    for folders, keys in parts:
        each(_lines_of(spark, path, folders, keys)).write.mode("append").parquet(out)
        gc.collect()  # py4j's objects are cycles, and hold the listing in the JVM till collected
    return spark.read.parquet(out)


def _folders(fs, folder, keys: tuple[str, ...] = ()) -> Iterator[tuple[str, tuple[str, ...], int]]:
    """The folders at or below ``folder`` that hold folders of files: path, partition
    columns down to the files, and the number of files."""
    below = fs.listStatus(folder)
    for s in below:
        name = s.getPath().getName()
        if not s.isDirectory() or name[0] in "._":
            continue
        if name.startswith("file_no="):
            yield folder.toString(), (*keys, "file_no"), len(below)
            return
        yield from _folders(fs, s.getPath(), (*keys, name.partition("=")[0]))


def _some_at_a_time(folders) -> Iterator[tuple[list[str], tuple[str, ...]]]:
    some, at, n = [], (), 0
    for folder, keys, files in folders:
        if some and (n + files > READ_FILES or keys != at):
            yield some, at
            some, n = [], 0
        some, at, n = [*some, folder], keys, n + files
    if some:
        yield some, at


def _lines_of(spark: SparkSession, path: str, folders: list[str], keys: tuple[str, ...]) -> DataFrame:
    """The lines of all files in the folders of ``folders``.

    Small files are read whole: a reader of lines is set up anew for every file.  The
    folders are listed by as many tasks as a shuffle has; by default every
    folder, up to 10,000, gets a task of its own.  No listing is kept after its use.
    """
    conf = {"spark.sql.sources.parallelPartitionDiscovery.parallelism":
            spark.conf.get("spark.sql.shuffle.partitions"),
            "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}
    # numbers have the same type whichever folders are read together
    schema = ["path string, modificationTime timestamp, length long, content binary",
              *(f"{k} int" for k in keys if k in ("epoch", "file_group", "file_no"))]
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        files = spark.read.format("binaryFile").schema(", ".join(schema)) \
            .option("basePath", path).load(folders)  # lists the folders
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lines = F.split(F.col("content").cast("string"), "\n")
    return files.select(*(k for k in keys if k != "file_group"), F.col("path").alias("file"),
                        F.col("length").alias("size"),
                        F.explode(F.slice(lines, 1, F.size(lines) - 1)).alias("value"))


def rolling_writer(path: str, order: str, max_bytes: int, width: int, line: Column | None = None):
    """SNK-4 on a stream, as a ``foreachBatch`` function: every micro-batch writes
    its lines in files of about ``max_bytes`` to ``path``/epoch=..., overwritten where
    an epoch is repeated."""
    def run(batch: DataFrame, epoch: int) -> None:
        write_rolled(batch, f"{path}/epoch={epoch}", order, max_bytes, width, line, "overwrite")
    return run


def stream_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                    line: Column | None = None, max_records_per_file: int | None = None,
                    trigger: dict | None = None, output_mode: str = "append"):
    """SNK-4: rolling row-format file sink of a stream.

    Each micro-batch commits new files (rolled at ``max_records_per_file``
    rows); the sink's commit log makes the output exactly-once across
    restarts from ``checkpoint``.  ``fmt="text"`` writes one line per row.
    """
    if fmt == "text":
        stream = stream.select((line if line is not None else tuple_text(*stream.columns))
                               .alias("value"))
    w = (stream.writeStream.format(fmt).outputMode(output_mode)
         .option("path", path).option("checkpointLocation", checkpoint))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w = w.trigger(**(trigger or {"processingTime": "1 second"}))
    return w.start()


def run_to_files(stream: DataFrame, path: str, checkpoint: str, **kw) -> None:
    """SNK-4 for bounded replays: process what is available, then stop."""
    q = stream_to_files(stream, path, checkpoint, trigger={"availableNow": True}, **kw)
    q.awaitTermination()


def to_console(df: DataFrame, rows: int = 20, truncate: bool = False):
    """SNK-5: print rows (batch) or each micro-batch (stream)."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", str(truncate).lower()) \
                 .option("numRows", rows).start()
    df.show(rows, truncate=truncate)
    return None
