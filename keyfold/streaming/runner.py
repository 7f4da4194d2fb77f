"""Running streams to completion and replaying tables as streams.

``replay`` feeds a table to a streaming plan in arrival-ordered pieces, one
``availableNow`` run per piece on a shared checkpoint; ``run_available_now``
drives a streaming frame into an exactly-once parquet sink (or a
``foreachBatch`` writer) under the shared checkpoint folder.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.session import ensure_stream_conf, shared_dir

# Event time far beyond any real row: the end-of-input marker that advances
# the watermark past every real window, as a bounded source's final watermark.
END_OF_INPUT_TS = "9000-01-01 00:00:00"
# Rows of a replayed micro-batch, about.
PIECE_ROWS = 50_000_000


def replay(spark: SparkSession, df: DataFrame, seq: str, chunks: int, name: str,
           plan: Callable[[DataFrame], DataFrame], output_mode: str = "append",
           foreach_batch: Callable[[DataFrame, int], None] | None = None,
           end_marker: dict | None = None) -> DataFrame | None:
    """Replay a table as a stream that arrives in ``chunks`` pieces, in ``seq`` order.

    A piece holds at most about ``PIECE_ROWS`` rows: a longer table comes in more
    pieces.

    For each piece: append it to the source folder (a parallel write), then
    run the streaming ``plan`` with ``availableNow`` on the same checkpoint --
    the query resumes from its state and offsets and sees exactly the new
    files, as a long-running query sees data arrive.  Order between pieces
    never depends on file times.

    ``end_marker`` (a row) arrives with the last piece and once more in a run
    of its own: the watermark it raises is applied from the run after it,
    which flushes every real window, as a bounded source's final watermark
    does.
    """
    lo, hi, n = df.agg(F.min(seq), F.max(seq), F.count(F.lit(1))).first()
    pieces = _pieces(df, seq, lo, hi, max(chunks, -(-n // PIECE_ROWS)))
    if end_marker is not None:
        marker = one_row(spark, df, end_marker)
        pieces[-1] = pieces[-1].unionByName(marker)
        pieces.append(marker)
    return play(spark, [{"in": p} for p in pieces], name, lambda s: plan(s["in"]), output_mode,
                foreach_batch)


def one_row(spark: SparkSession, df: DataFrame, values: dict) -> DataFrame:
    """A row of ``df``'s columns, null where ``values`` has none."""
    return spark.createDataFrame([tuple(values.get(c) for c in df.columns)], df.schema)


def _pieces(df: DataFrame, seq: str, lo, hi, chunks: int) -> list[DataFrame]:
    if lo is None:  # no row has a place in the order: one piece
        return [df]
    step = (hi - lo) // chunks + 1
    pieces = [df.filter((F.col(seq) >= lo + i * step) & (F.col(seq) < lo + (i + 1) * step))
              for i in range(chunks)]
    # rows without a place come first, as in the batch form
    pieces[0] = df.filter(F.col(seq).isNull() | (F.col(seq) < lo + step))
    return pieces


def play(spark: SparkSession, steps: Sequence[dict[str, DataFrame]], name: str,
         plan: Callable[[dict[str, DataFrame]], DataFrame], output_mode: str = "append",
         foreach_batch: Callable[[DataFrame, int], None] | None = None,
         times: Sequence[int] | None = None) -> DataFrame | None:
    """Streams of one or several sources: in each step the sources that have a
    piece get it, then the query runs on what is new, from the same checkpoint.

    ``times`` (seconds since 1970, one per step) become the modification times of
    the step's files, where arrival time has to be the same in every run.
    """
    ensure_stream_conf(spark)
    ckpt = shared_dir(spark, "stream-ckpt", name)
    out = None if foreach_batch is not None else shared_dir(spark, "stream-out", name)
    schemas = {k: df.schema for step in steps for k, df in step.items()}
    folders = {k: shared_dir(spark, "replay", name, k) for k in schemas}
    known: set[str] = set()
    for k in folders.keys() - steps[0].keys():  # a source may get its first piece late
        spark.createDataFrame([], schemas[k]).write.mode("append").parquet(folders[k])
    for i, step in enumerate(steps):
        for k, piece in step.items():
            piece.write.mode("append").parquet(folders[k])
            if times:
                _set_times(spark, folders[k], times[i], known)
        streams = {k: file_stream(spark, folders[k], schemas[k], None) for k in folders}
        run_available_now(plan(streams), name, output_mode=output_mode,
                          foreach_batch=foreach_batch, checkpoint=ckpt, out=out)
    return spark.read.parquet(out) if out else None


def _set_times(spark: SparkSession, folder: str, seconds: int, known: set[str]) -> None:
    """Sets the modification time of the files that are new in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        if status.isFile() and status.getPath().toString() not in known:
            known.add(status.getPath().toString())
            fs.setTimes(status.getPath(), seconds * 1000, -1)


def file_stream(spark: SparkSession, folder: str, schema,
                files_per_batch: int | None = 1) -> DataFrame:
    """SRC-2: a folder of parquet files as a stream, oldest file first
    (``files_per_batch=None``: everything new in one micro-batch)."""
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append",
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      checkpoint: str | None = None, out: str | None = None,
                      progress: list | None = None) -> DataFrame:
    """SNK-4: process everything available, then stop; return the written rows.

    Without ``foreach_batch`` the sink is parquet (append only, exactly once
    through the sink's commit log).  ``checkpoint`` may be reused to resume.
    """
    spark = stream.sparkSession
    ckpt = checkpoint or shared_dir(spark, "stream-ckpt", name)
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
        target = None
    else:
        target = out or shared_dir(spark, "stream-out", name)
        w = w.format("parquet").option("path", target)
    q = w.trigger(availableNow=True).queryName(name).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if progress is not None:
        progress.extend(q.recentProgress)
    return spark.read.parquet(target) if target else None
