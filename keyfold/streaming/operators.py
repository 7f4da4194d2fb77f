"""Streaming forms of the operators.

Windowed aggregations are Spark's own stateful operators with a watermark
(``withWatermark`` + ``groupBy(window/session_window)``, append mode: a window
is emitted once, when the watermark passes its end; state older than the
watermark is dropped, and so are rows arriving behind it -- WM-1..3).  Per
record and count-triggered operators are in :mod:`keyfold.streaming.carry`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.streaming.epochs import Growing, Latest, remove


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """WM-1/2: event time with bounded lateness ``delay`` ("0 seconds" =
    ascending timestamps).  Wall-clock (NTZ) times become session-zone
    timestamps, which ``withWatermark`` requires."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def tumbling_stream(stream: DataFrame, ts: str, size: str, key, aggs,
                    slide: str | None = None) -> DataFrame:
    """WIN-1..3/6 on a watermarked stream (append: each window once)."""
    key = _cols(key)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = stream.groupBy(w.alias("_w"), *key).agg(*aggs)
    return g.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
                    *[c for c in g.columns if c != "_w"])


def window_top_stream(stream: DataFrame, ts: str, size: str, key: str, largest: bool = True
                      ) -> DataFrame:
    """WIN-3 -> WIN-4/5 on a stream: clicks per (window, key), then per window
    the key with the most (fewest) clicks -- two chained windowed aggregates in
    append mode; the second groups on ``window_time`` of the first.  Ties go
    to the smallest key."""
    per = stream.groupBy(F.window(ts, size).alias("_w"), key).agg(
        F.count(F.lit(1)).alias("clicks"))
    n = F.col("clicks")
    best = F.min(F.struct((-n if largest else n).alias("_o"), F.col(key).alias("_k"),
                          n.alias("_n")))
    g = per.groupBy(F.window(F.window_time("_w"), size).alias("_w2")).agg(best.alias("_b"))
    return g.select(F.col("_w2.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("_w2.end").cast("timestamp_ntz").alias("window_end"),
                    F.col("_b._k").alias(key), F.col("_b._n").alias("clicks"))


def session_stream(stream: DataFrame, ts: str, gap: str, aggs, key=None) -> DataFrame:
    """WIN-7 on a stream with Spark's own session window (state per key in the
    state store).  Meant for keyed sessions: without ``key`` it groups by a
    constant (Spark rejects an un-keyed streaming session window), which puts
    each micro-batch in one task -- for global sessions use
    :func:`session_writer`, which sessionises every micro-batch distributed."""
    keys = _cols(key) if key else []
    if not keys:
        stream = stream.withColumn("_all", F.lit(0))
    k = keys or ["_all"]
    g = stream.groupBy(F.session_window(ts, gap).alias("_s"), *k).agg(*aggs)
    return g.select(*keys,
                    F.col("_s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("_s.end").cast("timestamp_ntz").alias("session_end"),
                    *[c for c in g.columns if c not in ("_s", "_all", *keys)])


def session_writer(spark, ts: str, gap: str, value: str, seq: str, lateness: str,
                   state_dir: str, out_dir: str, key: str | None = None,
                   partitions: int | None = None):
    """WIN-7 on a stream without one task per micro-batch, as a ``foreachBatch``
    function.

    Spark's streaming session window needs a grouping key, so a global
    session would put each micro-batch in one task.  Here every micro-batch
    is sessionised by the distributed batch operator instead:

    1. the open sessions of the previous epoch (segments) and the new rows are
       merged by :func:`keyfold.operators.sessions.session_segments` (range
       partitioning + one ordered pass + edge stitching);
    2. a merged session that ended (last event + gap) before the previous
       watermark (max event time - ``lateness``) holds late rows only -- every
       open session ends after it -- and is dropped: a row is late when its
       window, merged with what it touches, has already expired;
    3. sessions whose end the new watermark has passed are emitted, the rest are
       written back as the next epoch's open state.

    State and the max event time are kept per epoch (:class:`Latest`), output goes to
    one folder per epoch, overwritten on a retry, so a replayed micro-batch gives
    the same files.  Rows without a time are in no session.
    """
    from keyfold.operators.sessions import (_from_micros, _gap_micros, _micros,
                                            session_segments)
    gap_us, late_us = _gap_micros(gap), _gap_micros(lateness)
    seg_schema = "skey string, t long, t2 long, c long, m long, v long, _seq long"
    state, meta = Latest(spark, state_dir), Latest(spark, f"{state_dir}-meta")

    def run(batch: DataFrame, epoch: int) -> None:
        prev, mark = state.before(epoch, seg_schema), meta.before(epoch, "max_t long")
        max_prev = mark.first()[0] if mark is not None else -(1 << 62)
        kcol = F.col(key).cast("string") if key is not None else F.lit("")
        rows = batch.select(kcol.alias("skey"), _micros(F.col(ts)).alias("t"),
                            F.col(value).isNotNull().cast("long").alias("m"),
                            F.col(value).cast("long").alias("v"),
                            F.col(seq).cast("long").alias("_seq")).filter("t is not null").persist()
        sess = None
        try:
            segs = rows.select("skey", "t", F.col("t").alias("t2"),
                               F.lit(1).cast("long").alias("c"), "m", "v", "_seq")
            segs = segs if prev is None else segs.unionByName(prev)
            end = F.col("s_last") + F.lit(gap_us)
            sess = session_segments(segs, gap, partitions) \
                .filter(end >= F.lit(max_prev - late_us)).persist()
            seen = rows.agg(F.max("t")).first()[0]
            max_now = max(max_prev, seen if seen is not None else max_prev)
            done = end < F.lit(max_now - late_us)
            sess.filter(done).select(
                *([F.col("skey").cast(batch.schema[key].dataType).alias(key)]
                  if key is not None else []),
                _from_micros(F.col("s_start")).alias("session_start"),
                _from_micros(F.col("s_last") + F.lit(gap_us)).alias("session_end"),
                "n", F.when(F.col("m") > 0, F.col("total")).alias("total")) \
                .write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
            state.write(sess.filter(~done).select(
                "skey", F.col("s_start").alias("t"), F.col("s_last").alias("t2"),
                F.col("n").alias("c"), "m", F.col("total").alias("v"),
                F.col("s_start").alias("_seq")), epoch)
            meta.write(spark.createDataFrame([(int(max_now),)], "max_t long"), epoch)
        finally:
            rows.unpersist()
            if sess is not None:
                sess.unpersist()
    return run


def exclude_stream(stream: DataFrame, exclusion: DataFrame, on: str) -> DataFrame:
    """JN-1 on a stream: stream-static left-anti join against the list."""
    return stream.join(exclusion.select(on).distinct(), on, "left_anti")


def exclude_asof_writer(spark, on: str, ts: str, announces, list_dir: str, out_dir: str,
                        buckets: int = 64, merge: int = 8):
    """JN-2 on a stream, as a ``foreachBatch`` function: ids announced by rows
    matching ``announces`` are excluded from then on.

    Per micro-batch: rows of ids announced in earlier micro-batches are dropped
    (anti join against the buckets of the list that the rows fall into), rows of ids
    announced in this batch are kept only before the id's first announcement (as-of),
    then this batch's announcements are added to the list.  Output goes to one folder per
    epoch, overwritten on a retry.
    """
    listed = Growing(spark, list_dir, [on], buckets, merge)

    def run(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            ann = batch.filter(announces).groupBy(on).agg(F.min(ts).alias("_ex_from"))
            prev = listed.before(epoch, batch)
            kept = batch if prev is None else batch.join(prev, on, "left_anti")
            kept = kept.join(ann, on, "left").filter(
                F.col("_ex_from").isNull() | (F.col(ts) < F.col("_ex_from"))).drop("_ex_from")
            kept.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
            listed.add(ann.select(on).distinct(), epoch)
        finally:
            batch.unpersist()
    return run


def exclude_between_streams(main: DataFrame, announced: DataFrame, on: str, ts: str,
                            ex_ts: str, salts: int = 8) -> DataFrame:
    """JN-1/2, ST-7 with two live sources: rows of ``main`` whose id was not announced
    on the stream ``announced`` at their time or before.

    A stream-stream left outer join, both sides watermarked: a row waits until
    the watermark says that no earlier announcement can come, and goes out if none has
    come.  Both watermarks count, so either source may run ahead of the other, and the result
    does not depend on their pace.  Announcements stay in the state, as an exclusion
    does not end.  Rows of one id are dealt over ``salts`` places, to each of which its
    announcements go, so that a hot id is not one task's state.  A null id is never
    excluded.

    Every waiting row is an entry of the state store and meets all announcements of its
    id: :func:`exclude_sources_writer` does the same for rows that are many and ids
    that are announced again and again.
    """
    left = main.withColumn("_salt", F.pmod(F.xxhash64(ts, *[c for c in main.columns if c != ts]),
                                           F.lit(salts)).cast("int"))
    right = announced.select(F.col(on).alias("_ex_on"), F.col(ex_ts).alias("_ex_ts"),
                             F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_ex_salt"))
    met = left.join(right, (F.col(on) == F.col("_ex_on")) & (F.col("_salt") == F.col("_ex_salt"))
                    & (F.col("_ex_ts") <= F.col(ts)), "left")
    return met.filter(F.col("_ex_on").isNull()).select(*main.columns)


def two_sources(main: DataFrame, announced: DataFrame, on: str, ts: str, ex_ts: str) -> DataFrame:
    """Rows of both live sources as one stream for :func:`exclude_sources_writer`;
    announcements have the time they count from in ``_ex_ts``."""
    return main.withColumn("_ex_ts", F.lit(None).cast("timestamp")).withColumn(
        "_announced", F.lit(False)).unionByName(
        announced.select(F.col(on), F.col(ex_ts).cast("timestamp").alias("_ex_ts"),
                         F.lit(True).alias("_announced")), allowMissingColumns=True)


def exclude_sources_writer(spark, on: str, ts: str, lateness: str, state_dir: str, out_dir: str):
    """:func:`exclude_between_streams` as a ``foreachBatch`` function over
    :func:`two_sources`, with its state in tables and not row by row in a state store.

    Kept per epoch (:class:`Latest`) are the largest time of either source, the first
    announcement of each id (a later one excludes nothing more) and the rows that
    wait.  Per micro-batch:

    1. rows and announcements at or behind the watermark (the smaller of the two
       largest times less ``lateness``) that earlier micro-batches left are late and
       dropped;
    2. the others add to the first announcements; waiting and new rows whose id was
       announced at their time or before are dropped for good;
    3. of the rest those that the new watermark has reached go to ``out_dir``, where no
       earlier announcement can come any more, and the others wait.

    A null id is never excluded; rows without a time wait for ever, so they are not
    kept.  Output goes to one folder per epoch, overwritten on a retry.
    """
    from keyfold.operators.sessions import _gap_micros
    late_us = _gap_micros(lateness)
    tops, firsts, waiting = (Latest(spark, f"{state_dir}/{x}") for x in ("tops", "firsts", "waiting"))

    def mark(top) -> int | None:
        return None if None in top else min(top) - late_us

    def run(batch: DataFrame, epoch: int) -> None:
        at = F.unix_micros(F.coalesce("_ex_ts", F.col(ts).cast("timestamp")))
        seen = batch.agg(*[F.max(F.when(c, at)) for c in (~F.col("_announced"), F.col("_announced"))]).first()
        before = tops.before(epoch, "main long, announced long")
        old = (None, None) if before is None else tuple(before.first())
        top = [max((x for x in pair if x is not None), default=None) for pair in zip(old, seen)]
        fresh = batch.filter(at.isNotNull() if mark(old) is None else at > mark(old))

        known = fresh.filter(F.col("_announced") & F.col(on).isNotNull()).select(on, "_ex_ts")
        prev = firsts.before(epoch, known.schema)
        known = known if prev is None else prev.unionByName(known)
        known = firsts.write(known.groupBy(on).agg(F.min("_ex_ts").alias("_ex_ts")), epoch)

        rows = fresh.filter(~F.col("_announced")).drop("_announced", "_ex_ts")
        prev = waiting.before(epoch, rows.schema)
        rows = rows if prev is None else prev.unionByName(rows)
        kept = rows.join(known, on, "left").filter(
            F.col("_ex_ts").isNull() | (F.col("_ex_ts") > F.col(ts).cast("timestamp"))).select(*rows.columns)
        due = F.lit(False) if mark(top) is None else F.unix_micros(F.col(ts).cast("timestamp")) <= mark(top)
        kept.filter(due).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")
        waiting.write(kept.filter(~due), epoch)
        tops.write(spark.createDataFrame([tuple(top)], "main long, announced long"), epoch)
    return run


def split_stream(outputs: dict, targets: dict[str, str]):
    """SPL-1 on a stream: one ``foreachBatch`` writes every side output of the
    same micro-batch (``outputs``: name -> function of the batch frame)."""
    def run(batch: DataFrame, epoch: int) -> None:
        # one folder per epoch, overwritten on a retry: exactly-once output
        batch.persist()
        try:
            for name, fn in outputs.items():
                fn(batch).write.mode("overwrite").parquet(f"{targets[name]}/epoch={epoch}")
        finally:
            batch.unpersist()
    return run


def arrival_windows(stream: DataFrame, size: str, key, aggs, slide: str | None = None,
                    arrival: str | None = None) -> DataFrame:
    """WIN-1/2 as written: tumbling (or sliding) windows on the time of arrival.

    ``arrival`` names a column with it; of a file source that is
    ``_metadata.file_modification_time``, which does not change when the input is read
    again, so a repeated run gives the same windows.  Without it arrival is
    ``current_timestamp()``, fixed per micro-batch.  Windows close when a later arrival
    passes their end (watermark 0).
    """
    at = F.col(arrival) if arrival else F.current_timestamp()
    s = stream.withColumn("_pt", at).withWatermark("_pt", "0 seconds")
    return tumbling_stream(s, "_pt", size, key, aggs, slide=slide)


def reject_writer(parse, good_dir: str, bad_dir: str):
    """A parser on a stream, as a ``foreachBatch`` function: of one micro-batch good rows
    go to one table and rejected lines, with the reason, to another.  Either has
    one folder per epoch, overwritten on a retry, so that no line is in both or
    in none."""
    def run(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for rows, folder in zip(parse(batch), (good_dir, bad_dir)):
                rows.write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")
        finally:
            batch.unpersist()
    return run


def late_writer(spark, ts: str, size: str, lateness: str, state_dir: str, on_time_dir: str,
                late_dir: str, counts_dir: str):
    """WM-3 with the late rows kept, as a ``foreachBatch`` function: rows of
    windows that the watermark in force (largest event time of earlier micro-batches
    less ``lateness``) has closed go to ``late_dir`` with that watermark, the others to
    ``on_time_dir``.  The numbers of both, taken by ``observe`` while the rows are
    written, go to ``counts_dir``.  Rows without a time are late: no window takes them."""
    from pyspark.sql import Observation

    marks = Latest(spark, state_dir)

    def run(batch: DataFrame, epoch: int) -> None:
        seen = Observation()
        before = marks.before(epoch, "top timestamp_ntz")
        top = before.first()[0] if before is not None else None
        time = F.col(ts).cast("timestamp_ntz")
        mark = F.lit(top).cast("timestamp_ntz") - F.expr(f"INTERVAL {lateness}")
        # F.window drops rows without a time
        window = F.window(F.coalesce(time, F.lit("1970-01-01").cast("timestamp_ntz")), size)
        rows = batch.withColumn("watermark", mark).withColumn("_w", window).withColumn(
            "is_late", F.col(ts).isNull() | F.coalesce(F.col("_w.end") <= mark, F.lit(False))) \
            .drop("_w").observe(
            seen, F.count_if("is_late").alias("late"), F.count_if(~F.col("is_late")).alias("on_time"),
            F.max(time).alias("top"))
        path = f"{state_dir}-split/epoch={epoch}"
        rows.write.mode("overwrite").partitionBy("is_late").parquet(path)
        found = spark.read.schema(rows.schema).parquet(path)
        found.filter("is_late").drop("is_late").write.mode("overwrite").parquet(f"{late_dir}/epoch={epoch}")
        found.filter("not is_late").drop("is_late", "watermark").write.mode("overwrite") \
            .parquet(f"{on_time_dir}/epoch={epoch}")
        n = seen.get
        spark.createDataFrame([(n["on_time"], n["late"])], "on_time long, late long") \
            .write.mode("overwrite").parquet(f"{counts_dir}/epoch={epoch}")
        top = max(x for x in (top, n["top"]) if x is not None) if top or n["top"] else None
        marks.write(spark.createDataFrame([(top,)], "top timestamp_ntz"), epoch)
        remove(spark, path)
    return run
