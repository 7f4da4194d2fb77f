"""Event-time session windows (WIN-7), keyed or global.

A new session starts when the gap to the previous event (same key, event-time
order) is larger than ``gap``; events exactly ``gap`` apart share a session.
A session reports its first event time as ``session_start`` and last event
time + gap as ``session_end`` (the end of the last event's window).

The global (un-keyed) form is the hard one: it has a single group.  Plan:

1. ``repartitionByRange(n, key, ts, seq)`` -- balanced, contiguous ranges of
   event time (``seq`` makes the range key unique, so even one hot instant is
   split), then ``sortWithinPartitions``.
2. ``mapInPandas`` walks each partition once in Arrow batches, carrying only
   the open session across batches, and emits partial sessions, which lie more
   than ``gap`` apart within a partition.
3. How far the earlier partitions reach is a prefix maximum over one row per
   partition and key.  Partial sessions that start within that reach go on with the
   last session that starts in an earlier partition, which is the same kind of prefix
   maximum; all others start a session of their own.  A grouped sum over (key, first
   start), partial before its shuffle, adds the pieces up: one long session over very many
   pieces is no hot group.

Rows without a time are in no session; a null value adds nothing to its session's
total, which is null where all are; a null key is a key.

No task ever holds more than one range partition, and nothing passes through
the driver.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.session import pickle_by_value, shared_dir

pickle_by_value(__name__)


def _gap_micros(gap: str) -> int:
    n, unit = gap.split()
    scale = {"millisecond": 1_000, "milliseconds": 1_000, "second": 1_000_000,
             "seconds": 1_000_000, "minute": 60_000_000, "minutes": 60_000_000,
             "hour": 3_600_000_000, "hours": 3_600_000_000,
             "day": 86_400_000_000, "days": 86_400_000_000}[unit]
    return int(float(n) * scale)


def _partial_sessions(gap_us: int):
    """Per-partition session builder for ``mapInPandas``.

    Input: segments sorted by (key, start) -- ``t`` start, ``t2`` last event
    time, ``c`` rows, ``m`` values, ``v`` their total; a raw row is a segment with
    ``t2 == t`` and ``c == 1``.  A segment opens a new session when its key changes or its
    start lies more than ``gap`` after the latest ``t2`` seen in the session
    (a per-key running max).  Vectorised per Arrow batch; only the session
    open at a batch end is carried (as scalars) into the next batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_s = None  # (key, start, last, total, n, values) of the session still open
        for pdf in batches:
            if pdf.empty:
                continue
            ts, t2, val, cnt, got = (pdf[c].to_numpy(dtype=np.int64) for c in ("t", "t2", "v", "c", "m"))
            keys = pdf["skey"].to_numpy(dtype=object)
            new_key = np.ones(len(ts), dtype=bool)
            new_key[1:] = keys[1:] != keys[:-1]
            if open_s is not None:
                new_key[0] = keys[0] != open_s[0]
            # latest t2 before each segment within its key run (carry included)
            grp = np.cumsum(new_key)
            cm = pd.Series(t2).groupby(grp).cummax().to_numpy(dtype=np.int64)
            prev = np.empty_like(cm)
            prev[1:] = cm[:-1]
            prev[new_key] = np.iinfo(np.int64).min // 2
            if open_s is not None and not new_key[0]:
                first_run = grp == grp[0]
                prev[first_run] = np.maximum(prev[first_run], open_s[2])
            brk = new_key | (ts > prev + gap_us)
            if open_s is not None and not new_key[0]:
                brk[0] = bool(ts[0] > open_s[2] + gap_us)
            starts = np.flatnonzero(brk)
            cont = int(starts[0]) if len(starts) else len(ts)
            if open_s is not None and cont > 0:  # segments continuing the open session
                open_s = (open_s[0], open_s[1], max(open_s[2], int(t2[:cont].max())),
                          *[o + int(x[:cont].sum()) for o, x in zip(open_s[3:], (val, cnt, got))])
            if not len(starts):
                continue
            if open_s is not None:
                yield pd.DataFrame([open_s], columns=_PARTIAL)
            lasts = np.maximum.reduceat(t2, starts)
            sums = [np.add.reduceat(x, starts) for x in (val, cnt, got)]
            if len(starts) > 1:  # sessions that end inside this batch
                yield pd.DataFrame(dict(zip(_PARTIAL, [
                    keys[starts[:-1]], ts[starts[:-1]], lasts[:-1], *[x[:-1] for x in sums]])))
            a = int(starts[-1])
            open_s = (keys[a], int(ts[a]), int(lasts[-1]), *[int(x[-1]) for x in sums])
        if open_s is not None:
            yield pd.DataFrame([open_s], columns=_PARTIAL)

    return run


_PARTIAL = ["skey", "s_start", "s_last", "total", "n", "m"]
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _micros(ts):
    """Wall-clock microseconds of a timestamp, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts.cast("timestamp_ntz"))


def _from_micros(us):
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def session_windows(df: DataFrame, ts: str, gap: str, value, seq: str,
                    key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Sessions with ``count`` and exact ``total`` of an integral ``value``; rows
    without a time are in none.

    Returns ``[key,] session_start, session_end, n, total``.
    """
    v = F.col(value) if isinstance(value, str) else value
    kcol = F.col(key).cast("string") if key is not None else F.lit("")
    kind = df.select(v.alias("v")).schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"session totals are exact sums of integers, not of {kind.simpleString()}")
    t = _micros(F.col(ts))
    segs = df.select(kcol.alias("skey"), t.alias("t"), t.alias("t2"),
                     F.lit(1).cast("long").alias("c"), v.isNotNull().cast("long").alias("m"),
                     v.cast("long").alias("v"), F.col(seq).cast("long").alias("_seq"))
    out = session_segments(segs, gap, partitions)
    return out.select(
        *([F.col("skey").cast(df.schema[key].dataType).alias(key)] if key is not None else []),
        _from_micros(F.col("s_start")).alias("session_start"),
        _from_micros(F.col("s_last") + F.lit(_gap_micros(gap))).alias("session_end"),
        F.col("n"), F.when(F.col("m") > 0, F.col("total")).alias("total"))


def session_segments(segs: DataFrame, gap: str, partitions: int | None = None) -> DataFrame:
    """Merge segments ``(skey, t, t2, c, m, v, _seq)`` -- wall-clock microseconds,
    rows, values, their total; ``_seq`` breaks ties -- into sessions
    ``(skey, s_start, s_last, n, m, total)``.  Raw rows and already-built open
    sessions, which have a length, mix freely; the stream form feeds in both.
    Without ``m`` every row has a value.
    """
    if "m" not in segs.columns:
        segs = segs.withColumn("m", F.col("c"))
    gap_us = _gap_micros(gap)
    n = partitions or int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (segs.filter("t is not null").withColumn("v", F.coalesce("v", F.lit(0).cast("long")))
              .repartitionByRange(n, "skey", "t", "_seq").sortWithinPartitions("skey", "t", "_seq")
              .select("skey", "t", "t2", "c", "m", "v"))
    partial = ranged.mapInPandas(_partial_sessions(gap_us), "skey string, s_start long, s_last long, "
                                                            "total long, n long, m long")
    # the checkpoint fixes which session is in which partition
    shared_dir(segs.sparkSession)
    partial = partial.withColumn("_part", F.spark_partition_id()).checkpoint()
    # of every key and partition: how far its earlier partitions reach, and the last
    # session that starts in them; one row per key and partition
    earlier = Window.partitionBy("skey").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)

    def with_earlier(df: DataFrame, c: str, name: str) -> DataFrame:
        side = df.groupBy("skey", "_part").agg(F.max(c).alias(name)).select(
            F.col("skey").alias("_k"), F.col("_part").alias("_p"), F.max(name).over(earlier).alias(name))
        return df.join(side, F.col("skey").eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p"))) \
            .drop("_k", "_p")

    first = F.when(F.col("_reach").isNull() | (F.col("s_start") > F.col("_reach") + F.lit(gap_us)),
                   F.col("s_start"))
    marked = with_earlier(partial, "s_last", "_reach").withColumn("_first", first)
    joined = with_earlier(marked, "_first", "_from").withColumn("_from", F.coalesce("_first", "_from"))
    return joined.groupBy("skey", "_from").agg(
        F.max("s_last").alias("s_last"), F.sum("n").alias("n"), F.sum("m").alias("m"),
        F.sum("total").alias("total")).withColumnRenamed("_from", "s_start")
