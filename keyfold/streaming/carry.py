"""Per-record and count-triggered operators on a stream, as ``foreachBatch``
functions over the batch operators.

A micro-batch is one batch run: the two-level running plan of
:mod:`keyfold.operators.running` (or the numbering of
:mod:`keyfold.operators.count_window`) cuts every key into ranges of the sequence,
so a key with a third of the rows spreads over tasks, and no task holds all rows
of a key.  What goes from one micro-batch to the next is a carry table: one row
per key with its folds (``running_writer``) or its last window
(``previous_window_writer``), the members seen (``distinct_flags``), or the fewer than
``n`` rows that wait (``chunk_writer``).  :mod:`keyfold.streaming.epochs` keeps them.

Output goes to one folder per epoch, overwritten when an epoch is repeated, so a
micro-batch that runs twice writes the same files.  Types and nulls are those of the
batch operators.
"""

from __future__ import annotations

from dataclasses import replace
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.count_window import number_arrivals
from keyfold.operators.running import _FOLDS, RunAgg, _cols, _publish, key_totals, running
from keyfold.streaming.epochs import Growing, Latest


def _same(left: Sequence[str], right: Sequence[str]):
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def _renamed(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = [f"_k{i}" for i in range(len(key))]
    for a, b in zip(key, names):
        df = df.withColumnRenamed(a, b)
    return df, names


def running_writer(spark: SparkSession, key, order, stages: Sequence[Sequence[RunAgg]],
                   keep: Sequence[str], base: str, width: int,
                   prepare: Callable[[DataFrame, int], DataFrame] | None = None):
    """RUN-*: running folds on every row; ``keep`` columns and the folds are
    written under ``base``/out.  A later stage folds what an earlier one gives
    (a running maximum of a running total)."""
    key, order = _cols(key), _cols(order)
    carry = [Latest(spark, f"{base}/carry{i}") for i in range(len(stages))]

    def run(batch: DataFrame, epoch: int) -> None:
        rows = prepare(batch, epoch) if prepare else batch
        given = list(keep)
        for i, aggs in enumerate(stages):
            raw = [replace(a, finish=None) for a in aggs]
            totals = key_totals(rows, key, order, raw, width)
            out = running(rows, key, order, raw, width)
            folded = {a.name: F.col(a.name) for a in raw}
            prev = carry[i].before(epoch, totals.schema)
            if prev is not None:
                side, names = _renamed(prev, key)
                for a in raw:
                    side = side.withColumnRenamed(a.name, f"_carry_{a.name}")
                out = out.join(side, _same(key, names), "left")
                folded = {a.name: a.combine(F.col(f"_carry_{a.name}"), F.col(a.name))
                          for a in raw}
                totals = prev.unionByName(totals).groupBy(*key).agg(
                    *[_FOLDS[a.op](a.name).alias(a.name) for a in raw])
            carry[i].write(totals, epoch)
            found = out.select(*rows.columns, *_publish(aggs, folded))
            given += [c for c in found.columns if c not in rows.columns]
            rows = found
        rows.select(*given).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")
    return run


def distinct_flags(spark: SparkSession, key, order, member: str, base: str, buckets: int = 64,
                   merge: int = 8):
    """RUN-13: a ``prepare`` step that adds ``is_new``: 1 on the first row ever
    of a (key, member), else 0.  A null member is a member like any other, as in
    the batch form.  Of the members seen only the buckets are read that the
    micro-batch's members fall into."""
    key, order = _cols(key), _cols(order)
    pair = key + [member]
    seen = Growing(spark, f"{base}/seen", pair, buckets, merge)

    def prepare(batch: DataFrame, epoch: int) -> DataFrame:
        this = F.col(order[0]) if len(order) == 1 else F.struct(*order)
        first = batch.groupBy(*pair).agg(F.min(this).alias("_first"))
        before = seen.before(epoch, batch)
        if before is not None:
            known, names = _renamed(before, pair)
            first = first.join(known, _same(pair, names), "left_anti")
        # written, so that adding to the members seen does not change what is new
        path = f"{base}/first/epoch={epoch}"
        first.write.mode("overwrite").parquet(path)
        first = spark.read.schema(first.schema).parquet(path)
        seen.add(first, epoch)
        side, names = _renamed(first, pair)
        return batch.join(side, _same(pair, names), "left").withColumn(
            "is_new", F.coalesce(this == F.col("_first"), F.lit(False)).cast("long")) \
            .drop(*names, "_first")
    return prepare


def chunk_writer(spark: SparkSession, key, seq: str, n: int,
                 emit: Callable[[DataFrame], DataFrame], base: str, width: int):
    """ST-1..3 / SNK-6: rows of full groups of ``n`` arrivals per key, with
    ``chunk_no`` and ``arrival_no`` (1, 2, ... in the key's order of arrival), go through
    ``emit`` to ``base``/out; the rest waits.  Rows arrive by epoch, within an epoch
    by ``seq``."""
    key = _cols(key)
    waiting, counts = Latest(spark, f"{base}/rest"), Latest(spark, f"{base}/counts")

    def run(batch: DataFrame, epoch: int) -> None:
        totals = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        before = counts.before(epoch, totals.schema)
        numbered = number_arrivals(batch, key, seq, width)
        if before is None:
            numbered = numbered.withColumn("arrival_no", F.col("_rn"))
        else:
            side, names = _renamed(before, key)
            numbered = numbered.join(side, _same(key, names), "left").withColumn(
                "arrival_no", F.col("_rn") + F.coalesce("_n", F.lit(0).cast("long"))).drop("_n", *names)
            totals = before.unionByName(totals).groupBy(*key).agg(F.sum("_n").alias("_n"))
        totals = counts.write(totals, epoch)
        rows = numbered.drop("_rn").withColumn("chunk_no", F.expr(f"(arrival_no - 1) div {int(n)}"))
        rest = waiting.before(epoch, rows.schema)
        rows = rows if rest is None else rest.unionByName(rows)
        side, names = _renamed(totals, key)
        tagged = rows.join(side, _same(key, names)).drop(*names)
        full = F.col("chunk_no") < F.expr(f"_n div {int(n)}")
        emit(tagged.filter(full).drop("_n")).write.mode("overwrite") \
            .parquet(f"{base}/out/epoch={epoch}")
        waiting.write(tagged.filter(~full).drop("_n"), epoch)
    return run


def previous_window_writer(spark: SparkSession, key, with_previous: Callable[[DataFrame], DataFrame],
                           base: str):
    """WIN-9/10, ST-4: closed windows, in order per key, beside the key's previous
    (non-empty) window.  ``with_previous`` is the batch operator: it looks back over the
    windows of a key, of which the carry table adds the last one of earlier epochs.
    A micro-batch has one row per key and window that closes in it."""
    key = _cols(key)
    last = Latest(spark, f"{base}/last")

    def run(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("_new", F.lit(True))
        before = last.before(epoch, rows.schema)
        rows = rows if before is None else rows.unionByName(before)
        with_previous(rows).filter("_new").drop("_new").write.mode("overwrite") \
            .parquet(f"{base}/out/epoch={epoch}")
        rest = [c for c in rows.columns if c not in key and c != "_new"]
        keep = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "window_start").alias("_w"))
        last.write(keep.select(*key, "_w.*", F.lit(False).alias("_new")).select(*rows.columns), epoch)
    return run
