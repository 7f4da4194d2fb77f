"""Count-triggered groups (ST-1..3) and fixed-size batches (SNK-6).

Per key, every ``n`` arrivals form a group; the group's fold is emitted and the
state cleared; an incomplete trailing group is never emitted.  In batch form
the arrival number is a running count (two-level prefix form when
``bucket_width`` is set, so a hot key is not sorted in one task); groups are
then ``(rn - 1) div n`` -- each at most ``n`` rows -- and folded by a grouped
aggregate, keeping only full groups.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.operators.running import run_count, running
from keyfold.operators.scan import Fold, fold_groups


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def number_arrivals(df: DataFrame, key, seq: str, bucket_width: int | None = None,
                    name: str = "_rn") -> DataFrame:
    return running(df, key, seq, [run_count(name)], bucket_width)


def count_chunks(df: DataFrame, key, seq: str, n: int,
                 aggs: Callable[[], list[Column]], bucket_width: int | None = None
                 ) -> DataFrame:
    """ST-1/3: fold each full group of ``n`` arrivals per key.

    ``aggs`` returns the aggregate columns; a reducer of the user's own goes through
    :func:`count_chunk_fold`.  Output: key, ``chunk_no`` (0-based), the aggregates; full groups only.
    """
    key = _cols(key)
    numbered = number_arrivals(df, key, seq, bucket_width)
    chunked = numbered.withColumn("chunk_no", F.expr(f"(_rn - 1) div {int(n)}"))
    g = chunked.groupBy(*key, "chunk_no").agg(F.count(F.lit(1)).alias("_cnt"), *aggs())
    return g.filter(F.col("_cnt") == n).drop("_cnt")


def count_chunk_fold(df: DataFrame, key, seq: str, n: int, fold: Fold, name: str,
                     bucket_width: int | None = None) -> DataFrame:
    """ST-3 with any associative reducer, also one that depends on the order: the
    fold of each full group of ``n`` arrivals per key, in order of arrival.

    Groups longer than a bucket are folded bucket by bucket.
    """
    numbered = number_arrivals(df, key, seq, bucket_width, "arrival_no").withColumn(
        "chunk_no", F.expr(f"(arrival_no - 1) div {int(n)}"))
    return fold_chunks(numbered, key, n, fold, name, bucket_width)


def fold_chunks(numbered: DataFrame, key, n: int, fold: Fold, name: str,
                bucket_width: int | None = None) -> DataFrame:
    """key, ``chunk_no`` and the fold of all full groups, of rows that have
    ``arrival_no`` and ``chunk_no``."""
    g = fold_groups(numbered, [*_cols(key), "chunk_no"], "arrival_no", fold, name,
                    bucket_width or n, levels=0 if not bucket_width or n <= bucket_width else 1)
    return g.filter(F.col("n") == n).drop("n")


def count_chunk_list(df: DataFrame, key, seq: str, value: Column, n: int,
                     bucket_width: int | None = None) -> DataFrame:
    """ST-2: the group's values in arrival order, each after one space, and their sum.

    ``value`` must be integral or decimal so text and sum are exact.
    """
    def aggs():
        return [F.sort_array(F.collect_list(F.struct(F.col(seq).alias("s"),
                                                     value.alias("v")))).alias("_vals"),
                F.sum(value).alias("total")]
    g = count_chunks(df, key, seq, n, aggs, bucket_width)
    text = F.concat(F.lit(" "), F.array_join(
        F.transform(F.col("_vals"), lambda x: x["v"].cast("string")), " "))
    return g.select(*[c for c in g.columns if c not in ("_vals", "total")],
                    text.alias("values_text"), "total")


def fixed_batches(df: DataFrame, bucket: Column, seq: str, n: int,
                  bucket_width: int | None = None) -> DataFrame:
    """SNK-6: buffer rows per bucket and release them in groups of exactly ``n``.

    Rows get ``bucket`` and ``batch_no``; rows of an incomplete last batch stay
    buffered (not emitted).  ``bucket`` spreads the buffer, e.g.
    ``pmod(hash(key), buckets)``.
    """
    b = df.withColumn("bucket", bucket)
    numbered = number_arrivals(b, "bucket", seq, bucket_width)
    numbered = numbered.withColumn("batch_no", F.expr(f"(_rn - 1) div {int(n)}"))
    # one row per bucket value; Spark broadcasts it by its size
    full = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("_tot"))
    full = full.withColumnRenamed("bucket", "_bucket")
    out = numbered.join(full, F.col("bucket").eqNullSafe(F.col("_bucket"))).filter(
        F.col("batch_no") < F.expr(f"_tot div {int(n)}"))
    return out.drop("_tot", "_rn", "_bucket")
