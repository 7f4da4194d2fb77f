"""Prefix scans and ordered folds of any associative function.

A :class:`Fold` lifts a row to a value and combines the values of two
neighbouring ranges of rows, the earlier one first.  ``combine`` has to be
associative; it need not be commutative, and it needs no inverse.  No value (null)
stands before the first row.

Rows of a key are cut into buckets of ``width`` consecutive sequence numbers.  A
bucket's rows are one array in sequence order, folded by Spark's array functions; the
buckets' totals are cut into groups of ``width`` and folded the same way, level by
level.  So no task holds more than ``width`` rows of a key at once, as long as the sequence
spans fewer than ``width ** (levels + 2)`` numbers, and there is no window.

Rows without a sequence number come first and share a bucket.  Columns of map type
can't be carried, as Spark does not order them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_BUCKET = -(1 << 62)
#: Values folded in one go; chunks of a bucket are folded in turn.
CHUNK = 64


@dataclass(frozen=True)
class Fold:
    """``lift``: a row's value (any type); ``combine``: (earlier, later) -> both."""

    lift: Column
    combine: Callable[[Column, Column], Column]


def total_and_peak(value: str) -> Fold:
    """RUN-8/12: the total of a range and its highest running total, as s and m.
    Null values add nothing; before the first value both are null."""
    v = F.col(value)

    def both(a: Column, b: Column) -> Column:
        reach = F.coalesce(a["s"] + b["m"], b["m"])
        return F.struct(F.coalesce(a["s"] + b["s"], a["s"], b["s"]).alias("s"),
                        F.greatest(a["m"], reach).alias("m"))
    return Fold(F.struct(v.alias("s"), v.alias("m")), both)


def affine(a: Column, b: Column, modulus: int) -> Fold:
    """The maps x -> a * x + b (modulo ``modulus``, below 2**31), applied one after another."""
    m = F.lit(modulus).cast("long")

    def after(x: Column, y: Column) -> Column:
        return F.struct(F.pmod(x["a"] * y["a"], m).alias("a"),
                        F.pmod(y["a"] * x["b"] + y["b"], m).alias("b"))
    return Fold(F.struct(F.pmod(a.cast("long"), m).alias("a"), F.pmod(b.cast("long"), m).alias("b")),
                after)


def _bucket(order: str, width: int) -> Column:
    return F.coalesce(F.expr(f"`{order}` div {int(width)}"), F.lit(NULL_BUCKET))


def _folded(values: Column, fold: Fold) -> Column:
    """One value of a non-empty array."""
    return F.aggregate(F.slice(values, 2, F.size(values)), F.get(values, F.lit(0)), fold.combine)


def _growing(values: Column, kind: str, fold: Fold) -> Column:
    """All prefixes of a short array."""
    return F.aggregate(values, F.array().cast(kind), lambda acc, x: F.concat(acc, F.array(
        F.when(F.size(acc) == 0, x).otherwise(fold.combine(F.element_at(acc, -1), x)))))


def with_prefixes(df: DataFrame, values: str, fold: Fold, name: str) -> DataFrame:
    """``name``: the prefixes of the array ``values``, the array itself included."""
    kind = df.schema[values].dataType.simpleString()
    n = F.size(values)
    at = F.when(n > 0, F.sequence(F.lit(0), F.expr(f"(size(`{values}`) - 1) div {CHUNK}"))) \
        .otherwise(F.array().cast("array<int>"))
    d = df.withColumn("_chunks", F.transform(at.cast("array<int>"), lambda c: _growing(
        F.slice(values, c * CHUNK + 1, CHUNK), kind, fold)))
    d = d.withColumn("_tops", _growing(F.transform("_chunks", lambda c: F.element_at(c, -1)),
                                       kind, fold))
    return d.withColumn(name, F.flatten(F.transform("_chunks", lambda c, i: F.when(i == 0, c).otherwise(
        F.transform(c, lambda x: fold.combine(F.get("_tops", i - 1), x)))))).drop("_chunks", "_tops")


def _after(carry: Column, own: Column, fold: Fold) -> Column:
    return F.when(carry.isNull(), own).when(own.isNull(), carry).otherwise(fold.combine(carry, own))


def _carried(totals: DataFrame, fold: Fold, width: int, levels: int) -> DataFrame:
    """_key, _bkt and _c: the fold of all earlier buckets of the key (null: none).
    ``totals`` has _key, _bkt and _v."""
    up = _bucket("_bkt", width) if levels else F.lit(0).cast("long")
    groups = totals.withColumn("_up", up).groupBy("_key", "_up").agg(
        F.sort_array(F.collect_list(F.struct("_bkt", "_v"))).alias("_of"))
    groups = groups.withColumn("_vs", F.transform("_of", lambda x: x["_v"]))
    inner = with_prefixes(groups, "_vs", fold, "_p").select("_key", "_up", F.posexplode(
        F.arrays_zip("_of", "_p")).alias("_at", "_x"), "_p")
    # of a bucket's group, what comes before it
    inner = inner.select("_key", "_up", F.col("_x._of._bkt").alias("_bkt"),
                         F.when(F.col("_at") > 0, F.get("_p", F.col("_at") - 1)).alias("_own"))
    if not levels:
        return inner.select("_key", "_bkt", F.col("_own").alias("_c"))
    above = _carried(groups.select("_key", F.col("_up").alias("_bkt"), _folded(F.col("_vs"), fold)
                                   .alias("_v")), fold, width, levels - 1)
    above = above.select(F.col("_key").alias("_ck"), F.col("_bkt").alias("_cb"), "_c")
    both = inner.join(above, (F.col("_key") == F.col("_ck")) & (F.col("_up") == F.col("_cb")))
    return both.select("_key", "_bkt", _after(F.col("_c"), F.col("_own"), fold).alias("_c"))


def scan(df: DataFrame, key, order, fold: Fold, name: str, width: int, levels: int = 1) -> DataFrame:
    """Every row with ``name``, the fold of its key's rows up to and with it.

    ``order`` gives a total order within a key; its first column is integral.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    # the key is one struct column: its equality matches nulls inside it
    rows = df.select(F.struct(*[F.col(k) for k in key]).alias("_key"), _bucket(order[0], width).alias("_bkt"),
                     F.struct(F.struct(*order).alias("o"), F.struct(*df.columns).alias("row"),
                              fold.lift.alias("v")).alias("_r"))
    buckets = rows.groupBy("_key", "_bkt").agg(F.sort_array(F.collect_list("_r")).alias("_rows"))
    buckets = buckets.withColumn("_vs", F.transform("_rows", lambda r: r["v"]))
    totals = buckets.select("_key", "_bkt", _folded(F.col("_vs"), fold).alias("_v"))
    carry = _carried(totals, fold, int(width), levels).select(
        F.col("_key").alias("_ck"), F.col("_bkt").alias("_cb"), "_c")
    local = with_prefixes(buckets, "_vs", fold, "_p")
    met = local.join(carry, (F.col("_key") == F.col("_ck")) & (F.col("_bkt") == F.col("_cb")))
    out = met.select("_c", F.explode(F.arrays_zip("_rows", "_p")).alias("_x"))
    return out.select("_x._rows.row.*", _after(F.col("_c"), F.col("_x._p"), fold).alias(name))


def fold_groups(df: DataFrame, group, order: str, fold: Fold, name: str, width: int,
                levels: int = 1) -> DataFrame:
    """One row per group: its columns, ``n`` rows and ``name``, their fold by
    ``order`` (one integral column, unique within a group)."""
    group = [group] if isinstance(group, str) else list(group)
    t = df.select(F.struct(*[F.col(g) for g in group]).alias("_key"), _bucket(order, width).alias("_bkt"),
                  F.struct(F.col(order).alias("o"), fold.lift.alias("v")).alias("_x"),
                  F.lit(1).cast("long").alias("_n"))
    for level in range(levels + 2):
        g = t.groupBy("_key", "_bkt").agg(F.sort_array(F.collect_list("_x")).alias("_xs"),
                                          F.sum("_n").alias("_n"))
        one = _folded(F.transform("_xs", lambda x: x["v"]), fold)
        up = _bucket("_bkt", width) if level < levels else F.lit(0).cast("long")
        t = g.select("_key", up.alias("_bkt"), F.struct(F.col("_bkt").alias("o"), one.alias("v"))
                     .alias("_x"), "_n")
    return t.select("_key.*", F.col("_n").alias("n"), F.col("_x.v").alias(name))
