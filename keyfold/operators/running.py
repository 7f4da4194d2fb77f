"""Running aggregates: one output row per input row (RUN-1..14).

A keyed aggregate without a window emits after every record, in arrival order.
Spark has no arrival order, so every input carries a total ``order`` (a unique
sequence column, or several columns that together are unique).

Every running aggregate here is a monoid fold -- ``sum``, ``min`` or ``max`` of
an expression.  Arg-min / arg-max / "fields of the key's first record" are
``min``/``max`` over a struct whose leading fields are the ordering value and
the sequence, so ties resolve to the earliest record and the fold stays
associative.

Two physical forms:

* simple  -- ``Window.partitionBy(key).orderBy(order)`` with an
  unbounded-preceding frame.  One task per key: fine for many small keys.
* bucketed (``bucket_width`` given) -- the two-level prefix form.  Rows are cut
  into ranges of the leading order column (``bucket = order0 div width``).  A
  local running fold runs per (key, bucket) -- at most ``width`` rows per group
  when ``order0`` is unique -- and the fold of all earlier buckets of the key is
  carried in from a small per-(key, bucket) totals table (partial aggregation,
  map-side combined).  A key holding a third of all rows is spread over many
  tasks; the only per-key work is a window over the totals table, which has
  one row per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.operators.scan import scan, total_and_peak

_FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}
_NULL_BUCKET = -(1 << 62)


@dataclass(frozen=True)
class RunAgg:
    """A running fold ``op`` over ``expr``, published as ``name``.

    ``finish`` maps the folded column to the published value (for example to
    pick a field out of an arg-min struct); it may return several columns.
    """

    name: str
    op: str
    expr: Column
    finish: Callable[[Column], Sequence[Column] | Column] | None = None
    packed: bool = False  # a struct, which Spark can't aggregate by hash

    def combine(self, carry: Column, local: Column) -> Column:
        if self.op == "sum":
            # first bucket has no carry; a null local keeps the carry
            return F.coalesce(carry + local, local, carry)
        if self.op == "min":
            return F.least(carry, local)
        return F.greatest(carry, local)


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def run_sum(expr, name: str, finish=None) -> RunAgg:
    return RunAgg(name, "sum", F.col(expr) if isinstance(expr, str) else expr, finish)


def run_count(name: str) -> RunAgg:
    return RunAgg(name, "sum", F.lit(1).cast("long"))


def run_min(expr, name: str) -> RunAgg:
    return RunAgg(name, "min", F.col(expr) if isinstance(expr, str) else expr)


def run_max(expr, name: str) -> RunAgg:
    return RunAgg(name, "max", F.col(expr) if isinstance(expr, str) else expr)


def _struct_payload(value: Column, tie: Column, fields: Sequence[str]) -> Column:
    return F.struct(value.alias("_v"), tie.alias("_t"),
                    *[F.col(f).alias(f) for f in fields])


def _unpack(prefix: str, fields: Sequence[str]):
    def finish(c: Column):
        return [c.getField(f).alias(f"{prefix}{f}") for f in fields]
    return finish


def run_min_by(value, seq: str, fields: Sequence[str], prefix: str) -> RunAgg:
    """Whole record holding the running minimum of ``value``; earliest wins ties,
    and a null value loses to every other."""
    v = F.col(value) if isinstance(value, str) else value
    return RunAgg(prefix + "rec", "min",
                  F.struct(v.isNull().alias("_z"), _struct_payload(v, F.col(seq), fields)
                           .alias("_r")),
                  lambda c: _unpack(prefix, fields)(c["_r"]), packed=True)


def run_max_by(value, seq: str, fields: Sequence[str], prefix: str) -> RunAgg:
    """Whole record holding the running maximum of ``value``; earliest wins ties."""
    v = F.col(value) if isinstance(value, str) else value
    return RunAgg(prefix + "rec", "max", _struct_payload(v, -F.col(seq), fields),
                  _unpack(prefix, fields), packed=True)


def run_first(seq: str, fields: Sequence[str], prefix: str) -> RunAgg:
    """Fields of the key's first record (the record with the smallest ``seq``)."""
    return RunAgg(prefix + "rec", "min",
                  F.struct(F.col(seq).alias("_t"), *[F.col(f).alias(f) for f in fields]),
                  _unpack(prefix, fields), packed=True)


def _publish(aggs: Sequence[RunAgg], folded: dict[str, Column]) -> list[Column]:
    out: list[Column] = []
    for a in aggs:
        c = folded[a.name]
        if a.finish is None:
            out.append(c.alias(a.name))
        else:
            r = a.finish(c)
            out.extend(r if isinstance(r, (list, tuple)) else [r])
    return out


def running(df: DataFrame, key, order, aggs: Sequence[RunAgg],
            bucket_width: int | None = None, carry_levels: int = 1) -> DataFrame:
    """Append running folds to every row of ``df``.

    ``key``: grouping column(s); ``order``: column(s) giving a total arrival
    order within a key.  With ``bucket_width`` the two-level prefix plan is
    used, bucketing on ``order[0] div bucket_width`` (``order[0]`` integral);
    ``carry_levels`` more levels fold the bucket totals the same way, so no
    window ever holds more than ~``bucket_width`` rows of one key until
    N > bucket_width ** (carry_levels + 2).
    """
    key, order = _cols(key), _cols(order)
    base_cols = [F.col(c) for c in df.columns]
    if not bucket_width:
        w = (Window.partitionBy(*key).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        folded = {a.name: _FOLDS[a.op](a.expr).over(w) for a in aggs}
        return df.select(*base_cols, *_publish(aggs, folded))

    local, totals = _local(df, key, order, aggs, int(bucket_width))
    carry = _exclusive_prefix(totals, aggs, int(bucket_width), carry_levels)
    carry = carry.select(F.col("_key").alias("_ck"), F.col("_bkt").alias("_cb"),
                         *[f"_c{i}" for i in range(len(aggs))])
    # merged: both sides lie by (_key, _bkt), and were small rows broadcast to the
    # carry instead, they would come out in its one task a key
    joined = local.join(carry.hint("merge"), (F.col("_key") == F.col("_ck"))
                        & (F.col("_bkt") == F.col("_cb")), "inner")
    folded = {a.name: a.combine(F.col(f"_c{i}"), F.col(f"_l{i}"))
              for i, a in enumerate(aggs)}
    return joined.select(*_given(df, key), *_publish(aggs, folded))


def _given(df: DataFrame, key: Sequence[str]) -> list[Column]:
    """The columns of ``df``; its key is read from the struct, so that it need
    not travel twice and totals can use the rows' own shuffle."""
    return [F.col("_key")[c].alias(c) if c in key else F.col(c) for c in df.columns]


def _local(df: DataFrame, key: Sequence[str], order: Sequence[str], aggs: Sequence[RunAgg],
           width: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the folds of their bucket so far (``_l{i}``), and the buckets'
    totals (``_key``, ``_bkt``, ``_t{i}``)."""
    # One struct column carries the key: struct equality matches nested nulls,
    # so null keys survive the joins, and the row window, the totals and the
    # carry join all cluster on the same (_key, _bkt) -- the row side is
    # shuffled once; only the small carry side moves for the join.
    # _bkt is non-nullable (null sequence -> a first sentinel bucket, as the
    # simple form orders nulls first): no isnotnull filter is inferred into
    # one branch only, so both uses of the totals share one exchange.
    b = df.select("*", F.struct(*[F.col(k) for k in key]).alias("_key"),
                  F.coalesce(F.expr(f"`{order[0]}` div {width}"), F.lit(_NULL_BUCKET)).alias("_bkt"))
    by = Window.partitionBy("_key", "_bkt").orderBy(*order)
    so_far = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.select("*", *[_FOLDS[a.op](a.expr).over(so_far).alias(f"_l{i}")
                            for i, a in enumerate(aggs)])
    if not any(a.packed for a in aggs):
        # partial + final hash aggregate, one row per bucket
        return local, b.groupBy("_key", "_bkt").agg(
            *[_FOLDS[a.op](a.expr).alias(f"_t{i}") for i, a in enumerate(aggs)])
    # Spark aggregates structs by sorting all rows.  The rows are sorted already:
    # a bucket's totals are the running values of its last row, read from the
    # rows' own shuffle.
    last = local.withColumn("_end", F.lead(F.lit(False), 1, True).over(by)).filter("_end")
    return local, last.select("_key", "_bkt", *[F.col(f"_l{i}").alias(f"_t{i}")
                                                for i in range(len(aggs))])


def key_totals(df: DataFrame, key, order, aggs: Sequence[RunAgg], width: int) -> DataFrame:
    """Key columns and the folds of all rows of a key."""
    key, order = _cols(key), _cols(order)
    if not any(a.packed for a in aggs):
        return df.groupBy(*key).agg(*[_FOLDS[a.op](a.expr).alias(a.name) for a in aggs])
    _, totals = _local(df, key, order, aggs, int(width))
    g = totals.groupBy("_key").agg(*[_FOLDS[a.op](F.col(f"_t{i}")).alias(a.name)
                                     for i, a in enumerate(aggs)])
    return g.select("_key.*", *[a.name for a in aggs])


def _exclusive_prefix(totals: DataFrame, aggs: Sequence[RunAgg], width: int,
                      levels: int) -> DataFrame:
    """Fold of all earlier buckets of the key, for every (``_key``, ``_bkt``) row.

    ``totals`` holds one row per (key, bucket) with the bucket folds ``_t{i}``;
    the result has ``_c{i}`` (null for a key's first bucket).  With
    ``levels > 0`` the same two-level trick is applied to the buckets
    themselves: buckets are grouped ``width`` at a time, an exclusive window
    runs inside each group and the groups' own prefix is carried in
    recursively -- so the top window per key sees N / width**(levels + 1)
    rows, whatever N is.
    """
    n = len(aggs)
    if levels <= 0:
        wc = (Window.partitionBy("_key").orderBy("_bkt")
              .rowsBetween(Window.unboundedPreceding, -1))
        return totals.select("_key", "_bkt", *[_FOLDS[a.op](F.col(f"_t{i}")).over(wc)
                                               .alias(f"_c{i}") for i, a in enumerate(aggs)])
    t2 = totals.withColumn("_sup", F.coalesce(F.expr(f"_bkt div {width}"),
                                              F.lit(_NULL_BUCKET)))
    wi = (Window.partitionBy("_key", "_sup").orderBy("_bkt")
          .rowsBetween(Window.unboundedPreceding, -1))
    inner = t2.select("_key", "_bkt", "_sup", *[_FOLDS[a.op](F.col(f"_t{i}")).over(wi)
                                                .alias(f"_x{i}") for i, a in enumerate(aggs)])
    sup_totals = t2.groupBy("_key", "_sup").agg(
        *[_FOLDS[a.op](F.col(f"_t{i}")).alias(f"_t{i}") for i, a in enumerate(aggs)]) \
        .withColumnRenamed("_sup", "_bkt")
    up = _exclusive_prefix(sup_totals, aggs, width, levels - 1)
    up = up.select(F.col("_key").alias("_uk"), F.col("_bkt").alias("_usup"),
                   *[F.col(f"_c{i}").alias(f"_y{i}") for i in range(n)])
    j = inner.join(up, (F.col("_key") == F.col("_uk")) & (F.col("_sup") == F.col("_usup")),
                   "inner")
    return j.select("_key", "_bkt", *[a.combine(F.col(f"_y{i}"), F.col(f"_x{i}"))
                                      .alias(f"_c{i}") for i, a in enumerate(aggs)])


def running_total_max(df: DataFrame, key, order, value: str, bucket_width: int,
                      total: str = "run_total", top: str = "run_max_total") -> DataFrame:
    """RUN-8/12: running total of ``value`` and the running maximum of that total,
    as one scan of (total, maximum) pairs."""
    out = scan(df, key, order, total_and_peak(value), "_scan", bucket_width)
    return out.select(*df.columns, F.col("_scan.s").alias(total), F.col("_scan.m").alias(top))


def first_occurrence_flag(df: DataFrame, cols, order, name: str = "is_first") -> DataFrame:
    """1 on the earliest row (by ``order``) of each ``cols`` combination, else 0.

    Computed as a grouped min (map-side combined) joined back on ``cols``; a hot
    combination is split by AQE's skew-join handling instead of being sorted in
    one window task.
    """
    cols, order = _cols(cols), _cols(order)
    # one order column: a plain min runs as a hash aggregate; a struct min
    # (several columns) can only run as a sort aggregate
    first_of = F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))
    this = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    firsts = df.groupBy(*cols).agg(first_of.alias("_first"))
    firsts = firsts.select(*[F.col(c).alias(f"_g{j}") for j, c in enumerate(cols)], "_first")
    cond = [F.col(c).eqNullSafe(F.col(f"_g{j}")) for j, c in enumerate(cols)]
    j = df.join(firsts, cond, "inner")
    flag = F.when(this == F.col("_first"), F.lit(1)).otherwise(F.lit(0))
    return j.select(*[F.col(c) for c in df.columns], flag.alias(name))
