"""Typed parsing of comma-separated lines (PRJ-1..11).

Every parser takes a DataFrame with a string column ``value`` (plus any other
columns, e.g. ``seq``, which are carried along) and returns ``(good, bad)``:

* ``good`` -- the typed columns named as in FIXTURES.md, plus carried columns;
* ``bad``  -- the rejected lines with a ``reason``.

``mode="fail"`` instead makes the job fail on the first bad line, like the
original programs did.  All parsing is built-in column expressions (``split``,
``try_cast``), so it stays inside whole-stage codegen and works unchanged on
streaming frames.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TRY = {"int": "int", "long": "bigint", "double": "double", "string": None}


@dataclass(frozen=True)
class Field:
    """Field ``index`` of the split line, converted to ``kind``.

    ``convert`` overrides the conversion: it gets the raw token (and the split
    array) and returns ``(value, ok)`` columns.
    """

    name: str
    index: int
    kind: str = "string"
    convert: Callable[[Column, Column], tuple[Column, Column]] | None = None


def _token(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))  # null when the line is too short


def _typed(tok: Column, kind: str) -> Column:
    t = _TRY[kind]
    return tok if t is None else tok.try_cast(t)


def parse_lines(df: DataFrame, fields: Sequence[Field], sep: str = ",",
                extra: Sequence[Column] = (), mode: str = "reject",
                value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split ``value_col`` on ``sep`` and type ``fields``.

    A line is bad when it has too few tokens or a token does not convert.
    ``extra`` columns are computed over the typed fields (they may refer to
    the field names).

    Plan shape: one projection splits the line once (``parts``), a second
    types every field into ``struct`` values, and rows are routed with
    ``inline(array_compact(array(when(ok, row))))`` -- a ``Generate`` rather
    than a ``Filter``, so Catalyst cannot push the validity test below the
    projections and re-evaluate the split for every field.
    """
    carried = [c for c in df.columns if c != value_col]
    split = df.select(*[F.col(c) for c in df.columns],
                      F.split(F.col(value_col), _regex_literal(sep), -1).alias("_parts"))
    parts = F.col("_parts")
    vals, oks = [], []
    for f in fields:
        tok = _token(parts, f.index)
        if f.convert is not None:
            v, ok = f.convert(tok, parts)
        else:
            v = _typed(tok, f.kind)
            ok = v.isNotNull()
        vals.append(v.alias(f.name))
        oks.append(F.coalesce(ok, F.lit(False)))
    all_ok = oks[0]
    for o in oks[1:]:
        all_ok = all_ok & o
    if mode == "fail":
        all_ok = F.when(all_ok, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad line: "), F.col(value_col))))
    reason = F.concat(F.lit("bad field: "), F.concat_ws(
        ";", *[F.when(~o, F.lit(f.name)) for f, o in zip(fields, oks)]))
    typed = split.select(
        *[F.col(c) for c in df.columns], all_ok.alias("_ok"), reason.alias("_why"),
        F.struct(*vals).alias("_rec"))
    good_row = F.struct(*[F.col("_rec")[f.name].alias(f.name) for f in fields],
                        *[F.col(c) for c in carried])
    bad_row = F.struct(F.col(value_col).alias("bad_line"), F.col("_why").alias("reason"),
                       *[F.col(c) for c in carried])
    good = typed.select(F.inline(F.array_compact(F.array(
        F.when(F.col("_ok"), good_row)))))
    if extra:
        good = good.select(*[f.name for f in fields], *extra, *carried)
    bad = typed.select(F.inline(F.array_compact(F.array(
        F.when(~F.col("_ok"), bad_row)))))
    return good, bad


def _regex_literal(sep: str) -> str:
    specials = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in specials else ch for ch in sep)


# --- converters ---------------------------------------------------------

def double_or_zero(tok: Column, _parts: Column) -> tuple[Column, Column]:
    """PRJ-3: a non-number (e.g. the text ``'null'``) counts as 0.0; never rejects."""
    return F.coalesce(tok.try_cast("double"), F.lit(0.0)), tok.isNotNull()


def yes_flag(tok: Column, _parts: Column) -> tuple[Column, Column]:
    """PRJ-4: status text to boolean, case-insensitive ``yes``."""
    return F.lower(tok) == F.lit("yes"), tok.isNotNull()


def passengers_if_ongoing(flag_index: int):
    """PRJ-4: passengers parsed only for ongoing trips, else 0."""
    def conv(tok: Column, parts: Column) -> tuple[Column, Column]:
        on = F.lower(_token(parts, flag_index)) == F.lit("yes")
        n = tok.try_cast("int")
        return (F.when(on, n).otherwise(F.lit(0)),
                F.when(on, n.isNotNull()).otherwise(tok.isNotNull()))
    return conv


def timestamp_of(date_index: int, time_index: int, fmt: str = "dd/MM/yyyy HH:mm:ss"):
    """WM-2: event time from a date and a time field; unparsable -> rejected."""
    def conv(_tok: Column, parts: Column) -> tuple[Column, Column]:
        txt = F.concat_ws(" ", _token(parts, date_index), _token(parts, time_index))
        ts = F.try_to_timestamp(txt, F.lit(fmt)).cast("timestamp_ntz")
        return ts, ts.isNotNull()
    return conv


def millis_timestamp(tok: Column, _parts: Column) -> tuple[Column, Column]:
    """Epoch milliseconds to a wall-clock timestamp (no session-zone shift)."""
    ms = tok.try_cast("bigint")
    ts = F.timestamp_add("MILLISECOND", ms, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return ts, ms.isNotNull()


# --- the original line formats (field order fixed by the inputs) -------

def parse_sales(df: DataFrame, mode: str = "reject"):
    """PRJ-1/2: ``date,month,category,product,profit`` (date kept as text)."""
    return parse_lines(df, [Field("date", 0), Field("month", 1), Field("category", 2),
                            Field("product", 3), Field("profit", 4, "int")], mode=mode)


def parse_cab(df: DataFrame, mode: str = "reject"):
    """PRJ-3: tolerant cab parser; idle cabs' non-number passengers -> 0.0."""
    return parse_lines(df, [Field("cab_id", 0), Field("plate", 1), Field("cab_type", 2),
                            Field("driver", 3), Field("ongoing", 4), Field("pickup", 5),
                            Field("destination", 6),
                            Field("passengers", 7, convert=double_or_zero)], mode=mode)


def parse_cab_strict(df: DataFrame, mode: str = "reject"):
    """PRJ-4: status -> boolean; passengers parsed only when ongoing, else 0."""
    return parse_lines(df, [Field("cab_id", 0), Field("plate", 1), Field("cab_type", 2),
                            Field("driver", 3), Field("ongoing", 4, convert=yes_flag),
                            Field("pickup", 5), Field("destination", 6),
                            Field("passengers", 7, convert=passengers_if_ongoing(4))],
                       mode=mode)


def parse_click(df: DataFrame, mode: str = "reject"):
    """PRJ-5/6: click record; the raw line stays available as ``value``."""
    good, bad = parse_lines(
        df.withColumn("line", F.col("value")),
        [Field("user_id", 0), Field("network_name", 1), Field("user_ip", 2),
         Field("user_country", 3), Field("website", 4), Field("time_spent", 5, "long")],
        mode=mode)
    return good, bad


def parse_trade(df: DataFrame, symbol: Column | str = "XYZ", mode: str = "reject"):
    """PRJ-7 + WM-2: ``date,time,price,volume``; symbol is a column (constant allowed)."""
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    return parse_lines(df, [Field("date", 0), Field("time", 1),
                            Field("price", 2, "double"), Field("volume", 3, "int"),
                            Field("ts", 0, convert=timestamp_of(0, 1))],
                       extra=[sym.alias("symbol")], mode=mode)


def parse_pair(df: DataFrame, mode: str = "reject"):
    """PRJ-8: ``key,value`` both long."""
    return parse_lines(df, [Field("key", 0, "long"), Field("value_n", 1, "long")],
                       mode=mode)


def parse_event_pair(df: DataFrame, mode: str = "reject"):
    """``ts_ms,value`` -> event time from epoch milliseconds plus an int value."""
    return parse_lines(df, [Field("ts_ms", 0, "long"), Field("value_n", 1, "int"),
                            Field("ts", 0, convert=millis_timestamp)], mode=mode)


def parse_employee(df: DataFrame, mode: str = "reject"):
    """PRJ-9: ``emp_id,name,role,dept,code``; the line is kept as ``line``."""
    return parse_lines(df.withColumn("line", F.col("value")),
                       [Field("emp_id", 0), Field("name", 1), Field("role", 2),
                        Field("dept", 3), Field("code", 4)], mode=mode)


def parse_number(df: DataFrame, mode: str = "reject"):
    """PRJ-11: one integer a line."""
    return parse_lines(df, [Field("v", 0, "int")], mode=mode)
