"""Mixing sources to target weights by systematic sampling.

Targets: sources weigh ``weights`` in turn and share the total size; none may
exceed ``cap`` times its own size, and what is over is shared again by weight
among the rest until none is above.  Documents of a source are put in order of
size; the running sum of their expected copies (target / source size each)
starts at one random offset per source, and a document is taken once for every
whole number the sum crosses at it.  Neighbours in size stand in for one
another, so a source's taken words miss its target by about one document.

The running sum needs no window over a source: see ``ordered_rank``.  What the
driver sees is one row of sums per round of sharing.

Defined cases: null text has size 0; null is a source of its own, the last;
a source of size 0 has target 0 and takes nothing; rows that agree in size and
id are ordered by a hash of the text, and rows that agree in that too are
interchangeable, and share their copies by the rest of their columns; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import ordered_rank, words, written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target of ``sizes`` (source, size): one row per source."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = ordered_rank(s.withColumn("last", F.col("source").isNull()), [],
                     [F.col("last"), F.col("source")], "mix-sources", "nr")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("nr") - 1) % len(weights) + 1).cast("int"))
    s = written(s.select("source", "source_size", weight.cast("long").alias("weight")),
                "mix-weights")
    most = F.col("source_size") * cap
    total = s.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    left, w = total["t"] or 0, total["w"] or 0
    level = left / w if w else 0.0
    while True:  # each round caps at least one more source
        full = s.filter(most <= F.col("weight") * level).agg(
            F.sum(most).alias("t"), F.sum("weight").alias("w")).first()
        now_left, now_w = left - (full["t"] or 0), w - (full["w"] or 0)
        higher = now_left / now_w if now_w else 0.0
        if higher <= level:
            break
        level = higher
    return s.select("source", "source_size",
                    F.when(most <= F.col("weight") * level, most.cast("double"))
                    .otherwise(F.col("weight") * level).alias("target"))


def offset_of(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by seed and source, in steps of 1/65536."""
    h = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("")))), 1, 4)
    return F.conv(h, 16, 10).cast("double") / 65536


def copies(sized: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``sized`` (doc_id, source, size, tie) with source_size, target, copies."""
    t = targets(sized, weights, cap).withColumnRenamed("source", "of")
    r = ordered_rank(sized, ["source"], [F.col("size"), F.col("doc_id"), F.col("tie")],
                     "mix-ranks")
    r = r.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    u = offset_of(F.col("source"), seed)
    crossed = F.floor(u + F.col("rank") * rate) - F.floor(u + (F.col("rank") - 1) * rate)
    # rounding at a boundary may not give a document more than its rate, rounded up
    return r.withColumn("copies", F.least(crossed, F.ceil(rate)).cast("long")).drop("rank")


def sizes(docs: DataFrame, doc_id="doc_id", text="text", source="source") -> DataFrame:
    return written(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.size(words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(F.col(text)).alias("tie")), "mix-sizes")


def mix(docs: DataFrame, doc_id="doc_id", text="text", source="source", **kw) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns as given.

    Plan and documents meet on (id, source, text hash).  Rows that agree in these
    share their copies: by all columns they are counted (one row for any number of
    repeats), each kind of row takes its part of the copies in turn, each row its whole share of
    that part, and what is left goes to one row of the kind.
    """
    key = ["_k0", "_k1", "_k2"]
    plan = copies(sizes(docs, doc_id, text, source), **kw).groupBy(
        F.col("doc_id").alias(key[0]), F.col("source").alias(key[1]), F.col("tie").alias(key[2])) \
        .agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_rows"))
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).alias(key[0]),
                    F.col(source).alias(key[1]), F.xxhash64(F.col(text)).alias(key[2]),
                    F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_kind"))
    kinds = d.groupBy(*key, "_kind").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*key).orderBy("_kind").rowsBetween(Window.unboundedPreceding, 0)
    kinds = kinds.withColumn("_upto", F.sum("_n").over(upto)).select(
        *[F.col(k).alias("p" + k) for k in [*key, "_kind"]], "_n", "_upto")
    same = lambda a, b: [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b)]
    shares = kinds.join(plan, same(["p" + k for k in key], key)).drop(*key)
    part = F.expr("_all * _upto div _rows - _all * (_upto - _n) div _rows")
    # from a table, so that a row repeated very often may split over tasks
    shares = written(shares.withColumn("_part", part).filter("_part > 0").select(
        *["p" + k for k in [*key, "_kind"]], F.expr("_part div _n").alias("_each"),
        F.expr("_part % _n").alias("_left")), "mix-plan")
    theirs = ["p" + k for k in [*key, "_kind"]]
    met = same([*key, "_kind"], theirs)
    each = d.join(shares.filter("_each > 0").drop("_left"), met).select(
        "_row", F.explode(F.sequence(F.lit(1), F.col("_each").cast("int"))).alias("_i"))
    # only repeated rows have something left: a table of its own, mostly empty
    rest = written(shares.filter("_left > 0").drop("_each"), "mix-left")
    one = d.join(rest, met).groupBy(*theirs).agg(F.any_value("_row").alias("_row"),
                                                 F.any_value("_left").alias("_left"))
    left = one.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_left")).alias("_i"))
    return each.select("_row").union(left.select("_row")).select("_row.*")
