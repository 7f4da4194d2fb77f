"""Ranked lexical search by pipelined term partitioning.

Documents are read once, in blocks of ``BLOCK`` rows.  Of every block each term of
the items has one posting list: the places of its documents in the block, the
term's count in each and each document's length.  A bitmap of the items' terms, of fixed
size, keeps foreign terms out; it may let strangers through but loses none, and
the join on the term decides.

Terms are dealt to owners by the share of the documents that hold them
(``OWNERS``), rare terms first.  Items come in bundles of ``BUNDLE``.  A bundle
passes the owners one after another: at each, a cogroup of the bundle's
accumulators (item, document, score) with the owner's posting lists for the same
block adds the terms' integer contributions.  What a bundle holds in one task is
bounded by ``BLOCK`` x ``BUNDLE``.  After an owner an item's accumulators are dropped that
cannot reach the ten best of their block any more: score and the most that the later
owners can add (a term adds less than ``MOST`` times its weight) stay below
the tenth best score so far.  That changes no result.  Of the last owner's accumulators
each block gives every item's ten best, and Spark ranks those.

Defined cases: null and empty texts have no terms; an item without terms, or
whose terms no document holds, has no rows; items that repeat id and text are one
item, equal ids of different texts are items of their own; every row of the
documents is a document, also where it repeats another; equal scores rank by
ascending id, null last; empty tables give an empty result.  Only the id and text
columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm.common import ascii_lower, written
from keyfold.session import pickle_by_value

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Results of an item.
TOP = 10
#: Rows of a block and items of a bundle, at most.
BLOCK, BUNDLE = 4096, 256
#: Largest share of the documents for the owners but the last.
OWNERS = (0.02, 0.1, 0.3)
#: Bits of the term bitmap (1 MB): fixed, whatever the items.
BITMAP = 1 << 23
#: A term of weight w adds less than w * MOST to a score.
MOST = 1_000_000
#: Terms whose bit a task remembers.
KNOWN = 1 << 18
_FIND = re.compile(TERM)
_UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text: Column) -> Column:
    """All terms of a text, in order."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def counted(text: str | None) -> tuple[int, dict[str, int]]:
    """Number of terms of a text, and the count of each."""
    raw = Counter(_FIND.findall(text or ""))
    out: dict[str, int] = {}
    for t, n in raw.items():
        t = t.lower() if t.isascii() else t.translate(_UPPER)
        out[t] = out.get(t, 0) + n
    return sum(raw.values()), out


def bundles(items: DataFrame, item_id="item_id", text="text") -> DataFrame:
    """One row per item and term: bundle, item (its place in the bundle), id, term."""
    of = items.select(F.col(item_id).alias("id"), F.col(text).cast("string").alias("text")).distinct()
    of = written(of, "search-items")
    n = of.count()  # items that are many come in many bundles
    of = written(of.repartition(max(1, -(-n // (BUNDLE * 7 // 8))))
                 .withColumn("at", F.monotonically_increasing_id()), "search-bundles")
    return of.select(F.expr(f"at div {BUNDLE}").alias("bundle"),
                     F.expr(f"cast(at % {BUNDLE} as int)").alias("item"), "id",
                     F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))


def _bitmap(wanted: DataFrame):
    """The bits of all wanted terms, broadcast: BITMAP / 8 rows at most reach the driver."""
    bit = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(BITMAP))
    one = F.call_function("shiftleft", F.lit(1), F.pmod(bit, F.lit(8)).cast("int"))
    rows = wanted.groupBy(F.floor(bit / 8).cast("int").alias("byte")) \
        .agg(F.bit_or(one).alias("bits")).toPandas()
    bits = np.zeros(BITMAP // 8, dtype="u1")
    bits[rows["byte"].to_numpy(dtype="i8")] = rows["bits"].to_numpy(dtype="i8")
    return wanted.sparkSession.sparkContext.broadcast(bits.tobytes())


def postings(docs: DataFrame, wanted: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Posting lists by block and term, and per block one row without a term
    that holds the ids (in ascending order, null last) and lengths of its documents."""
    from pyspark.sql.pandas.types import to_arrow_type

    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    id_type = docs.schema["id"].dataType
    sent = _bitmap(wanted)
    names = ["block", "term", "held", "docs", "counts", "lengths", "ids"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()),
             pa.list_(pa.int64()), pa.list_(to_arrow_type(id_type))]

    def segment(block: int, ids: list, lengths: list[int], found: list[dict]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], i))
        lists: dict[str, list[tuple[int, int]]] = {}
        for place, i in enumerate(order):
            for t, n in found[i].items():
                lists.setdefault(t, []).append((place, n))
        own = np.array(lengths, dtype="i8")[order]
        at = [np.array(x, dtype="i4").reshape(-1, 2) for x in lists.values()]
        return pa.RecordBatch.from_arrays([
            pa.array([block] * (len(at) + 1), kinds[0]), pa.array([None, *lists], kinds[1]),
            pa.array([len(ids), *map(len, at)], kinds[2]),
            pa.array([None, *[x[:, 0] for x in at]], kinds[3]),
            pa.array([None, *[x[:, 1] for x in at]], kinds[4]),
            pa.array([own, *[own[x[:, 0]] for x in at]], kinds[5]),
            pa.array([[ids[i] for i in order], *[None] * len(at)], kinds[6])], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = sent.value, {}
        block = TaskContext.get().partitionId() << 33
        ids, lengths, found = [], [], []
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                n, own = counted(t.as_py())
                kept = {}
                for term, count in own.items():
                    held = known.get(term)
                    if held is None:
                        if len(known) >= KNOWN:
                            known.clear()
                        at = zlib.crc32(term.encode("utf-8")) & (BITMAP - 1)
                        held = known[term] = bool(bits[at >> 3] >> (at & 7) & 1)
                    if held:
                        kept[term] = count
                ids.append(i)
                lengths.append(n)
                found.append(kept)
                if len(ids) == BLOCK:
                    yield segment(block, ids, lengths, found)
                    block, ids, lengths, found = block + 1, [], [], []
        if ids:
            yield segment(block, ids, lengths, found)

    return docs.mapInArrow(read, T.StructType([
        T.StructField("block", T.LongType()), T.StructField("term", T.StringType()),
        T.StructField("held", T.LongType()), T.StructField("docs", T.ArrayType(T.IntegerType())),
        T.StructField("counts", T.ArrayType(T.IntegerType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("ids", T.ArrayType(id_type))]))


def owned(lists: DataFrame, of: DataFrame) -> tuple[DataFrame, int, int]:
    """The items' terms as (bundle, term) with weight, owner and the items that
    hold the term, each with the most that later owners can add to it; and the
    number of documents with a term and of all their terms."""
    total = lists.filter("term is null").select(F.explode("lengths").alias("n")).filter("n > 0") \
        .agg(F.count(F.lit(1)), F.sum("n")).first()
    docs, length = total[0], int(total[1] or 0)
    df = lists.filter("term is not null").groupBy("term").agg(F.sum("held").alias("df"))
    owner = F.lit(len(OWNERS))
    for i in range(len(OWNERS) - 1, -1, -1):
        owner = F.when(F.col("df") <= OWNERS[i] * docs, i).otherwise(owner)
    weight = F.floor(F.lit(1000.0) * F.log((2 * F.lit(docs) + 2).cast("double")
                                           / (2 * F.col("df") + 1)))
    known = written(of.join(df, "term").select("bundle", "item", "term", weight.alias("weight"),
                                               owner.alias("owner")), "search-terms")
    # an item's later weights: one row per item and owner
    sums = known.groupBy("bundle", "item", "owner").agg(F.sum("weight").alias("own"))
    later = Window.partitionBy("bundle", "item").orderBy(F.col("owner").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("bundle", "item", "owner", (F.coalesce(F.sum("own").over(later), F.lit(0))
                                                   * MOST).alias("rest"))
    per = known.join(sums, ["bundle", "item", "owner"]).groupBy("bundle", "term").agg(
        F.first("weight").alias("weight"), F.first("owner").alias("owner"),
        F.sort_array(F.collect_list(F.struct("item", "rest"))).alias("of"))  # BUNDLE at most
    return written(per, "search-owners"), docs, length


_HELD = "items array<int>, docs array<int>, scores array<long>"
_BUNDLE = f"block long, bundle long, {_HELD}"


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column as longs, and where each row's begin and end."""
    if not table.num_rows:
        return np.zeros(0, "i8"), np.zeros(1, "i8")
    column = table.column(name).combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    cut = column.offsets.to_numpy().astype("i8")
    return column.flatten().to_numpy().astype("i8"), cut - cut[0]


def add(held: pa.Table, lists: pa.Table, docs: int, length: int, top: int, last: bool
        ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bundle's accumulators (item, document, score) after one owner."""
    item, doc, score = (_lists(held, c)[0] for c in ("items", "docs", "scores"))
    places, cut = _lists(lists, "docs")
    tf, n = _lists(lists, "counts")[0], _lists(lists, "lengths")[0]
    weight = lists.column("weight").to_pylist()
    of = lists.column("of").to_pylist()  # BUNDLE at most, each
    many = max([int(item.max(initial=-1)), *[x[-1]["item"] for x in of]]) + 1
    size = max(int(doc.max(initial=-1)), int(places.max(initial=-1))) + 1
    grid = np.zeros((many, size), dtype="i8")
    rest = np.zeros(many, dtype="i8")
    seen = np.zeros(many, dtype=bool)
    grid[item, doc] = score
    # 90 * n * docs may pass 64 bits where a corpus is very large
    m = 10 + (90 * n * docs // length if docs < 1 << 24 and n.max(initial=0) < 1 << 32 else
              np.array([90 * x * docs // length for x in n.tolist()], dtype="i8"))
    share = 1_000_000_000 * tf // (1000 * tf + 8 * m)
    for k, w in enumerate(weight):
        own = slice(cut[k], cut[k + 1])
        at, more = places[own], w * share[own]
        for o in of[k]:
            grid[o["item"], at] += more
            rest[o["item"]], seen[o["item"]] = o["rest"], True
    out = [(item[:0], doc[:0], score[:0])]
    for i in range(many):
        at = np.flatnonzero(grid[i])
        own = grid[i, at]
        if len(at) > top:
            least = np.partition(own, len(own) - top)[len(own) - top]
            if last:  # of those at the tenth best score, the first ids
                keep = np.lexsort((at, -own))[:top]
            else:  # an item without terms here has met its bound before
                keep = np.flatnonzero(own + rest[i] >= least) if seen[i] else np.arange(len(at))
            at, own = at[keep], own[keep]
        out.append((np.full(len(at), i), at, own))
    return tuple(np.concatenate(x) for x in zip(*out))


def _pass(docs: int, length: int, top: int, last: bool):
    """The cogroup of one owner: a bundle's row before it and after it."""
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        item, doc, score = add(left, right, docs, length, top, last)
        key = left if left.num_rows else right
        return pa.table({
            "block": key.column("block").slice(0, 1), "bundle": key.column("bundle").slice(0, 1),
            "items": pa.array([item], pa.list_(pa.int32())),
            "docs": pa.array([doc], pa.list_(pa.int32())),
            "scores": pa.array([score], pa.list_(pa.int64()))})
    return step


def rank(docs: DataFrame, items: DataFrame, doc_id="doc_id", text="text", item_id="item_id",
         item_text="text", top: int = TOP) -> DataFrame:
    """The ``top`` best documents of every item: item, rank, document and score."""
    of = bundles(items, item_id, item_text)
    lists = written(postings(docs, of, doc_id, text), "search-postings")
    owners, n_docs, length = owned(lists, of)
    spark = docs.sparkSession
    held = spark.createDataFrame([], _BUNDLE)
    n = len(OWNERS) + 1
    for stage in range(n):
        here = owners.filter(F.col("owner") == stage).select("bundle", "term", "weight", "of")
        right = lists.filter("term is not null").join(here, "term").select(
            "block", "bundle", "docs", "counts", "lengths", "weight", "of")
        held = held.groupBy("block", "bundle").cogroup(right.groupBy("block", "bundle")) \
            .applyInArrow(_pass(n_docs, length, top, stage == n - 1), _BUNDLE)
    best = held.select("block", "bundle", F.explode(F.arrays_zip("items", "docs", "scores"))
                       .alias("x")).filter("x.scores > 0")
    best = written(best.select("block", "bundle", F.col("x.items").alias("item"),
                               F.col("x.docs").alias("place"), F.col("x.scores").alias("score")),
                   "search-best")
    ids = lists.filter("term is null").select("block", "ids")
    named = best.join(ids, "block").select("bundle", "item", "score",
                                           F.get("ids", "place").alias("doc"))
    by = Window.partitionBy("bundle", "item").orderBy(F.col("score").desc(),
                                                      F.col("doc").asc_nulls_last())
    ranked = named.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    item_ids = of.select(F.col("bundle").alias("_b"), F.col("item").alias("_i"),
                         F.col("id").alias("_id")).distinct()
    return ranked.join(item_ids, (F.col("bundle") == F.col("_b")) & (F.col("item") == F.col("_i"))) \
        .select(F.col("_id").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


pickle_by_value(__name__)
