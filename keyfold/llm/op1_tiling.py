"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are read as lower-case words (see ``tokens``).  Every run of ``seed`` words is a seed, known by a 64-bit hash.  A small
bitmap of the benchmark's seeds, of fixed size, lets documents drop their other
seeds before anything is shuffled; it may let strangers through but loses none,
and the join on the seed decides.  For each document and item that share seeds
the words of the item those seeds could cover bound its coverage from above;
pairs that can reach ``threshold`` are tiled: the longest matches are marked
first, found by running Karp-Rabin hashes over the seeds of both sides, each
word at most once on either side, so passages in another order count in full.
A document leaks an item when tiles cover at least ``threshold`` of its words.

Nothing is collected but the bitmap.  A document's part in a pair is its shared
seeds only, never the product of repeated seeds.

Defined cases: null or empty text shares nothing; an item shorter than a seed is
too short to tell from ordinary text within a line and never leaks, or, with
``short``, where it is a whole line or text; repeated rows and items are
reported once per pair of ids; rows without an id, or of one id with different texts,
are documents of their own; empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import written
from keyfold.session import pickle_by_value

SEED_WORDS = 5
THRESHOLD = 0.8
#: Bits of the seed bitmap (1 MB): fixed, whatever the benchmark's size.
BITMAP = 1 << 23
#: Bytes hashed at a time, about.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_MIX, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_IN_WORD = np.array([chr(c).isalnum() or c > 127 for c in range(256)], dtype="i1")
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, n of them at least."""
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, 1024), base, dtype="u8")
        p[0] = 1
        _powers[base] = np.cumprod(p, dtype="u8")
    return _powers[base]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def running(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of values[start:end], all from one running sum."""
    n = len(values)
    total = np.zeros(n + 1, dtype="u8")
    np.cumsum(values * powers(BASE, n)[:n], dtype="u8", out=total[1:])
    return (total[ends] - total[starts]) * powers(INVERSE, n)[starts]


def _cut(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's bytes, in lower case, and the starts and ends of its words."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype="u1")
    edge = np.flatnonzero(np.diff(_IN_WORD[raw], prepend=0, append=0))
    return raw, edge[::2], edge[1::2]


def _hashed(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + PIECE)))
        piece = raw[low:ends[to - 1]].astype("u8") + np.uint64(1)
        out.append(mixed(running(piece, starts[at:to] - low, ends[at:to] - low)))
        at = to
    return np.concatenate(out) if out else np.zeros(0, dtype="u8")


def tokens(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words: runs of letters and digits, lower case
    (any character beyond ASCII counts as a letter)."""
    return _hashed(*_cut(text))


def short_runs(text: str | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the lines of fewer than ``k`` words, and of the
    whole text if it has so few."""
    raw, starts, ends = _cut(text)
    w = _hashed(raw, starts, ends)
    line = np.searchsorted(np.flatnonzero(raw == 10), starts)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    last = np.append(first[1:], len(w))
    if 0 < len(w) < k:
        first, last = np.append(first, 0), np.append(last, len(w))
    short = last - first < k
    first, last = first[short], last[short]
    return first, mixed(running(w, first, last))


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of each window of ``length`` values."""
    at = np.arange(max(0, len(values) - length + 1))
    return running(values, at, at + length)


def seeds(words: np.ndarray, k: int) -> np.ndarray:
    return mixed(windows(words, k))


def tile(item: np.ndarray, at: np.ndarray, found: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in document, words), longest first.

    ``item`` are all seeds of the item, ``found`` the document's seeds it
    shares, at the places ``at`` (ascending).  A match of s words is a run of
    s - k + 1 equal seeds.  Lengths fall by halves from the longest possible;
    within a pass the matches of a length or more are found by Karp-Rabin
    hashes, checked, extended, and marked from the longest down.
    """
    n = len(item)
    # the document's runs of neighbouring places; a match never leaves its run
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    runs = list(zip(np.split(at, cut), np.split(found, cut)))
    free_i = np.ones(n + k - 1, dtype=bool)  # by word
    free_d = {p: True for a, _ in runs for p in range(int(a[0]), int(a[-1]) + k)}
    seed_at = dict(zip(at.tolist(), found.tolist()))
    plain = item.tolist()
    tiles = []
    length = max((min(n, len(a)) for a, _ in runs), default=0)  # in seeds
    while length >= 1 and free_i.any():
        span = length + k - 1
        index = defaultdict(list)
        for i, h in enumerate(windows(item, length).tolist()):
            if free_i[i:i + span].all():
                index[h].append(i)
        matches = []
        for a, s in runs if index else ():
            for j, h in enumerate(windows(s, length).tolist()):
                d = int(a[j])
                if h not in index or not all(free_d[p] for p in range(d, d + span)):
                    continue
                for i in index[h]:
                    if not np.array_equal(item[i:i + length], s[j:j + length]):
                        continue
                    more = length
                    while (i + more < n and seed_at.get(d + more) == plain[i + more]
                           and free_i[i + more + k - 1] and free_d[d + more + k - 1]):
                        more += 1
                    matches.append((-more, i, d))
        matches.sort()
        for more, i, d in matches:
            size = k - 1 - more
            both = [bool(free_i[i + x]) and free_d[d + x] for x in range(size)]
            if all(both):
                free_i[i:i + size] = False
                for p in range(d, d + size):
                    free_d[p] = False
                tiles.append((i, d, size))
            elif max((len(list(g)) for free, g in groupby(both) if free), default=0) >= span:
                break  # part of an occluded match is left and may come before the next
        else:
            length //= 2
    return tiles


def _key(doc_id: str, text: str) -> Column:
    """A row's key: a hash of id and text, never null, so rows without an id, or
    of one id with different texts, stay apart."""
    return F.xxhash64(F.col(doc_id), F.col(text).cast("string"))


def leaks(docs: DataFrame, items: DataFrame, doc_id="doc_id", item_id="item_id", text="text",
          item_text="text", **kw) -> DataFrame:
    """doc_id, item_id, words (of the item), covered, coverage and tiles
    (array of item place, document place, words) of every leaked pair."""
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"),
                    _key(doc_id, text).alias("key"))
    found = written(_leaks(d, items, item_id, item_text, **kw), "tiling-pairs")
    # the ids of the rows that leak, back on their keys
    ids = d.select("key", "id").join(found.select("key").distinct(), "key", "left_semi").distinct()
    return found.join(ids, "key").select(F.col("id").alias(doc_id), F.col("item").alias(item_id),
                                         "words", "covered", "coverage", "tiles")


def _bitmap(used: DataFrame):
    """The broadcast bitmap of the column ``seed``."""
    # by bytes: BITMAP / 8 rows at most
    bit = F.pmod(F.col("seed"), F.lit(BITMAP))
    one = F.call_function("shiftleft", F.lit(1), F.pmod(bit, F.lit(8)).cast("int"))
    rows = used.groupBy(F.floor(bit / 8).cast("int").alias("byte")) \
        .agg(F.bit_or(one).alias("bits")).toPandas()
    bitmap = np.zeros(BITMAP // 8, dtype="u1")
    bitmap[rows["byte"].to_numpy(dtype="i8")] = rows["bits"].to_numpy(dtype="i8")
    return used.sparkSession.sparkContext.broadcast(bitmap)


def _held(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Where the bitmap holds a hash."""
    low = (h & np.uint64(BITMAP - 1)).astype("i8")
    return np.flatnonzero(bits[low >> 3] >> (low & 7).astype("u1") & 1)


def _short_leaks(docs: DataFrame, items: DataFrame, item_id: str, item_text: str,
                 k: int) -> DataFrame | None:
    """The pairs of rows (key, text) and items shorter than a seed that are a
    whole line or text of theirs; None if no item is so short."""
    import pyspark.sql.pandas.types as types

    it_type = items.schema[item_id].dataType
    arrow = types.to_arrow_type(it_type)

    def item_rows(batches):
        for b in batches:
            rows = [(i, len(w), running(w, np.array([0]), np.array([len(w)])))
                    for i, w in zip(b.column(0).to_pylist(), map(tokens, b.column(1).to_pylist()))
                    if 0 < len(w) < k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], arrow), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([int(mixed(r[2]).view("i8")[0]) for r in rows], pa.int64())],
                names=["item", "words", "seed"])

    bench = written(items.select(F.col(item_id), F.col(item_text).cast("string")).mapInArrow(
        item_rows, f"item {it_type.simpleString()}, words int, seed bigint").distinct(),
        "tiling-short")
    if not bench.limit(1).count():
        return None
    shared = _bitmap(bench.select("seed").distinct())

    def hits(batches):
        for b in batches:
            who, place, hashes = [], [], []
            for row, text in enumerate(b.column(1)):
                first, h = short_runs(text.as_py(), k)
                at = _held(h, shared.value)
                who.append(np.full(len(at), row))
                place.append(first[at])
                hashes.append(h[at])
            if who:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.concatenate(who))),
                     pa.array(np.concatenate(place).astype("i4")),
                     pa.array(np.concatenate(hashes).view("i8"))],
                    names=["key", "place", "seed"])

    met = docs.select("key", "text").mapInArrow(hits, "key bigint, place int, seed bigint") \
        .groupBy("key", "seed").agg(F.min("place").alias("place")).join(bench, "seed")
    tile_ = F.struct(F.lit(0).alias("item_at"), F.col("place").alias("doc_at"), "words")
    return met.select("key", "item", "words", F.col("words").alias("covered"),
                      F.lit(1.0).alias("coverage"), F.array(tile_).alias("tiles"))


def _leaks(docs: DataFrame, items: DataFrame, item_id: str, item_text: str,
           k: int = SEED_WORDS, threshold: float = THRESHOLD, short: bool = False) -> DataFrame:
    """The leaked pairs by ``key`` and item of rows (key, text), the key a bigint."""
    found = _tiled(docs, items, item_id, item_text, k, threshold)
    more = _short_leaks(docs, items, item_id, item_text, k) if short else None
    return found if more is None else found.unionByName(more)


def _tiled(docs: DataFrame, items: DataFrame, item_id: str, item_text: str,
           k: int, threshold: float) -> DataFrame:
    """The leaked pairs of items of a seed or more."""
    import pyspark.sql.pandas.types as types

    it_type = items.schema[item_id].dataType
    arrow = types.to_arrow_type(it_type)

    def item_rows(batches):
        for b in batches:
            rows = [(i, len(w), seeds(w, k).view("i8")) for i, w in zip(
                b.column(0).to_pylist(), map(tokens, b.column(1).to_pylist())) if len(w) >= k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], arrow),
                 pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
                names=["item", "words", "seeds"])

    bench = items.select(F.col(item_id), F.col(item_text).cast("string")).mapInArrow(
        item_rows, f"item {it_type.simpleString()}, words int, seeds array<bigint>")
    bench = written(bench.distinct(), "tiling-items")
    # from a table, so that a seed that very many documents hold may split over tasks
    used = written(bench.select(F.explode("seeds").alias("seed")).distinct(), "tiling-seeds")
    shared = _bitmap(used)

    def hits(batches):
        bits = shared.value
        for b in batches:
            who, place, hashes = [], [], []
            for row, text in enumerate(b.column(1)):
                h = seeds(tokens(text.as_py()), k)
                at = _held(h, bits)
                who.append(np.full(len(at), row))
                place.append(at)
                hashes.append(h[at])
            if who:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.concatenate(who))),
                     pa.array(np.concatenate(place).astype("i4")),
                     pa.array(np.concatenate(hashes).view("i8"))],
                    names=["doc", "place", "seed"])

    d = docs.select("key", "text").mapInArrow(hits, "doc bigint, place int, seed bigint")
    hit = written(d.join(used, "seed", "left_semi").distinct(), "tiling-hits")
    version = F.xxhash64("seeds").alias("version")  # items may repeat an id with another text
    by_seed = bench.select("item", "words", version, F.posexplode("seeds").alias("p", "seed")) \
        .groupBy("item", "words", "version", "seed").agg(F.collect_list("p").alias("places"))
    # what the shared seeds could cover: places of the item, widened by k words
    met = hit.join(by_seed, "seed")
    pair = ["doc", "item", "version"]
    could = met.select(*pair, "words", F.explode("places").alias("p")).distinct() \
        .groupBy(*pair, "words").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    gained = F.aggregate(F.transform("ps", lambda p, i: F.least(
        F.lit(k), F.coalesce(F.get("ps", i + 1) - p, F.lit(k)))), F.lit(0), lambda a, x: a + x)
    could = could.filter(gained >= threshold * F.col("words")).select(
        F.col("doc").alias("d"), F.col("item").alias("i"), F.col("version").alias("v"))
    same = (F.col("doc").eqNullSafe(F.col("d")) & F.col("item").eqNullSafe(F.col("i"))
            & (F.col("version") == F.col("v")))
    pairs = met.join(could, same, "left_semi").groupBy(*pair, "words").agg(
        F.sort_array(F.collect_list(F.struct("place", "seed"))).alias("found"))
    pairs = pairs.join(bench.select(F.col("item").alias("i"), F.xxhash64("seeds").alias("v"),
                                    "seeds"),
                       F.col("item").eqNullSafe(F.col("i")) & (F.col("version") == F.col("v")))
    pairs = pairs.select("doc", "item", "words", "seeds", F.col("found.place").alias("at"),
                         F.col("found.seed").alias("found"))

    @F.pandas_udf("array<struct<item_at:int,doc_at:int,words:int>>")
    def tiles(item: pd.Series, at: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([
            [{"item_at": int(i), "doc_at": int(j), "words": int(n)} for i, j, n in
             tile(np.asarray(a, dtype="i8").view("u8"), np.asarray(p),
                  np.asarray(f, dtype="i8").view("u8"), k)]
            for a, p, f in zip(item, at, found)])

    tiles = tiles.asNondeterministic()  # run once, not once more for the filter
    out = pairs.withColumn("tiles", tiles("seeds", "at", "found"))
    covered = F.aggregate("tiles", F.lit(0), lambda a, t: a + t["words"])
    out = out.select("doc", "item", "words", covered.alias("covered"), "tiles") \
        .filter(F.col("covered") >= threshold * F.col("words"))
    return out.select(F.col("doc").alias("key"), "item", "words", "covered",
                      (F.col("covered") / F.col("words")).alias("coverage"), "tiles")


def drop_leaks(docs: DataFrame, items: DataFrame, doc_id="doc_id", text="text",
               item_id="item_id", item_text="text", **kw) -> DataFrame:
    """The documents that leak no item, columns as given.  Rows are known by a
    hash of id and text, so an id that repeats with another text is judged anew."""
    key = _key(doc_id, text)
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"))
    found = _leaks(docs.select(key.alias("key"), F.col(text).cast("string").alias("text")), items,
                   item_id, item_text, **kw).select(F.col("key").alias("_key")).distinct()
    found = written(found, "tiling-found")
    return keyed.join(found, "_key", "left_anti").select("_row.*")


pickle_by_value(__name__)
