"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most ``radius`` bits link.  Their 64 bits are
dealt to m groups, correlated bits together; group i gets its own threshold
t_i >= -1 (-1: not probed) with ``sum(t_i) = radius - m + 1``, so two linked
fingerprints differ in at most t_i bits of some group i.  Number of groups and
thresholds minimise, by dynamic programming, the probes and the candidates
expected from the bit statistics of all fingerprints.

The search runs on distinct values of each group: a value probes the larger
values within t_i of it, and every pair of values met stands for the
fingerprints that hold them.  Small pairs are verified on the spot.  Large
ones are dealt in blocks of bounded size; a block pair is compared in one task,
which returns a spanning star per connected part and not all its pairs.  Links
only have to be right for components, which ``components`` then finds.

Defined cases: null or empty text has fingerprint zero, which links like any
other; fewer words than a shingle give one shingle; repeated rows and ties
share a fingerprint; a component's id is its smallest id that is not null
(null if all are); an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import written
from keyfold.llm.components import components
from keyfold.session import pickle_by_value

BITS = 64
SHINGLE = 4
RADIUS = 4
#: Pairs of values that stand for at most so many pairs of fingerprints are joined.
JOINED = 64
#: Fingerprints on either side of a block pair, about.
BLOCK = 2048


def simhash(text: str | None, k: int = SHINGLE) -> int:
    """64-bit fingerprint of the XXH64 (seed 42) of all k-word shingles."""
    import xxhash

    # bytes.lower() folds A-Z only; bytes.split() parts at space and 9 to 13
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    flat, digest = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= k:
        return digest(flat, 42)
    ends = list(itertools.accumulate(len(x) + 1 for x in w))
    starts = [0, *ends[:-k]]
    ones, n = np.zeros(BITS, dtype=np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        h = np.array([digest(flat[a:b - 1], 42) for a, b in
                      zip(starts[at:at + (1 << 16)], ends[k - 1 + at:k - 1 + at + (1 << 16)])],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", k: int = SHINGLE):
    """Column of fingerprints (signed long) of ``docs[text]``."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, k) for t in texts], dtype="u8").view("i8"))
    return fp(F.col(text).cast("string"))


# --- the plan: groups of bits and their thresholds -------------------------

def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both set."""
    def gram(batches):
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(h), 1 << 14):
                x = np.ascontiguousarray(h[at:at + (1 << 14)]).view(np.uint8).reshape(-1, 8)
                x = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
                total += np.rint(x.T @ x).astype(np.int64)
                n += len(x)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1).astype("i4")), pa.array(np.append(j, -1).astype("i4")),
             pa.array(np.append(total.ravel(), n))], names=["i", "j", "n"])

    rows = (fps.select("fp").mapInArrow(gram, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())  # 4,097 rows
    both, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r["i"] < 0:
            n = r["n"]
        else:
            both[r["i"], r["j"]] = r["n"]
    return n, both


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m groups of nearly equal width, correlated ones together."""
    p = both.diagonal() / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        own = [max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())]
        free.discard(own[0])
        while len(own) < width:
            own.append(max(sorted(free), key=lambda b: corr[b, own].sum()))
            free.discard(own[-1])
        groups.append(sorted(own))
    return groups


def within(bits: list[int], p: np.ndarray, most: int) -> list[float]:
    """P(two fingerprints differ in at most t of ``bits``), t = 0 .. most."""
    dist = np.zeros(len(bits) + 1)
    dist[0] = 1
    for b in bits:
        q = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return list(np.cumsum(dist)[:most + 1])


def allocate(cost: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 that add up to ``budget`` at the least total cost.

    ``cost[i][t + 1]`` is the cost of threshold t in group i.
    """
    best = {0: (0.0, [])}
    for own in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, x in enumerate(own, start=-1):
                if s + t not in step or c + x < step[s + t][0]:
                    step[s + t] = (c + x, [*ts, t])
        best = step
    return best[budget]


def plan(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the groups that are probed."""
    p, pairs = both.diagonal() / max(n, 1), n * (n - 1) / 2
    found = []
    for m in range(1, radius + 2):
        groups = group_bits(n, both, m)
        cost = []
        for bits in groups:
            near, own = within(bits, p, radius), [0.0]
            for t in range(radius + 1):
                ball = sum(math.comb(len(bits), i) for i in range(t + 1))
                own.append(n * (1 + ball / 2) + pairs * near[min(t, len(near) - 1)])
            cost.append(own)
        c, ts = allocate(cost, radius - m + 1)
        found.append((c, m, [(b, t) for b, t in zip(groups, ts) if t >= 0]))
    return min(found, key=lambda x: x[:2])[2]


# --- probing and verification ----------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(bits: list[int], t: int) -> list[int]:
    return [_signed(sum(1 << b for b in c)) for i in range(1, t + 1)
            for c in itertools.combinations(bits, i)]


def star_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Edges (root, other) that connect what links of ``left`` to ``right``
    (None: to itself) connect."""
    same = right is None
    right = left if same else right
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    a = np.arange(len(left))
    b = a.copy() if same else len(left) + np.arange(len(right))
    last = len(left) + len(right)
    while True:  # the smallest label spreads until nothing changes
        a2 = np.minimum(a, np.where(near, b[None, :], last).min(axis=1, initial=last))
        b2 = a2 if same else np.minimum(b, np.where(near, a2[:, None], last)
                                        .min(axis=0, initial=last))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    label, value = (a, left) if same else (np.append(a, b), np.append(left, right))
    named = left if same else value
    edge = np.column_stack([named[label], value])
    return edge[edge[:, 0] != edge[:, 1]]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges a, b whose components are those of all links between ``fps``
    (distinct fingerprints, column fp)."""
    groups = plan(*bit_counts(fps), radius)
    parts = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(
        F.lit(_signed(sum(1 << b for b in bits)))).alias("value"))
        for i, (bits, _) in enumerate(groups)])
    members = fps.select("fp", F.explode(parts).alias("p")).select("p.part", "p.value", "fp")
    values = written(members.groupBy("part", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("one")), "simhash-values")

    found = values.filter("n > 1").select(
        "part", F.col("value").alias("u"), F.col("value").alias("v"), F.col("n").alias("nu"),
        F.col("n").alias("nv"), F.col("one").alias("fu"), F.col("one").alias("fv"))
    for i, (bits, t) in enumerate(groups):
        if t < 1:
            continue
        masks = F.array(*[F.lit(x) for x in _masks(bits, t)])
        own = values.filter(F.col("part") == i)
        probes = own.select(
            F.col("value").alias("u"), F.col("n").alias("nu"), F.col("one").alias("fu"),
            F.explode(F.transform(masks, lambda x: x.bitwiseXOR(F.col("value")))).alias("v")
        ).filter("v > u")
        met = probes.join(own.select(F.col("value").alias("v"), F.col("n").alias("nv"),
                                     F.col("one").alias("fv")), "v")
        found = found.union(met.select(F.lit(i).alias("part"), "u", "v", "nu", "nv", "fu", "fv"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    # pairs of single fingerprints are decided here, without a look-up
    single = (F.col("nu") == 1) & (F.col("nv") == 1)
    found = written(found.filter(~single | (F.bit_count(F.col("fu").bitwiseXOR(F.col("fv")))
                                            <= radius)), "simhash-met")
    edges = found.filter(single).select(F.col("fu").alias("a"), F.col("fv").alias("b"))

    of = members.select(F.col("part").alias("mp"), F.col("value").alias("mv"), "fp")
    small = found.filter(~single & (F.col("nu") * F.col("nv") <= JOINED))
    small = small.join(of, (F.col("part") == F.col("mp")) & (F.col("u") == F.col("mv"))) \
        .select("part", "u", "v", F.col("fp").alias("a"))
    small = small.join(of, (F.col("part") == F.col("mp")) & (F.col("v") == F.col("mv"))) \
        .select("u", "v", "a", F.col("fp").alias("b"))
    edges = edges.union(small.filter(((F.col("u") != F.col("v")) | (F.col("a") < F.col("b")))
                                     & near).select("a", "b"))

    blocks = lambda n: F.ceil(F.col(n) / BLOCK)
    block = lambda n: F.pmod(F.xxhash64("fp"), blocks(n))
    large = found.filter(~single & (F.col("nu") * F.col("nv") > JOINED)) \
        .select("part", "u", "v", "nu", "nv")
    key = ["part", "u", "v", "i", "j"]
    upto = lambda n: F.sequence(F.lit(0).cast("long"), blocks(n) - 1)
    lefts = large.join(of, (F.col("part") == F.col("mp")) & (F.col("u") == F.col("mv")))
    lefts = lefts.withColumn("i", block("nu")).withColumn("j", F.explode(upto("nv")))
    lefts = lefts.filter("u <> v or i <= j").select(*key, F.lit(0).alias("side"), "fp")
    rights = large.join(of, (F.col("part") == F.col("mp")) & (F.col("v") == F.col("mv")))
    rights = rights.withColumn("j", block("nv")).withColumn("i", F.explode(upto("nu")))
    rights = rights.filter("u <> v or i < j").select(*key, F.lit(1).alias("side"), "fp")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        h, side = pdf["fp"].to_numpy().view("u8"), pdf["side"].to_numpy()
        r = h[side == 1]
        alone = len(r) == 0 and pdf["u"].iloc[0] == pdf["v"].iloc[0] \
            and pdf["i"].iloc[0] == pdf["j"].iloc[0]
        e = star_links(h[side == 0], None if alone else r, radius).view("i8").reshape(-1, 2)
        return pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    return edges.union(lefts.union(rights).groupBy(*key).applyInPandas(link, "a long, b long"))


def groups_of(sig: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``sig`` (columns id, fp and others) with ``component``, the smallest id
    of its component, and ``root``, a fingerprint that names it."""
    fps = written(sig.groupBy("fp").agg(F.min("id").alias("least")), "simhash-fps")
    root = components(links(fps, radius))
    named = fps.join(root, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    # from a table, so that the fingerprints of a large component may split over tasks
    low = written(named.groupBy("root").agg(F.min("least").alias("component")), "simhash-least")
    return sig.join(named.join(low, "root").select("fp", "root", "component"), "fp")


def signatures(docs: DataFrame, doc_id="doc_id", text="text", k: int = SHINGLE) -> DataFrame:
    """id, fp and a row key (hash of id and text), written once."""
    return written(docs.select(F.col(doc_id).alias("id"), fingerprints(docs, text, k).alias("fp"),
                               F.xxhash64(F.col(doc_id), F.col(text)).alias("key")),
                   "simhash-signatures")


def keep_one(docs: DataFrame, doc_id="doc_id", text="text", k: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest id (null last,
    then by key); of rows that repeat it in full, one."""
    sig = groups_of(signatures(docs, doc_id, text, k), radius)
    first = sig.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("no"), "id", "key")).alias("x"))
    first = first.select(F.coalesce(F.col("x.id").cast("string"), F.lit("")).alias("_k0"),
                         F.col("x.key").alias("_k1"))
    d = docs.select(F.struct(*docs.columns).alias("_row"),
                    F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_k0"),
                    F.xxhash64(F.col(doc_id), F.col(text)).alias("_k1"))
    nth = F.row_number().over(Window.partitionBy("_k0", "_k1").orderBy("_k0"))
    return (d.withColumn("_nth", nth).filter("_nth = 1")
            .join(first, ["_k0", "_k1"], "left_semi").select("_row.*"))


pickle_by_value(__name__)
