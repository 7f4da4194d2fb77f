"""Clustering around centroids, with exact integer arithmetic.

Vectors become integer vectors, floor(scale * x) per component.  Centroids start
as the ``k`` vectors whose salted ids have the smallest SHA-256.  Each round
builds a vantage-point tree over the centroids and broadcasts it (``k`` vectors,
whatever the input); every task assigns its vectors and sums them per cluster,
Spark adds the sums up, and a centroid becomes the floor of its mean.

A search runs best first: of the nodes it may still enter, a vector takes the one
with the lowest bound by the triangle inequality, and ends when that bound
exceeds the best distance so far.  Nodes at exactly the best distance are
entered, since a tie goes to the smaller centroid number.  Distances to centroids are exact
integers; the bounds are doubles, drawn down by more than their rounding error.  All vectors of
a batch take their own next node in step, so the work per step is numpy's.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component are left out; a null id hashes like an empty one; rows
that repeat an id are vectors of their own, ordered among the seeds by their components;
with fewer than ``k`` vectors each is a seed; a component beyond ``LARGEST`` is
set to it, so that squared distances fit 64 bits; a sum of distances beyond 64 bits is null; an
empty table gives an empty result.  Only the id and the vector column are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm.common import written
from keyfold.session import pickle_by_value

COMPONENTS, CLUSTERS, ROUNDS, SCALE, SALT = 64, 16, 3, 64, "1:"
#: Largest absolute value of an integer component.
LARGEST = 1 << 26
#: Centroids of a leaf.
LEAF = 2
#: Cells (vectors x tree nodes) searched at a time.
CELLS = 1 << 20
_SLACK = 1e-9


@dataclass
class Tree:
    """A vantage-point tree; node 0 is the root.

    ``members[n]`` are the centroids looked at in node n: its vantage point, or
    all of a leaf.  ``children[n]`` are (child, nearest, farthest): the child's
    centroids lie between these distances from the vantage point.
    """

    centroids: np.ndarray
    members: list[list[int]]
    children: list[list[tuple[int, float, float]]]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def build(centroids: np.ndarray) -> Tree:
    """The tree over integer centroids (one row each)."""
    tree = Tree(centroids, [], [])

    def grow(of: list[int]) -> int:
        node = len(tree.members)
        tree.members.append(of)
        tree.children.append([])
        if len(of) <= LEAF:
            return node
        far = np.sqrt(squared(centroids[of][:, None], centroids[of][None]).astype("f8"))
        top = int(far.std(axis=1).argmax())  # the point that tells the others apart best
        order = [i for i in np.argsort(far[top], kind="stable") if i != top]
        tree.members[node] = [of[top]]
        for half in np.array_split(np.array(order), min(2, len(order))):
            reach = far[top][half]
            child = grow([of[i] for i in half])
            tree.children[node].append((child, float(reach.min()), float(reach.max())))
        return node

    if len(centroids):
        grow(list(range(len(centroids))))
    return tree


def nearest(vectors: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of every vector's nearest centroid."""
    step = max(1, CELLS // len(tree.members))
    parts = [_nearest(vectors[i:i + step], tree) for i in range(0, len(vectors), step)]
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) \
        if parts else (np.zeros(0, "i8"), np.zeros(0, "i8"))


def _nearest(x: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    who = np.full(len(x), len(tree.centroids))
    best = np.full(len(x), np.iinfo("i8").max)
    low = np.full((len(x), len(tree.members)), np.inf)  # bounds of nodes not yet entered
    low[:, 0] = 0.0
    going = np.arange(len(x))
    while len(going):
        node = low[going].argmin(axis=1)
        bound = low[going, node]
        near = bound <= np.sqrt(best[going].astype("f8")) * (1 + _SLACK)
        going, node, bound = going[near], node[near], bound[near]
        low[going, node] = np.inf
        for n in np.unique(node):
            at = node == n
            rows = going[at]
            for c in tree.members[n]:
                dist = squared(x[rows], tree.centroids[c])
                nearer = (dist < best[rows]) | (dist == best[rows]) & (c < who[rows])
                best[rows[nearer]], who[rows[nearer]] = dist[nearer], c
            for child, least, most in tree.children[n]:  # an inner node has one member
                d = np.sqrt(dist.astype("f8"))
                gap = np.maximum(d - most, least - d) - _SLACK * (d + most + 1)
                low[rows, child] = np.maximum(gap, bound[at])
    return who, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("i8").reshape(-1, width)


def integers(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
             components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """id and v (integer components) of every vector that is whole and finite."""
    x = F.col(vector).cast("array<double>")
    good = (F.size(x) == components) & F.forall(
        x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(
        e * F.lit(float(scale)), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long"))
    return df.filter(F.coalesce(good, F.lit(False))).select(F.col(vec_id).alias("id"),
                                                            whole.alias("v"))


def seeds(vectors: DataFrame, k: int = CLUSTERS, salt: str = SALT) -> np.ndarray:
    """The first centroids: ``k`` rows at most come to the driver."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype="i8")


def _broadcast(vectors: DataFrame, tree: Tree):
    # plain values: executors need not import this package
    return vectors.sparkSession.sparkContext.broadcast(
        (tree.centroids, tree.members, tree.children))


def _sums(vectors: DataFrame, tree: Tree) -> dict[int, tuple[int, list[int]]]:
    """Size and component sums of every cluster that has vectors."""
    k, width = tree.centroids.shape
    sent = _broadcast(vectors, tree)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, "i8"), np.zeros((k, width), "i8")
        for b in batches:
            x = _matrix(b.column(0), width)
            who, _ = nearest(x, Tree(*sent.value))
            n += np.bincount(who, minlength=k)
            for c in np.unique(who):
                total[c] += x[who == c].sum(axis=0)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has.astype("i4")), pa.array(n[has]),
             *[pa.array(total[has, i]) for i in range(width)]],
            names=["cluster", "n", *[f"s{i}" for i in range(width)]])

    names = [f"s{i}" for i in range(width)]
    parts = vectors.select("v").mapInArrow(
        count, "cluster int, n long, " + ", ".join(f"{c} long" for c in names))
    rows = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names]).collect()  # k at most
    sent.destroy()
    return {r["cluster"]: (r["n"], [int(r[c]) for c in names]) for r in rows}


def centroids(vectors: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds; an empty one stays where it is."""
    now = first
    for _ in range(rounds):
        after = now.copy()
        for c, (n, total) in _sums(vectors, build(now)).items():
            after[c] = [s // n for s in total]
        now = after
    return now


def assign(vectors: DataFrame, tree: Tree) -> DataFrame:
    """id, cluster and squared distance of every vector."""
    sent = _broadcast(vectors, tree)
    width = tree.centroids.shape[1]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, dist = nearest(_matrix(b.column(1), width), Tree(*sent.value))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(who.astype("i4")), pa.array(dist)],
                names=["id", "cluster", "distance"])

    return vectors.select("id", "v").mapInArrow(find, T.StructType([
        T.StructField("id", vectors.schema["id"].dataType), T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType())]))


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
            components: int = COMPONENTS, k: int = CLUSTERS, rounds: int = ROUNDS,
            scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """Every vector's id, cluster and distance, with the inertia of its cluster
    and of all, and the SHA-256 of its centroid."""
    spark = df.sparkSession
    vectors = written(integers(df, vec_id, vector, components, scale), "centroid-vectors")
    first = seeds(vectors, k, salt)
    last = centroids(vectors, first, rounds) if len(first) else np.zeros((0, components), "i8")
    found = assign(vectors, build(last)) if len(first) else \
        vectors.selectExpr("id", "cast(0 as int) cluster", "0L distance")  # no rows
    found = written(found, "centroid-distances")
    # one row per cluster: k at most
    inertia = {r["cluster"]: r["s"] for r in
               found.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}
    total = None if None in inertia.values() else sum(inertia.values())
    total = total if total is not None and total < 1 << 63 else None
    text = [",".join(map(str, c.tolist())) for c in last]
    per = spark.createDataFrame(
        [(c, s, total, hashlib.sha256(text[c].encode()).hexdigest()) for c, s in inertia.items()],
        "_c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per), F.col("cluster") == F.col("_c")).drop("_c") \
        .withColumnRenamed("id", vec_id)


pickle_by_value(__name__)
