"""Centroid clustering: the tree against plain search, the whole against plain rounds."""

import hashlib

import numpy as np
import pytest

from keyfold.llm import op13_centroids as op13


@pytest.mark.parametrize("leaf,cells", [(1, 1 << 20), (2, 64), (5, 7)])
def test_nearest_by_brute_force_with_many_ties(monkeypatch, leaf, cells):
    monkeypatch.setattr(op13, "LEAF", leaf)
    monkeypatch.setattr(op13, "CELLS", cells)
    rng = np.random.default_rng(leaf)
    for _ in range(60):
        width, k = rng.integers(1, 5), rng.integers(1, 40)
        c, x = rng.integers(-3, 4, (k, width)), rng.integers(-3, 4, (50, width))
        far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        who, dist = op13.nearest(x, op13.build(c))
        assert (dist == far.min(axis=1)).all() and (who == far.argmin(axis=1)).all()


def test_tree_of_equal_and_of_large_centroids():
    same = np.full((9, 3), 5)
    who, dist = op13.nearest(np.array([[5, 5, 5], [5, 5, 7]]), op13.build(same))
    assert who.tolist() == [0, 0] and dist.tolist() == [0, 4]
    big = np.array([[op13.LARGEST] * 64, [-op13.LARGEST] * 64, [op13.LARGEST] * 63 + [0]])
    who, dist = op13.nearest(big[:2], op13.build(big))
    assert who.tolist() == [0, 1] and dist.tolist() == [0, 0]
    assert op13.nearest(big[:1], op13.build(big[1:]))[1].tolist() == [op13.LARGEST ** 2]


def plain(rows, width, k, rounds):
    """Clusters, distances and centroids in Python integers."""
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        new = []
        for n, c in enumerate(cents):
            own = [v for (_, v), o in zip(kept, of) if o == n]
            new.append([sum(x) // len(own) for x in zip(*own)] if own else c)
        cents = new
    out = [(i, near(v)) for i, v in kept]
    sums = {}
    for _, (d, n) in out:
        sums[n] = sums.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, n, d, sums[n], sum(sums.values()), sha[n]) for i, (d, n) in out),
                  key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def test_clusters_by_plain_rounds_on_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-9, 9, 3) / 32]) for i in range(80)]
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, [0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5]),
             (200, None), (201, []), (202, [0.1, 0.2]), (203, [0.1, None, 0.2]), (204, [0.1, float("nan"), 0.0]),
             (205, [float("inf"), 0.0, 0.0]), (206, [0.1] * 4)] + [(300 + i, [1.0, 1.0, 1.0]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, cluster int, id string").repartition(5)
    for k, rounds in ((7, 3), (1, 1), (500, 2), (5, 0)):
        out = op13.cluster(df, components=3, k=k, rounds=rounds)
        got = sorted(map(tuple, out.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
        assert got == plain([(i, None if v is None else [None if x is None else np.float32(x) for x in v])
                             for i, v in rows], 3, k, rounds)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_empty_and_huge(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0])], "vec_id long, embedding array<double>")
    assert op13.cluster(df.limit(0), components=2).collect() == []
    out = op13.cluster(df, components=2, k=1, rounds=1).collect()
    assert {r.distance for r in out} == {op13.LARGEST ** 2} and out[0].inertia == 2 * op13.LARGEST ** 2
    far = spark.createDataFrame([(i, [(-1.0) ** i * 1e30] * 64) for i in range(64)], "vec_id long, embedding array<double>")
    assert {r.inertia for r in op13.cluster(far, k=1, rounds=1).collect()} == {None}
