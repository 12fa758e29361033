"""Centroid clustering against plain whole-number rounds, and the bounds against true distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from orderloom.llm import centroids


def plain(rows, dimension, k, rounds):
    """By identifier: cluster, distance, inertia of the cluster, of all, digest of the centroid."""
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v):
            kept.append((key, tuple(math.floor(256 * float(x)) for x in v)))
    rank = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or -1, r[1])
    means = [v for _, v in sorted(kept, key=rank)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))
    for _ in range(rounds):
        own = [[] for _ in means]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        means = [tuple(sum(x) // len(vs) for x in zip(*vs)) if vs else m for vs, m in zip(own, means)]
    found = [(key, *reversed(nearest(v))) for key, v in kept]
    part = {}
    for _, c, d in found:
        part[c] = part.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return [(key, c, d, part[c], sum(part.values()), digest[c]) for key, c, d in found]


def results(df, **how):
    out = centroids.cluster(df, **how)
    return [(r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out.collect()]


def grouped(n, dimension, groups, seed):
    draw = random.Random(seed)
    homes = [[draw.gauss(0, 1) for _ in range(dimension)] for _ in range(groups)]
    return [(k, [x + draw.gauss(0, 0.05) for x in homes[k % groups]]) for k in range(n)]


@pytest.mark.parametrize("dimension, k, rounds, seed", [(3, 5, 4, 1), (8, 12, 5, 2), (64, 40, 5, 3)])
def test_equals_plain_rounds(spark, dimension, k, rounds, seed):
    rows = grouped(300, dimension, 15, seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    assert sorted(results(df, dimension=dimension, k=k, rounds=rounds)) == sorted(plain(rows, dimension, k, rounds))


def test_ties_and_odd_vectors(spark):
    """Many equal distances, equal vectors, empty clusters, nulls, other lengths, fewer vectors than centroids."""
    draw = random.Random(4)
    rows = [(k, [float(draw.randrange(-1, 2)), float(draw.randrange(2))]) for k in range(60)]
    rows += [(None, [1.0, 0.5]), (100, None), (101, [1.0]), (102, [1.0, None]), (103, [float("nan"), 0.0])]
    rows += [(104, [float("inf"), 1.0]), (105, []), (7, [0.25, -0.125]), (7, [0.25, -0.125]), (106, [-0.001, 300.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    as_float = [(key, v and [x if x is None else float(np.float32(x)) for x in v]) for key, v in rows]
    for k in (1, 7, 100):
        key = lambda r: str(r)
        assert sorted(results(df, dimension=2, k=k), key=key) == sorted(plain(as_float, 2, k, 5), key=key)
    assert results(df.limit(0), dimension=2) == [] and results(df, dimension=5) == []


def test_components_beyond_64_bits(spark):
    rows = [(1, [1e30, 0.0]), (2, [1.0, 1.0]), (3, [3.0, 3.0]), (4, [524288.0, -524288.0])]
    found = {r[0]: r[1:] for r in results(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), dimension=2, k=2)}
    assert found[1] == (None,) * 5
    assert {r[0]: r[1:] for r in plain(rows[1:], 2, 2, 5)} == {k: v for k, v in found.items() if k != 1}


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_exceed_distances(seed):
    draw = np.random.default_rng(seed)
    size = int(10 ** draw.integers(1, 8))
    points, pivots = draw.integers(-size, size, (400, 6)), centroids.Pivots(draw.integers(-size, size, (9, 6)))
    points[:9] = pivots.rows
    cached = pivots.distances(points).astype(np.float32).astype(float)
    for others in (pivots.rows, points[9:18], points[100:109]):
        bound = pivots.lower_bounds(cached, pivots.distances(others))
        true = np.sqrt(((points[:, None] - others[None]).astype(float) ** 2).sum(-1))
        assert (bound <= true).all() and (bound > 0.1 * true).mean() > 0.2


def test_equal_pivots_bound_nothing():
    pivots = centroids.Pivots(np.ones((3, 4), np.int64))
    assert (pivots.lower_bounds(np.ones((2, 3)), np.ones((3, 3))) == 0).all()


def test_grouped_vectors_are_spared_most_checks():
    rows = np.floor(256 * np.array([v for _, v in grouped(2000, 64, 40, 6)])).astype(np.int64)
    pivots = centroids.Pivots(rows[:40])
    best, distance, checked = centroids.nearest(rows, pivots.distances(rows).astype(np.float32), pivots, rows[40:80])
    assert (best == np.arange(2000) % 40).all() and checked < 0.1 * 2000 * 40
    assert (distance == ((rows - rows[40 + best]) ** 2).sum(1)).all()
