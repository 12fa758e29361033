"""Links against brute force, and recall of the index."""

import numpy as np
import pytest

from orderloom.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    good = [
        (k, np.array(v, np.float64))
        for k, v, *_ in rows
        if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, root = {}, {k: k for k, *_ in rows if k is not None}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(good):
        for b, y in good[i + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (links.get(k, 0), find(k)) for k in root}


def found(df, **how):
    return {r.id: (r.n_links, r.component) for r in pivots.near_duplicates(df, **how).collect()}


def clustered(rng, n, size=16, noise=0.1):
    centres = rng.normal(size=(n // 12 + 1, size))
    rows = centres[rng.integers(0, len(centres), n)] + noise * rng.normal(size=(n, size))
    rows[rng.random(n) < 0.2] = rows[0]
    return np.float32(rows * rng.uniform(0.1, 9, (n, 1)))


@pytest.mark.parametrize("block, most", [(7, 20), (7, 2), (2048, 8192), (2048, 2)])
def test_against_brute_force(spark, monkeypatch, block, most):
    """Lists of common pivots and common lists are taken apart, and nothing is counted twice or lost."""
    monkeypatch.setattr(pivots, "BLOCK_VECTORS", block)
    monkeypatch.setattr(pivots, "PIVOT_VECTORS", most)
    monkeypatch.setattr(pivots, "TASK_VECTORS", 300)
    rows = [(3 * k, list(map(float, v)), 1) for k, v in enumerate(clustered(np.random.default_rng(1), 240))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df) == brute(rows, 0.9)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1), (8, [], 1), (9, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0], 2),
        (11, [-1.0, 0.0], None), (12, [1e-30, 1e-31], 1), (13, [0.9, 0.43], 1), (14, [-0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(df)
    assert got.pop(None) == (0, None) and got == brute(rows, 0.9)
    assert pivots.near_duplicates(df.limit(0)).count() == 0
    assert found(df.where("vec_id = 1")) == {1: (0, 1)}
    twice = pivots.near_duplicates(df.where("vec_id in (1, 11)").union(df.where("vec_id = 1"))).collect()
    assert sorted((r.id, r.n_links) for r in twice) == [(1, 1), (1, 1), (11, 0)]


def test_recall(spark):
    """On given vectors all links, and at least nine of ten links near the threshold."""
    given = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert found(spark.createDataFrame(given, SCHEMA)) == brute(given, 0.9)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.normal(size=base.shape)
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    angle = np.arccos(rng.uniform(0.9, 0.95, (len(base), 1)))
    both = np.concatenate([base, np.cos(angle) * base + np.sin(angle) * other])
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(both)], "vec_id long, embedding array<double>, label int")
    links = sum(n for n, _ in found(df).values()) / 2
    exact = (np.triu(both @ both.T, 1) >= 0.9).sum()
    assert links <= exact and links >= 0.9 * exact, links / exact


def test_recall_at_most_pivots(spark, monkeypatch):
    """Links at the threshold are found with as many pivots as there can be."""
    rng = np.random.default_rng(9)
    known = pivots.unit_rows(rng.normal(size=(pivots.MOST_PIVOTS, 64)))
    monkeypatch.setattr(pivots, "choose_pivots", lambda classes: {64: known})
    base = pivots.unit_rows(rng.normal(size=(1500, 64)))
    other = rng.normal(size=base.shape)
    other = pivots.unit_rows(other - (other * base).sum(1, keepdims=True) * base)
    angle = np.arccos(rng.uniform(0.9, 0.91, (len(base), 1)))
    both = np.concatenate([base, np.cos(angle) * base + np.sin(angle) * other])
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(both)], "vec_id long, embedding array<double>, label int")
    links = sum(n for n, _ in found(df).values()) / 2
    exact = (np.triu(both @ both.T, 1) >= 0.9).sum()
    assert links <= exact and links >= 0.97 * exact, links / exact
