"""Centroid clustering in whole numbers; Ptolemy's inequality spares distances to far centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import materialise

# A component is the floor of so many times its value.
SCALE = 256
# Components up to this size have squared distances that 64 bits hold.
LARGEST = 1 << 27
# Vectors that a task looks at in one go.
CHUNK = 2048
# Cached distances have 24 significant bits; what a bound computed from them may be off by, relative to its terms.
SLACK = 2.0**-20


def whole_numbers(vector: Column) -> Column:
    """The components in whole numbers; null where one of them is above ``LARGEST``."""
    small = F.forall(vector, lambda x: F.abs(x.cast("double")) <= LARGEST / SCALE)
    return F.when(small, F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("int")))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of whole numbers."""
    apart = a.astype(np.int64) - b
    return np.einsum("...d,...d->...", apart, apart)


class Pivots:
    """Fixed pivots, one for each centroid, each paired with the pivot farthest from it and the one nearest."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.between = self.distances(rows)
        apart = np.where(self.between > 0, self.between, np.nan)
        some = ~np.isnan(apart).all(1) if len(rows) else np.zeros(0, bool)
        self.own = np.flatnonzero(some)
        self.partners = [choose(apart[self.own], 1) for choose in (np.nanargmax, np.nanargmin)] if some.any() else []

    def distances(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.rows):
            return np.zeros((len(rows), 0))
        return np.sqrt(np.stack([squared(rows, pivot) for pivot in self.rows], 1).astype(float))

    def lower_bounds(self, vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """What the distance of each vector to each centroid is at least, from their distances to the pivots.

        For points x, c and pivots p, s: |x c| |p s| >= ||x p| |c s| - |x s| |c p||. Rounded down. The
        k-th centroid is bounded by the pairs of the k-th pivot, where it began.
        """
        bound = np.zeros((len(vectors), len(centroids)))
        p = self.own
        for s in self.partners:
            one = vectors[:, p] * centroids[p, s]
            other = vectors[:, s] * centroids[p, p]
            low = (np.abs(one - other) - SLACK * (one + other)) / self.between[p, s]
            bound[:, p] = np.maximum(bound[:, p], low)
        return bound * (1 - SLACK)


def nearest(
    rows: np.ndarray, cached: np.ndarray, pivots: Pivots, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of the nearest centroid (ties: the smaller number), and how many were checked.

    The centroid of least bound is checked first; then all whose bound does not exceed that distance.
    """
    bound = pivots.lower_bounds(cached.astype(float), pivots.distances(centroids))
    every = np.arange(len(rows))
    guess = bound.argmin(1)
    found = squared(rows, centroids[guess])
    open_ = bound <= (np.sqrt(found.astype(float)) * (1 + SLACK))[:, None]
    open_[every, guess] = False
    distance = np.full(bound.shape, np.iinfo(np.int64).max)
    distance[every, guess] = found
    largest = max(np.abs(rows).max(initial=0), np.abs(centroids).max(initial=0))
    if rows.shape[1] * (2 * int(largest)) ** 2 < 1 << 53:
        # Whole numbers below 2**53 are exact as doubles, whatever the order of the sums.
        wide, norms = rows.astype(float), squared(rows, 0)
        for c, centroid in enumerate(centroids):
            v = np.flatnonzero(open_[:, c])
            distance[v, c] = norms[v] + squared(centroid, 0) - 2 * (wide[v] @ centroid.astype(float)).astype(np.int64)
    else:
        for c, centroid in enumerate(centroids):
            v = np.flatnonzero(open_[:, c])
            distance[v, c] = squared(rows[v], centroid)
    best = distance.argmin(1)
    return best, distance[every, best], int(open_.sum()) + len(rows)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, CHUNK):
        part = batch.slice(at, CHUNK)
        n = part.num_rows
        rows = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        yield part, rows, part.column("cached").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _moved(held: DataFrame, pivots: Pivots, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means of each centroid's vectors; a centroid without vectors stays."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, rows, cached in _chunks(batch):
                best, _, _ = nearest(rows, cached, pivots, centroids)
                count += np.bincount(best, minlength=len(centroids))
                np.add.at(total, best, rows)
        some = np.flatnonzero(count)
        columns = [pa.array(some), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    parts = held.select("vector", "cached").mapInArrow(sums, "cluster long, n long, total array<long>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("at", "part"))
    # One row per centroid and component, each a sum over tasks.
    each = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("sum"))
    moved = centroids.copy()
    for r in each.collect():
        moved[r.cluster, r.at] = int(r.sum) // r.n
    return moved


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    dimension: int = 64,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each kept vector.

    Kept are vectors of ``dimension`` components, none null or non-finite. The centroids start as the
    ``k`` kept vectors with the least hashes of seed and identifier (fewer if there are fewer; among
    equal hashes the vector decides; a null identifier counts as empty text), which are the pivots as
    well. Distances to pivots are taken once and stored with the vectors. A round is one pass with
    partial sums in every task; the driver holds ``k`` centroids and nothing else.

    Repeated rows count one by one. A kept vector with a component above 2**19, whose squared distances
    64 bits do not hold, comes out with nulls and moves no centroid. A sum that 64 bits do not hold is
    null. An empty table gives no row; other columns are not used.
    """
    value = F.col(vector)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = vectors.where((F.size(value) == dimension) & F.forall(value, number))
    kept = kept.select(F.col(id_column).alias("id"), whole_numbers(value).alias("vector"))
    exact = kept.where("vector is not null")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = exact.orderBy(digest, "id", "vector").limit(k).select("vector").collect()
    centroids = np.array([r.vector for r in first], np.int64).reshape(len(first), dimension)
    pivots = Pivots(centroids)

    def to_pivots(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dimension)
            yield pa.array(list(pivots.distances(rows).astype(np.float32)), pa.list_(pa.float32()))

    cached = F.arrow_udf(to_pivots, T.ArrayType(T.FloatType()))("vector")
    held = materialise(exact.select("id", "vector", cached.alias("cached")), "vectors")
    for _ in range(rounds if first else 0):
        centroids = _moved(held, pivots, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, cached in _chunks(batch):
                best, distance, checked = nearest(rows, cached, pivots, centroids)
                share = pa.array(np.full(len(rows), checked / len(rows) / len(centroids)))
                columns = [part.column("id"), pa.array(best.astype(np.int32)), pa.array(distance), share]
                yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance", "checked_share"])

    id_type = kept.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, cluster int, distance long, checked_share double"
    assigned = materialise(held.mapInArrow(assign, schema), "assigned")
    wide = F.col("distance").cast("decimal(38,0)")
    totals = assigned.groupBy("cluster").agg(F.sum(wide).alias("part"))
    inertia = totals.agg(F.sum("part")).first()[0]
    spark = vectors.sparkSession
    digests = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # One row per centroid.
    totals = totals.join(F.broadcast(named), "cluster").select(
        "cluster",
        F.col("part").try_cast("long").alias("cluster_inertia"),
        F.lit(inertia).cast("decimal(38,0)").try_cast("long").alias("inertia"),
        "centroid_sha256",
    )
    beyond = kept.where("vector is null").select("id")
    return assigned.join(F.broadcast(totals), "cluster").unionByName(beyond, allowMissingColumns=True)
