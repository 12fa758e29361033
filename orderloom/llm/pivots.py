"""Near-duplicate vectors through an index of pivot permutations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.components import components
from orderloom.session import materialise

# The pivots are a sample of about the square root of the vectors, within these bounds, so that
# inverted lists grow slowly and the pivots (at most MOST_PIVOTS vectors) fit into every task.
LEAST_PIVOTS = 128
MOST_PIVOTS = 4096
# Pivots come from a sample so many times as large, and none is nearer to another than this cosine:
# pivots within one group of copies would be in another order for each of them.
SAMPLE_TIMES = 4
SPREAD = 0.6
# A vector is described by so many nearest pivots; two vectors meet if they share two of them. With
# more pivots close vectors share fewer, so each doubling of NEAREST_PIVOTS adds one.
NEAREST = 6
NEAREST_PIVOTS = 128
# Vectors of a list that one task compares at a time, of a pivot whose lists are compared in one task, and of
# small pivots in one task.
BLOCK_VECTORS = 2048
PIVOT_VECTORS = 8192
TASK_VECTORS = 20_000
# In place of the second pivot: all lists of the first one.
ANY = -9


def usable(vector: Column) -> Column:
    """True for vectors with a direction: not null, all components finite, one not zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.forall(vector, number) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good, F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one in double precision; scaled first, so that squares stay in range."""
    rows = np.asarray(vectors, np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def choose_pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit pivots by dimension, from the vectors with the lowest hashes; at most ``MOST_PIVOTS``."""
    total = classes.count()
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, int(np.ceil(np.sqrt(total)))))
    sample = classes.orderBy(F.xxhash64("class", F.lit(11)), "class").select("vector")
    by_size: dict[int, list] = {}
    for r in sample.limit(SAMPLE_TIMES * wanted).collect():
        by_size.setdefault(len(r.vector), []).append(r.vector)
    pivots = {}
    for size, held in by_size.items():
        rows = unit_rows(held)
        apart = np.zeros(rows.shape)
        count = 0
        for row in rows:
            if count < wanted and (apart[:count] @ row < SPREAD).all():
                apart[count] = row
                count += 1
        pivots[size] = apart[:count]
    return pivots


def nearest_count(known: int) -> int:
    """How many of ``known`` pivots describe a vector: 6 of 128, 11 of 4096."""
    more = int(np.ceil(np.log2(known / NEAREST_PIVOTS))) if known > NEAREST_PIVOTS else 0
    return min(NEAREST + more, known)


def nearest_pivots(vector: Column, pivots: dict[int, np.ndarray]) -> Column:
    """The numbers of the ``nearest_count`` nearest pivots of a vector's dimension, ascending.

    With fewer than two such pivots, -1 fills up: a stand-in that all vectors of the dimension share.
    """

    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch])
            out: list = [None] * len(batch)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                known = pivots.get(int(size))
                near = np.zeros((len(own), 0), int)
                if known is not None:
                    rows = unit_rows(batch.take(pa.array(own)).flatten().to_numpy().reshape(len(own), size))
                    dots = rows @ known.T
                    count = nearest_count(len(known))
                    near = np.sort(np.argpartition(-dots, count - 1, axis=1)[:, :count], axis=1)
                if near.shape[1] < 2:
                    fill = np.full((len(own), 2 - near.shape[1]), -1) - np.arange(2 - near.shape[1])[::-1]
                    near = np.concatenate([fill, near], 1)
                for k, row in zip(own.tolist(), near.tolist()):
                    out[k] = row
            yield pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(nearest, T.ArrayType(T.IntegerType()))(vector)


def _links(threshold: float):
    """Compare the inverted lists of a task: per vector its links counted here, and the first vector it reaches."""
    fields = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        size, p, q, own = (table.column(c).to_numpy() for c in ("size", "p", "q", "own"))
        order = np.lexsort((q, p, size))
        size, p, q, own = size[order], p[order], q[order], own[order]
        ids, times = (table.column(c).to_numpy()[order] for c in ("id", "times"))
        found = []
        for width in np.unique(size):
            one = np.flatnonzero(size == width)
            rows = pa.array(order[one])
            vectors = unit_rows(table.column("vector").take(rows).combine_chunks().flatten().to_numpy().reshape(len(one), width))
            near = table.column("near").take(rows).combine_chunks().flatten().to_numpy().reshape(len(one), -1)
            starts = np.flatnonzero((np.diff(p[one], prepend=-9) != 0) | (np.diff(q[one], prepend=-9) != 0))
            for a, b in zip(starts, [*starts[1:], len(one)]):
                part = slice(a, b)
                named = ids[one][part], times[one][part], own[one][part]
                if q[one[a]] > ANY:
                    lists = [(q[one[a]], np.arange(b - a))]
                else:
                    lists = _lists_of(near[part], p[one[a]])
                for other, members in lists:
                    if len(members) > 1:
                        found += _compare_list(vectors[part], near[part], *named, members, p[one[a]], other, threshold)
        columns = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=fields)

    return compare


def _lists_of(near: np.ndarray, p: int) -> Iterator[tuple[int, np.ndarray]]:
    """The lists of pivot ``p`` and each higher pivot: which rows have both."""
    row, column = np.nonzero(near > p)
    other = near[row, column]
    order = np.argsort(other, kind="stable")
    other, row = other[order], row[order]
    starts = np.flatnonzero(np.diff(other, prepend=-9))
    for a, b in zip(starts, [*starts[1:], len(other)]):
        yield other[a], row[a:b]


def _compare_list(vectors, near, ids, times, own, members, p, q, threshold) -> list[np.ndarray]:
    """Links among the ``members``; in a list of two blocks only those from one block to the other."""
    rows = vectors[members]
    close = rows @ rows.T >= threshold
    np.fill_diagonal(close, False)
    block = own[members]
    if block[0] >= 0:
        close &= block[:, None] != block[None]
    if not close.any():
        return []
    # Of all lists two vectors meet in, the one of their two lowest shared pivots counts them.
    hit = np.flatnonzero(close.any(1))
    members, close = members[hit], close[np.ix_(hit, hit)]
    held = near[members]
    lower = np.unique(held[(held < q) & (held != p)])
    has = np.zeros((len(members), len(lower)), np.float32)
    for column in held.T:
        there = np.flatnonzero(np.isin(column, lower))
        has[there, np.searchsorted(lower, column[there])] = 1
    counted = close & (has @ has.T == 0)
    links = counted @ times[members]
    label = _reached(counted)
    some = np.flatnonzero(links)
    return [np.stack([ids[members][some], links[some], ids[members][label[some]]])]


def _reached(close: np.ndarray) -> np.ndarray:
    """The lowest row that each row reaches."""
    label = np.full(len(close), -1)
    for seed in range(len(close)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        front = [seed]
        while front:
            fresh = np.flatnonzero(close[front].any(0) & (label < 0))
            label[fresh] = seed
            front = fresh.tolist()
    return label


def near_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = 0.9
) -> DataFrame:
    """``id, n_links, component`` for each row: vectors linked at cosine ``threshold`` or more.

    Equal vectors are one class, counted by its rows. Each class is in the inverted lists of all
    pairs of its nearest pivots, so vectors meet if they share two pivots; those that meet are all
    verified in double precision. The lists of a pivot are compared in one task, to which a vector is
    sent once; those of a pivot with more than ``PIVOT_VECTORS`` vectors in tasks of their own, and a
    list above ``BLOCK_VECTORS`` block by block. Tasks return sums and one link per vector, not pairs. The index is approximate in
    which pairs meet; links are exact. All rows are indexed; the pivots are a bounded sample.

    Vectors that are null, zero or hold null or non-finite components, and rows without an identifier,
    are linked with nothing (a null identifier has a null component). Vectors of different dimension
    are never linked. Repeated rows count one by one; vectors that share an identifier are counted
    together. Other columns are not used.
    """
    held = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vector"))
    held = held.withColumn("good", usable(F.col("vector")) & F.col("id").isNotNull())
    alike = [F.xxhash64("vector").alias("one"), F.xxhash64(F.lit(1), "vector").alias("two"), F.size("vector").alias("size")]
    keys = ["one", "two", "size"]
    valid = held.where("good").select("id", "vector", *alike)
    classes = valid.groupBy(*keys).agg(
        F.min("id").alias("class"), F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector")
    )
    classes = materialise(classes, "vectors")
    pivots = choose_pivots(classes)

    near = nearest_pivots(F.col("vector"), pivots)
    indexed = materialise(classes.select(*keys, F.col("class").alias("id"), "times", near.alias("near")), "index")
    # A vector stands once for each of its pivots but the last; the lists of a pivot are compared together.
    entries = indexed.select("*", F.posexplode("near").alias("at", "p")).where(F.col("at") < F.size("near") - 1)
    counted = entries.groupBy("size", "p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = materialise(counted, "pivots")
    entries = entries.join(counted, ["size", "p"])
    fields = [*keys, "id", "times", "near", "p"]
    total = counted.where(F.col("n") <= PIVOT_VECTORS).agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-total // TASK_VECTORS))
    small = entries.where(F.col("n") <= PIVOT_VECTORS).select(
        *fields,
        F.lit(ANY).alias("q"),
        F.lit(-1).alias("own"),
        F.pmod(F.xxhash64("size", "p"), F.lit(tasks)).alias("task"),
    )
    # Those of a common pivot apart, and a common list block by block.
    apart = entries.where(F.col("n") > PIVOT_VECTORS)
    apart = apart.select(*fields, F.explode(F.filter("near", lambda b: b > F.col("p"))).alias("q"))
    lists = apart.groupBy("size", "p", "q").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lists = materialise(lists.withColumn("blocks", F.ceil(F.col("n") / BLOCK_VECTORS).cast("int")), "lists")
    apart = apart.join(lists, ["size", "p", "q"])
    apart = apart.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    apart = apart.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.struct(F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"))
    task = F.xxhash64("size", "p", "q", pair)
    # A block beside itself is compared as a whole, so its rows have no block there.
    block = F.when(F.col("own") == F.col("with"), -1).otherwise(F.col("own"))
    apart = apart.select(*fields, "q", block.alias("own"), task.alias("task"))
    placed = small.unionByName(apart)
    full = placed.join(classes.select(*keys, "vector"), keys)
    links = full.groupBy("task").applyInArrow(_links(threshold), "id long, links long, root long")
    links = materialise(links, "links")

    sums = links.groupBy(F.col("id").alias("class")).agg(F.sum("links").alias("links"))
    reached = components(links, "id", "root").withColumnRenamed("id", "class")
    named = classes.drop("vector").join(sums, "class", "left").join(reached, "class", "left")
    named = named.select(
        *keys,
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component"),
    )
    rows = held.select("id", *(F.when(F.col("good"), c).alias(k) for c, k in zip(alike, keys)))
    return rows.join(named, keys, "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")
    )
