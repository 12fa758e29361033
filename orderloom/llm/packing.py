"""Best-fit packing by the sum-of-squares rule."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.texts import mix
from orderloom.session import materialise

# Pieces of a first shard, shards that meet in one of the next round, and sequences that each
# shard hands on. A task of any round so holds at most FAN_IN * OPEN_SEQUENCES sequences.
SHARD_PIECES = 4096
FAN_IN = 8
OPEN_SEQUENCES = 512
_REPACKS = 3


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, placed in the given order.

    With N(g) open sequences of residual gap g, a piece goes where the sum of N(g)**2 becomes
    smallest; among equals, into the smallest gap that holds it. Closed sequences have no gap
    and do not count.
    """
    open_by_gap = np.zeros(capacity + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    gaps: list[int] = []
    for i, size in enumerate(lengths.tolist()):
        # Half the growth of the sum, by the gap that remains.
        growth = open_by_gap[: capacity + 1 - size] - open_by_gap[size:] + 1.0
        growth[0] = 0.5 - open_by_gap[size]
        growth[open_by_gap[size:] == 0] = np.inf
        left = int(growth.argmin())
        if growth[left] <= (open_by_gap[capacity - size] + 0.5 if size < capacity else 0):
            number = waiting[left + size].pop()
            open_by_gap[left + size] -= 1
        else:
            left, number = capacity - size, len(gaps)
            gaps.append(capacity)
        sequence[i], offset[i] = number, capacity - left - size
        gaps[number] = left
        if left:
            open_by_gap[left] += 1
            waiting[left].append(number)
    return sequence, offset


def pack_shard(lengths: np.ndarray, order: np.ndarray, capacity: int):
    """Pack once in ``order``, then empty the sequences with a gap and pack them by falling length.

    A repeat counts only if it needs fewer sequences. Returns sequence, offset, gap by sequence.
    """
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    sequence[order], offset[order] = sum_of_squares(lengths[order], capacity)
    for _ in range(_REPACKS):
        used = np.bincount(sequence, lengths).astype(np.int64)
        loose = np.flatnonzero((used < capacity)[sequence])
        if not len(loose):
            break
        by_length = loose[np.lexsort((order[loose], -lengths[loose]))]
        again, places = sum_of_squares(lengths[by_length], capacity)
        if again.max() + 1 >= len(np.unique(sequence[loose])):
            break
        free = np.setdiff1d(np.arange(sequence.max() + 1), np.setdiff1d(sequence, sequence[loose]))
        sequence[by_length], offset[by_length] = free[again], places
        _, sequence = np.unique(sequence, return_inverse=True)
    return sequence, offset, capacity - np.bincount(sequence, lengths).astype(np.int64)


def pack(pieces: DataFrame, length: str, capacity: int) -> DataFrame:
    """Add ``sequence_id`` (long) and ``offset`` (long): where each piece lies.

    Sequences hold up to ``capacity``; the pieces of one lie gapless from offset 0. Pieces are
    dealt at random over shards of bounded size, each packed by ``sum_of_squares``. A shard
    hands its ``OPEN_SEQUENCES`` emptiest sequences on, unpacked, to the shard of the next round
    in which ``FAN_IN`` of them meet, down to a single shard; so what stays partly empty does
    not grow with the number of shards.

    Nulls and lengths below 1 take no place: both new columns are null. A length above the
    capacity is an error. Repeated rows are packed one by one. An empty table gives an empty
    table. Existing columns ``sequence_id``, ``offset`` and those beginning with ``_pack_`` are
    replaced. Rows are fixed in shared storage first, so a lost task is repeated alike.
    """
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset") and not c.startswith("_pack_")]
    size = F.col(length).cast("long")
    numbered = pieces.select(*own).withColumn("_pack_row", F.monotonically_increasing_id())
    kept = materialise(numbered, "pieces").withColumn(
        "_pack_size",
        F.when(size > capacity, F.raise_error(F.lit(f"a piece is longer than {capacity}")).cast("long"))
        .when(size >= 1, size),
    )
    alone = F.col("_pack_size").isNull() | (F.col("_pack_size") == capacity)
    whole = kept.where(alone).select(
        *own,
        F.when(F.col("_pack_size").isNotNull(), -1 - F.col("_pack_row")).alias("sequence_id"),
        F.when(F.col("_pack_size").isNotNull(), F.lit(0)).cast("long").alias("offset"),
    )
    waiting = kept.where(~alone)
    shards = max(1, -(-waiting.count() // SHARD_PIECES))
    waiting = waiting.withColumn("_pack_shard", F.pmod(F.xxhash64("_pack_row"), F.lit(shards)))
    fields = T.StructType(
        [
            *waiting.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("_pack_open", T.BooleanType()),
        ]
    )
    done, level = [whole], 0
    while True:
        last = shards == 1
        placed = waiting.groupBy("_pack_shard").applyInArrow(_packer(capacity, level, last), fields)
        placed = materialise(placed, "packed")
        done.append(placed.where(~F.col("_pack_open")).select(*own, "sequence_id", "offset"))
        if last:
            break
        shards, level = -(-shards // FAN_IN), level + 1
        waiting = placed.where("_pack_open").withColumn("_pack_shard", F.col("_pack_shard") % shards)
        waiting = waiting.drop("sequence_id", "offset", "_pack_open")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _packer(capacity: int, level: int, last: bool):
    def packed(table: pa.Table) -> pa.Table:
        lengths = table.column("_pack_size").to_numpy()
        rows = table.column("_pack_row").to_numpy()
        scattered = mix(rows.astype(np.uint64))
        order = np.argsort(scattered) if level == 0 else np.lexsort((scattered, -lengths))
        sequence, offset, gaps = pack_shard(lengths, order, capacity)
        stays_open = np.zeros(len(gaps), bool)
        if not last:
            emptiest = np.argsort(-gaps, kind="stable")[:OPEN_SEQUENCES]
            stays_open[emptiest] = gaps[emptiest] > 0
        shard = table.column("_pack_shard")[0].as_py()
        number = (np.int64(level) << 56) + (np.int64(shard) << 24) + sequence
        for name, values in (("sequence_id", number), ("offset", offset), ("_pack_open", stays_open[sequence])):
            table = table.append_column(name, pa.array(values))
        return table

    return packed
