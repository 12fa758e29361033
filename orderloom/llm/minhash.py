"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import texts
from orderloom.llm.components import components
from orderloom.session import materialise

# A signature is SYMBOLS minima of BITS bits. It is split into CHUNKS, and a chunk may have ERRORS
# wrong symbols, so all pairs within CHUNKS * (ERRORS + 1) - 1 = 31 wrong symbols share a key. A
# pair of similarity 0.8 has 12.8 on average; it has 32 or more once in 10**7 cases.
SYMBOLS = 64
BITS = 16
CHUNKS = 16
ERRORS = 1
_WIDTH = SYMBOLS // CHUNKS
WRONG_SYMBOLS = CHUNKS * (ERRORS + 1) - 1
# Shingles that one task compares at a time; signatures with one key that do, and those of small keys.
BLOCK_SHINGLES = 500_000
BLOCK_SIGNATURES = 4096
TASK_SIGNATURES = 50_000

_MULTIPLY = texts.mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = texts.mix(np.arange(101, SYMBOLS + 101, dtype=np.uint64))

SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("signature", T.BinaryType()),
    ]
)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, with its number; fewer than ``size`` words are one shingle."""
    data = texts.lower(data)
    words = texts.words(data, offsets)
    hashed = texts.hashes(data, words)
    values, first = texts.shingles(hashed, words.text, size)
    values, text = [values], [words.text[first]]
    count = words.per_text(len(offsets) - 1)
    for n in range(1, size):
        begin = np.searchsorted(words.text, np.flatnonzero(count == n))
        value = np.full(len(begin), n, np.uint64)
        for k in range(n):
            value = texts.mix(value * np.uint64(31) + hashed[begin + k])
        values.append(value)
        text.append(words.text[begin])
    return texts.distinct_per_text(np.concatenate(values), np.concatenate(text))


def sketches(text: Column, size: int) -> Column:
    """A struct for each whole text: the size of its shingle set, a 128-bit hash of the set, the signature.

    A text without words has an empty set, hash 0 and no signature.
    """

    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for data, offsets in texts.slices(batch):
                values, of = shingle_sets(data, offsets, size)
                n = len(offsets) - 1
                count = np.bincount(of, minlength=n)
                some = np.flatnonzero(count)
                begin = np.searchsorted(of, some)
                sums = np.zeros((2, n), np.uint64)
                least = np.zeros((SYMBOLS, len(some)), np.uint64)
                if len(some):
                    for k in range(2):
                        sums[k, some] = np.add.reduceat(texts.mix(values + _ADD[k]), begin)
                    for k in range(SYMBOLS):
                        least[k] = np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], begin)
                symbols = (texts.mix(least.T) & np.uint64((1 << BITS) - 1)).astype("<u2")
                signature: list[bytes | None] = [None] * n
                for i, row in zip(some.tolist(), symbols):
                    signature[i] = row.tobytes()
                for column, part in zip(columns, (count.tolist(), *sums.view(np.int64).tolist(), signature)):
                    column += part
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.binary())]
            yield pa.StructArray.from_arrays(arrays, SKETCH.names)

    return F.arrow_udf(sketch, SKETCH)(text)


def chunk_keys(signature: Column) -> Column:
    """The keys of a signature: each chunk with each choice of ``ERRORS`` symbols left out."""

    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            held = b"".join(batch.to_pylist())
            symbols = np.frombuffer(held, "<u2").reshape(-1, CHUNKS, _WIDTH).astype(np.uint64)
            out = []
            for left_out in range(_WIDTH):
                value = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(_WIDTH) + np.uint64(left_out)
                value = np.broadcast_to(value, symbols.shape[:2])
                rest = [k for k in range(_WIDTH) if k != left_out]
                # Chunk number and the other symbols fit into 64 bits, so no two keys are mixed up.
                for k in rest:
                    value = (value << np.uint64(BITS)) | symbols[..., k]
                out.append(value)
            flat = np.stack(out, -1).reshape(len(symbols), -1).view(np.int64)
            ends = np.arange(0, flat.size + 1, CHUNKS * _WIDTH, dtype=np.int32)
            yield pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))

    return F.arrow_udf(keys, T.ArrayType(T.LongType()))(signature)


def links_within(nodes: np.ndarray, symbols: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all signatures within ``WRONG_SYMBOLS`` of each other, without naming each pair."""
    waiting = np.ones(len(nodes), bool)
    links = []
    for seed in range(len(nodes)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        reached = [seed]
        while reached and waiting.any():
            left = np.flatnonzero(waiting)
            near = left[(symbols[left] != symbols[reached.pop()]).sum(1) <= WRONG_SYMBOLS]
            waiting[near] = False
            links += [(int(nodes[seed]), int(other)) for other in nodes[near]]
            reached += near.tolist()
    return links


def _near_signatures(table: pa.Table) -> pa.Table:
    """Links between the signatures of each key that are within ``WRONG_SYMBOLS``."""
    table = table.combine_chunks().sort_by("key")
    key, nodes = table.column("key").to_numpy(), table.column("node").to_numpy()
    symbols = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, SYMBOLS)
    cuts = np.append(np.flatnonzero(np.diff(key, prepend=key[0] - 1)), len(key))
    size = np.diff(cuts)
    two = cuts[:-1][size == 2]
    two = two[(symbols[two] != symbols[two + 1]).sum(1) <= WRONG_SYMBOLS]
    links = list(zip(nodes[two].tolist(), nodes[two + 1].tolist()))
    for begin, held in zip(cuts[:-1][size > 2], size[size > 2]):
        links += links_within(nodes[begin : begin + held], symbols[begin : begin + held])
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def links_among(ids: np.ndarray, values: np.ndarray, of: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all documents with 100 * common >= percent * union, without naming each pair.

    Documents are visited from linked ones outward and compared with those not yet reached, so a
    group of copies takes one comparison each. ``of`` is sorted: the document of each shingle.
    """
    count = np.bincount(of, minlength=len(ids))
    begin = np.concatenate([[0], np.cumsum(count)])
    _, code = np.unique(values, return_inverse=True)
    marked = np.zeros(code.max() + 1 if len(code) else 0, bool)
    waiting = np.ones(len(ids), bool)
    codes, owner, held = code, of, len(ids)
    links = []
    for seed in np.argsort(ids, kind="stable").tolist():
        if not waiting[seed]:
            continue
        waiting[seed] = False
        reached = [seed]
        while reached:
            one = reached.pop()
            left = int(waiting.sum())
            if not left:
                break
            if left < 0.7 * held:
                stay = waiting[owner]
                codes, owner, held = codes[stay], owner[stay], left
            own = code[begin[one] : begin[one + 1]]
            marked[own] = True
            common = np.bincount(owner[marked[codes]], minlength=len(ids))
            marked[own] = False
            near = waiting & (common > 0) & (100 * common >= percent * (count[one] + count - common))
            for other in np.flatnonzero(near).tolist():
                waiting[other] = False
                links.append((int(ids[seed]), int(ids[other])))
                reached.append(other)
    return links


def _compare(size: int, percent: int):
    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("group")
        groups = table.column("group").to_numpy()
        ids = table.column("id").to_numpy()
        text = table.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        values, of, done = [], [], 0
        for data, offsets in texts.slices(text):
            found, number = shingle_sets(data, offsets, size)
            values.append(found)
            of.append(number + done)
            done += len(offsets) - 1
        values, of = np.concatenate(values), np.concatenate(of)
        cuts = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1, append=groups[-1] + 1))
        shingle_cuts = np.searchsorted(of, cuts)
        links = []
        for a, b, x, y in zip(cuts, cuts[1:], shingle_cuts, shingle_cuts[1:]):
            if b - a > 1:
                links += links_among(ids[a:b], values[x:y], of[x:y] - a, percent)
        return pa.table(
            {"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())}
        )

    return compare


def _in_blocks(rows: DataFrame, group: str, blocks: Column, small: Column) -> DataFrame:
    """``rows`` beside the task they are compared in: small groups share one, each pair of blocks has its own.

    A row of a group of several blocks stands beside each block once, its own block left out where
    there are others, since every block meets another one as a whole.
    """
    rows = rows.withColumn("blocks", blocks.cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks = 1 or own != with")
    pair = F.struct(F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"))
    task = F.when(F.col("blocks") == 1, small).otherwise(F.xxhash64(group, pair))
    return rows.withColumn("task", task).drop("blocks", "own", "with")


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    row: str | None = None,
) -> DataFrame:
    """``id, n_shingles, component, row, leader`` for each row: what it is linked with, directly or over others.

    Documents are linked if 100 * common >= ``percent`` * union over their sets of ``size``-word
    shingles (A-Z lower-cased). Equal sets are one class, and classes are what is linked, whatever
    identifiers their rows have. Signatures of classes that agree in a chunk but for ``ERRORS`` symbols
    meet at that key; those within ``WRONG_SYMBOLS`` of each other are candidates. Whole texts of
    classes that candidates connect are then compared on their full sets. Both comparisons go block by
    block in tasks of bounded size, two blocks at a time if a group exceeds one, and name no pair that
    others connect already. Each pair of signatures within the guaranteed distance is decided by its sets.

    ``component`` is the smallest identifier of any row reached, ``leader`` the row of that identifier
    (the first of several). Documents without words and null identifiers are linked with nothing and
    lead themselves; a null identifier has a null component. Rows that share an identifier are each
    linked by their own text, so they may be in different components; repeated rows are in one.
    ``row`` names a column of unique numbers that stay the same when ``documents`` is read again;
    without one, rows are numbered in a stored copy of the texts. The identifier must be an integer.
    Empty tables give empty tables; other columns are not used.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    held = documents.select(number.alias("row"), F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    own = ["row", "id"] if row else ["row", "id", "text"]
    sketched = materialise(held.select(*own, sketches(F.col("text"), size).alias("s")).select(*own, "s.*"), "sketches")
    whole_texts = (held if row else sketched).select("row", "text")
    sketched = sketched.drop("text")
    alike = ["set_a", "set_b", "n_shingles"]
    classes = sketched.where("n_shingles > 0 and id is not null").groupBy(*alike)
    classes = classes.agg(F.min(F.struct("id", "row")).alias("first"), F.min("signature").alias("signature"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    keyed = classes.select("node", F.explode(chunk_keys(F.col("signature"))).alias("key"))
    # Stored, so that the join reads plain shuffles, which adaptive execution can split at a common key.
    shared = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "keys")
    meeting = materialise(keyed.join(shared.hint("merge"), "key"), "meeting")
    tasks = max(1, -(-meeting.count() // TASK_SIGNATURES))
    placed = _in_blocks(
        meeting, "key", F.ceil(F.col("n") / BLOCK_SIGNATURES), F.pmod(F.xxhash64("key"), F.lit(tasks))
    )
    signed = placed.join(classes.select("node", "signature").hint("merge"), "node").select("task", "key", "node", "signature")
    candidates = signed.groupBy("task").applyInArrow(_near_signatures, "a long, b long")
    near = components(candidates).withColumnRenamed("id", "node")

    texts_of = classes.select("node", "first.row", "n_shingles")
    grouped = materialise(near.join(texts_of, "node"), "groups")
    whole = grouped.groupBy("component").agg(F.sum("n_shingles").alias("whole"))
    total = grouped.agg(F.sum("n_shingles")).first()[0] or 0
    tasks = max(1, -(-total // BLOCK_SHINGLES))
    placed = _in_blocks(
        grouped.join(whole, "component"),
        "component",
        F.ceil(F.col("whole") / BLOCK_SHINGLES),
        F.pmod(F.xxhash64("component"), F.lit(tasks)),
    )
    placed = placed.select("row", F.col("node").alias("id"), F.col("component").alias("group"), "task")
    # What meets the texts grows with them, so it is never broadcast.
    compared = (
        whole_texts.join(placed.hint("merge"), "row")
        .groupBy("task")
        .applyInArrow(_compare(size, percent), "a long, b long")
    )
    linked = components(compared).withColumnRenamed("id", "node")
    led = classes.select(*alike, "node", "first").join(linked, "node", "left")
    led = led.withColumn("component", F.coalesce("component", "node"))
    firsts = led.groupBy("component").agg(F.min("first").alias("leader"))
    named = led.join(firsts, "component").select(*alike, "leader")
    # One row for each text, also where an identifier has several.
    known = F.col("id").isNotNull()
    return sketched.join(named, alike, "left").select(
        "id",
        "n_shingles",
        F.when(known, F.coalesce("leader.id", "id")).alias("component"),
        "row",
        F.when(known, F.coalesce("leader.row", "row")).otherwise(F.col("row")).alias("leader"),
    )


def keep_first(documents: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``near_duplicates``: that of the smallest identifier, the first of several.

    Rows without words or identifier all stay. The columns stay as they are; those beginning with
    ``_near_`` are replaced.
    """
    own = [c for c in documents.columns if not c.startswith("_near_")]
    fixed = materialise(documents.select(*own, F.monotonically_increasing_id().alias("_near_row")), "near")
    found = near_duplicates(fixed, id_column, text, size, percent, row="_near_row")
    copies = found.where("row != leader").select(F.col("row").alias("_near_row"))
    return fixed.join(copies, "_near_row", "left_anti").select(*own)
