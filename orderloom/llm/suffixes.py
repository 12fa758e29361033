"""Removal of repeated byte strings by sorting sampled suffixes and inducing the others.

A string of ``length`` bytes repeats if it begins at two places. As in induced sorting, only some
suffixes are sorted and the rest follow from them:

* Sampled suffixes. The sample is a local minimum of hashed names, as the leftmost-S positions are of
  plain ones: of the ``NAME_BYTES``-grams in a string the least, the leftmost of equals. It depends on
  the string's bytes alone and every string has one, so equal strings have equal samples.
* External sorting. Tuples (name, hash of the context, document, place) go through Spark's sort, which
  spills to disk and merges. Each task reads its tuples in order, as from a disk-backed priority queue,
  and holds two of them. Contexts equal to an earlier one are repeats as a whole.
* Induction. Where one name has different contexts, these are sorted by the suffix at the sample, with
  the common prefix of neighbours; the strings that begin before the sample are induced from right to
  left: one byte more and the class to its right give the class, and a common prefix one byte longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import texts
from orderloom.session import materialise

NAME_BYTES = 32
# Contexts of a name that one task compares at a time; names with more go string by string.
BLOCK_CONTEXTS = 20_000
TASK_CONTEXTS = 50_000
_CHUNK = 2 << 20

_KEY = ["doc", "tie"]
_TUPLES = pa.schema(
    [("name", pa.int64()), ("context", pa.int64()), ("doc", pa.int64()), ("tie", pa.int32()), ("place", pa.int64()), ("later", pa.bool_())]
)
_SCANNED = pa.schema(
    [("doc", pa.int64()), ("tie", pa.int32()), ("name", pa.int64()), ("place", pa.int64()), ("again", pa.bool_())]
)
_SPANS = pa.schema([("doc", pa.int64()), ("tie", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def _samples(data: np.ndarray, ends: np.ndarray, length: int):
    """Runs of strings with one sample: first and last start, sample, its name, context hash.

    ``ends``: for each byte the end of its text. The hash of the context covers all strings of the run.
    """
    n, size = len(data), min(NAME_BYTES, length)
    m, reach = n - size + 1, length - size + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums = texts.prefix_sums(data)
    names = texts.span_hashes(sums, np.arange(m), np.arange(m) + size)
    bits = np.uint64(int(m).bit_length())
    ranked = (names >> bits << bits) | np.arange(m, dtype=np.uint64)
    # The minimum of a window is that of the tail of one block and the head of the next.
    blocks = np.concatenate([ranked, np.full(-m % reach, np.iinfo(np.uint64).max)]).reshape(-1, reach)
    head = np.minimum.accumulate(blocks, 1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(tail[:starts], head[reach - 1 : reach - 1 + starts])
    at = np.flatnonzero(np.arange(starts) + length <= ends[:starts])
    sample = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    fresh = np.flatnonzero(np.diff(sample, prepend=-1) != 0)
    first, last, sample = at[fresh], at[np.append(fresh[1:], len(at)) - 1] if len(at) else at, sample[fresh]
    context = texts.mix(texts.span_hashes(sums, first, last + length) + (sample - first).astype(np.uint64))
    return first, last, sample, names[sample], context


def sample_tuples(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One tuple for each run of strings with one sample; of equal contexts in a batch all but the first are ``later``.

    A place holds the first start, and how far the sample and the last start lie behind it.
    """
    for batch in batches:
        doc, tie = batch.column("doc").to_numpy(zero_copy_only=False), batch.column("tie").to_numpy(zero_copy_only=False)
        data, offsets = texts.buffers(batch.column("text"))
        parts, row = [], 0
        while row < len(doc):
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _CHUNK, "right")) - 1)
            stop = min(stop, len(doc))
            low, high = int(offsets[row]), int(offsets[stop])
            for begin in range(low, max(high - length + 1, low + 1), _CHUNK):
                # A text above a chunk is cut where its strings begin; contexts may then be shorter.
                end = min(high, begin + _CHUNK + length - 1) if stop == row + 1 else high
                of = np.repeat(np.arange(row, stop), np.diff(np.clip(offsets[row : stop + 1], begin, end)))
                first, last, sample, name, context = _samples(
                    data[begin:end], np.clip(offsets[of + 1], begin, end) - begin, length
                )
                owner = of[first]
                place = (first + begin - offsets[owner]) << 16 | (sample - first) << 8 | (last - first)
                parts.append((name.view(np.int64), context.view(np.int64), doc[owner], tie[owner], place))
                if stop > row + 1:
                    break
            row = stop
        if not parts:
            continue
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((columns[4], columns[3], columns[2], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        later = np.zeros(len(order), bool)
        later[1:] = (columns[0][1:] == columns[0][:-1]) & (columns[1][1:] == columns[1][:-1])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, later)], schema=_TUPLES)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read sorted tuples once: contexts met before (``again``), and first contexts of names that have several."""

    def give(doc, tie, name, place, again):
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (doc, tie, name, place, np.full(len(doc), again))], schema=_SCANNED
        )

    held, shared = None, False  # the last first context, and whether its name had one before
    for batch in batches:
        later = batch.column("later").to_numpy(zero_copy_only=False)
        name, context, doc, tie, place = (batch.column(k).to_numpy() for k in range(5))
        own = np.flatnonzero(~later)
        before = held[:2] if held else (None, None)
        same = np.zeros(len(own), bool)
        if len(own):
            same[1:] = (name[own][1:] == name[own][:-1]) & (context[own][1:] == context[own][:-1])
            same[0] = (name[own[0]], context[own[0]]) == before
        again = np.concatenate([np.flatnonzero(later), own[same]])
        yield give(doc[again], tie[again], name[again], place[again], True)
        fresh = own[~same]
        if not len(fresh):
            continue
        columns = [c[fresh] for c in (name, context, doc, tie, place)]
        if held:
            columns = [np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(held, columns)]
        alike = columns[0][1:] == columns[0][:-1]
        several = np.zeros(len(columns[0]), bool)
        several[1:] |= alike
        several[:-1] |= alike
        several[0] |= shared and held is not None
        held, shared = [c[-1] for c in columns], bool(several[-1])
        out = np.flatnonzero(several[:-1])
        yield give(columns[2][out], columns[3][out], columns[0][out], columns[4][out], False)
    if held and shared:
        name, _, doc, tie, place = ([x] for x in held)
        yield give(np.array(doc), np.array(tie), np.array(name), np.array(place), False)


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are asked for."""
    for batch in batches:
        data, offsets = texts.buffers(batch.column("text"))
        wanted = batch.column("wanted")
        count = np.diff(wanted.offsets.to_numpy())
        of = np.repeat(np.arange(len(batch)), count)
        asked = wanted.flatten()
        name, place = (asked.field(k).to_numpy(zero_copy_only=False) for k in range(2))
        start = offsets[of] + (place >> 16)
        size = (place & 255) + length
        held = memoryview(data)
        blobs = [held[a : a + n].tobytes() for a, n in zip(start.tolist(), size.tolist())]
        doc, tie = (batch.column(c).to_numpy(zero_copy_only=False)[of] for c in _KEY)
        for a in range(0, len(of), 20_000):
            b = slice(a, a + 20_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[b]), pa.array(doc[b]), pa.array(tie[b]), pa.array(place[b]), pa.array(blobs[b], pa.binary())],
                ["name", "doc", "tie", "place", "bytes"],
            )


def induced_repeats(name, order, before, behind, blobs, length: int) -> np.ndarray:
    """Which strings of the contexts of a name are repeats: a flag by context and distance to the sample.

    ``before``: bytes in front of the sample; ``behind``: how many strings begin after the first one;
    ``order``: the rank of each context in document order.
    """
    reach = int(before.max()) + 1
    low = before - behind
    data = np.frombuffer(b"".join(blobs), np.uint8)
    size = np.array([len(b) for b in blobs])
    at = np.cumsum(size) - size + before
    width = -(-length // 8) * 8
    right = np.zeros((len(blobs), width), np.uint8)
    for k in range(length):
        has = np.flatnonzero(before + k < size)
        right[has, k] = data[at[has] + k]
    left = np.zeros((len(blobs), reach), np.uint8)
    for k in range(1, reach):
        has = np.flatnonzero(before >= k)
        left[has, k] = data[at[has] - k]
    # Sort the sampled suffixes of each name and take the common prefix of neighbours.
    by_suffix = np.lexsort((*right.view(">u8").T[::-1], name))
    rows = right[by_suffix]
    differ = rows[1:, :length] != rows[:-1, :length]
    common = np.where(differ.any(1), differ.argmax(1), length)
    common[name[by_suffix][1:] != name[by_suffix][:-1]] = -1
    found = np.zeros((len(blobs), reach), bool)
    klass = np.zeros(len(blobs), np.int64)
    run = np.zeros(len(blobs), np.int64)
    for k in range(reach):
        if k:  # from a suffix to the one that begins a byte earlier
            _, klass = np.unique(klass * 256 + left[:, k], return_inverse=True)
        run[by_suffix] = np.concatenate([[0], np.cumsum(common < length - k)])
        here = np.flatnonzero((low <= k) & (k <= before))
        first = here[np.lexsort((order[here], klass[here], run[here]))]
        same = (run[first][1:] == run[first][:-1]) & (klass[first][1:] == klass[first][:-1])
        found[first[1:][same], k] = True
    return found


def _induce(length: int):
    def induce(table: pa.Table) -> pa.Table:
        name, doc, tie, place = (table.column(c).to_numpy() for c in ("name", "doc", "tie", "place"))
        blobs = table.column("bytes").to_pylist()
        start, before, behind = place >> 16, place >> 8 & 255, place & 255
        order = np.empty(len(name), np.int64)
        order[np.lexsort((start + before, tie, doc))] = np.arange(len(name))
        found = induced_repeats(name, order, before, behind, blobs, length)
        edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, nearest = np.nonzero(edge == 1)
        _, beyond = np.nonzero(edge == -1)
        sample = (start + before)[row]
        return pa.table(
            [pa.array(c) for c in (doc[row], tie[row], sample - beyond + 1, sample - nearest + length)], schema=_SPANS
        )

    return induce


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every string of the contexts with a hash that also tells its name and distance to the sample."""
    for batch in batches:
        name, doc, tie, place = (batch.column(k).to_numpy() for k in range(4))
        data, offsets = texts.buffers(batch.column("bytes").cast(pa.large_binary()))
        count = (place & 255) + 1
        of = np.repeat(np.arange(len(place)), count)
        behind = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = offsets[of] + behind
        hashed = texts.span_hashes(texts.prefix_sums(data), at, at + length)
        away = ((place >> 8 & 255)[of] - behind).astype(np.uint64)
        hashed = texts.mix(texts.mix(hashed + name[of].view(np.uint64)) + away)
        start = (place >> 16)[of] + behind
        columns = (hashed.view(np.int64), doc[of], tie[of], start)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["string", "doc", "tie", "start"])


def repeated_spans(documents: DataFrame, length: int) -> DataFrame:
    """``doc, tie, spans``: byte ranges of strings that begin earlier too; they may overlap.

    ``documents`` has ``doc`` (the order), ``tie`` and ``text``.
    """
    tuples = documents.mapInArrow(
        lambda batches: sample_tuples(batches, length),
        "name long, context long, doc long, tie int, place long, later boolean",
    )
    # What is known to be later needs no comparison and is spread; of equal contexts one a batch is left.
    goes_to = F.when(F.col("later"), F.xxhash64("doc", "place")).otherwise(F.col("name"))
    in_order = tuples.repartition(goes_to).sortWithinPartitions("name", "context", *_KEY, "place")
    scanned = materialise(
        in_order.mapInArrow(_scan, "doc long, tie int, name long, place long, again boolean"), "suffixes"
    )
    start = F.shiftright("place", 16)
    whole = scanned.where("again").select(
        *_KEY, start.alias("start"), (start + F.col("place").bitwiseAND(255) + length).alias("end")
    )

    asked = scanned.where("not again")
    wanted = asked.groupBy(*_KEY).agg(F.collect_list(F.struct("name", "place")).alias("wanted"))
    contexts = materialise(
        documents.join(wanted.hint("merge"), _KEY).mapInArrow(
            lambda batches: _contexts(batches, length), "name long, doc long, tie int, place long, bytes binary"
        ),
        "contexts",
    )
    sizes = contexts.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    large = materialise(sizes.where(F.col("n") > BLOCK_CONTEXTS).select("name"), "names")
    tasks = max(1, -(-contexts.count() // TASK_CONTEXTS))
    task = F.pmod(F.xxhash64("name"), F.lit(tasks)).alias("task")
    some = contexts.join(large, "name", "left_anti").select("*", task)
    induced = some.groupBy("task").applyInArrow(_induce(length), "doc long, tie int, start long, end long")

    rest = contexts.join(large, "name", "left_semi").mapInArrow(
        lambda batches: _strings(batches, length), "string long, doc long, tie int, start long"
    )
    place = F.struct(*_KEY, "start")
    first = rest.groupBy("string").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    first = materialise(first.where("times > 1").drop("times"), "strings")
    later = rest.join(first, "string").where(place > F.col("first"))
    later = later.select(*_KEY, "start", (F.col("start") + length).alias("end"))

    spans = whole.unionByName(induced).unionByName(later)
    return spans.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


LEFT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def cut_spans(data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Bytes, removed bytes, removed runs of each text, and the bytes left of all; spans may overlap."""
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    gone = np.cumsum(edge[:-1]) > 0
    inner = np.ones(len(data) + 1, bool)
    inner[offsets] = False
    opens = gone.copy()
    opens[1:] &= ~gone[:-1] | ~inner[1:-1]
    within = [np.concatenate([[0], np.cumsum(flags)])[offsets] for flags in (gone, opens)]
    return np.diff(offsets), *(np.diff(counted) for counted in within), data[~gone]


def _cut(text: Column, spans: Column) -> Column:
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for held, ranges in batches:
            data, offsets = texts.buffers(held)
            found = ranges.flatten()
            begin, end = (found.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            count = np.diff(ranges.offsets.to_numpy())
            place = np.concatenate([[0], np.cumsum(count)])
            base = np.repeat(offsets[:-1], count)
            parts = []
            for first, last in texts.row_slices(offsets):
                low, own = offsets[first], slice(place[first], place[last])
                own_base = base[own] - low
                parts.append(
                    cut_spans(
                        data[low : offsets[last]],
                        offsets[first : last + 1] - low,
                        begin[own] + own_base,
                        end[own] + own_base,
                    )
                )
            size, removed, runs, left = (np.concatenate(c) for c in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
            ends = np.concatenate([[0], np.cumsum(size - removed)]).astype(np.int64)
            kept = pa.Array.from_buffers(
                pa.large_binary(), len(held), [None, pa.py_buffer(ends), pa.py_buffer(left.astype(np.uint8))]
            )
            columns = [pa.array(c.astype(np.int64)) for c in (size, removed, runs)]
            yield pa.StructArray.from_arrays([*columns, kept.cast(pa.binary())], LEFT.names)

    return F.arrow_udf(cut, LEFT)(text, spans)


def remove_repeats(
    documents: DataFrame, order: str = "doc_id", text: str = "text", length: int = 100, into: str = "left"
) -> DataFrame:
    """Add a struct ``into``: ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (bytes).

    A byte goes if a string of ``length`` bytes (at most 256) over it also begins earlier: in a document
    of smaller ``order``, or further up in the same one. Strings do not cross documents, overlaps count,
    and strings are judged on the input.

    All rows and columns stay; a column named like ``into`` is replaced. Null texts are empty; nothing of
    a text shorter than ``length`` goes. The order is an integer, null first; among equal orders the text's
    hash decides, and rows equal in both are one document and get the same result. An empty table gives
    an empty table.
    """
    held = documents.select(
        F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.hash(F.coalesce(text, F.lit(""))).alias("tie"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    spans = repeated_spans(held, length).withColumnsRenamed({"doc": "_doc", "tie": "_tie", "spans": "_spans"})
    keyed = documents.withColumns(
        {
            "_doc": F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63))),
            "_tie": F.hash(F.coalesce(text, F.lit(""))),
        }
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = keyed.join(spans.hint("merge"), ["_doc", "_tie"], "left").withColumn("_spans", F.coalesce("_spans", none))
    return joined.withColumn(into, _cut(F.col(text), F.col("_spans"))).drop("_doc", "_tie", "_spans")
