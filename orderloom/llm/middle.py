"""Fill-in-middle: texts are cut in three and put in another order, so that the middle comes last."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import texts

# Marks before prefix, suffix and middle: fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Percent of texts that are cut, and of these that begin with the suffix: fixed values.
CUT_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80

# What a character is: three bits, so three levels of the matrix.
INNER, SPACE, FEED, WORD_END, LAST_WORD, LAST_SPACE, LAST_FEED = range(7)
BITS = 3
# The characters with which a unit ends.
UNIT_ENDS = {
    "word": (WORD_END, LAST_WORD, LAST_SPACE, LAST_FEED),
    "line": (FEED, LAST_WORD, LAST_SPACE, LAST_FEED),
}

CUTS = T.StructType([T.StructField(name, T.IntegerType()) for name in ("n", "first", "second")])


def character_classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of every character, and where the characters of each text begin.

    White space is space and 0x09-0x0D. A word ends before white space or with its text; the last
    character of a text has a class of its own.
    """
    begins = (data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(begins)])
    lead = data[begins]
    white = texts._SPACE[lead]
    classes = np.where(white, np.where(lead == 10, FEED, SPACE), INNER).astype(np.uint8)
    ends = ~white
    ends[:-1] &= white[1:]
    classes[ends] = WORD_END
    first = before[offsets]
    last = first[1:][first[1:] > first[:-1]] - 1
    classes[last] = np.where(white[last], np.where(lead[last] == 10, LAST_FEED, LAST_SPACE), LAST_WORD)
    return classes, first


class WaveletMatrix:
    """Ranks of classes in a sequence: one bit row for each bit, zeros before ones from level to level."""

    def __init__(self, classes: np.ndarray, bits: int = BITS):
        self.size = len(classes)
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for bit in range(bits - 1, -1, -1):
            ones = (classes >> bit & 1).astype(bool)
            packed = np.packbits(np.concatenate([ones, np.zeros(64 - len(ones) % 64, bool)])).view(">u8").astype(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((packed, counts, len(ones) - int(counts[-1])))
            classes = np.concatenate([classes[~ones], classes[ones]])

    @staticmethod
    def _ones(level: tuple[np.ndarray, np.ndarray, int], at: np.ndarray) -> np.ndarray:
        """Ones before each place: whole words of 64 bits, then the first bits of one more."""
        packed, counts, _ = level
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        part = np.where(rest > 0, packed[word] >> (np.uint64(64) - np.maximum(rest, 1)), np.uint64(0))
        return counts[word] + np.bitwise_count(part).astype(np.int64)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        low, high = np.zeros_like(at), at
        for level, bit in zip(self.levels, range(len(self.levels) - 1, -1, -1)):
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            if symbol >> bit & 1:
                low, high = level[2] + ones_low, level[2] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low


def _boundaries(matrix: WaveletMatrix, ends: tuple[int, ...], at: np.ndarray) -> np.ndarray:
    """Unit ends before each place: the ranks of all classes that end a unit."""
    return sum(matrix.rank(symbol, at) for symbol in ends)


def _after_units(matrix: WaveletMatrix, ends: tuple[int, ...], first: np.ndarray, units: np.ndarray) -> np.ndarray:
    """The place after so many units from the beginning of each text: bisection on the boundary count."""
    begin = first[:-1]
    wanted = _boundaries(matrix, ends, begin) + units
    low, high = begin.copy(), first[1:].copy()
    while (low < high).any():
        middle = (low + high) >> 1
        enough = _boundaries(matrix, ends, middle) >= wanted
        high = np.where(enough, middle, high)
        low = np.where(enough, low, np.minimum(middle + 1, high))
    return low - begin


def cuts(text: Column, one: Column, other: Column, unit: str = "word") -> Column:
    """A struct of units in each whole text, and the characters before the first and the second cut.

    Of n units, the first cut is after the smaller of ``one % (n + 1)`` and ``other % (n + 1)``, the
    second after the larger. A word unit is a word with the white space before it, white space at the
    end is one more; a line unit is a line with its line feed. Null and empty texts have no unit.
    """
    ends = UNIT_ENDS[unit]

    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, one, other in batches:
            draws = [np.asarray(column.fill_null(0)) for column in (one, other)]
            parts, done = [np.zeros((3, 0), np.int32)], 0
            for data, offsets in texts.slices(text):
                classes, first = character_classes(data, offsets)
                matrix = WaveletMatrix(classes)
                counted = _boundaries(matrix, ends, first)
                n = counted[1:] - counted[:-1]
                drawn = [d[done : done + len(n)] % (n + 1) for d in draws]
                done += len(n)
                places = [_after_units(matrix, ends, first, f(*drawn)) for f in (np.minimum, np.maximum)]
                parts.append(np.stack([n, *places]).astype(np.int32))
            yield pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(parts, 1)], CUTS.names)

    return F.arrow_udf(cut, CUTS)(text, one, other)


def fill_in_middle(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = 42, unit: str = "word", into: str = "fim"
) -> DataFrame:
    """Add a struct ``into``: ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Four numbers are drawn from the hash of seed and identifier, so reruns agree and equal identifiers
    are cut alike; a null identifier counts as empty text. The form is ``plain`` (the text as it is, no
    cut) for empty texts, texts that hold a mark, and by the third number; otherwise ``spm`` (suffix,
    prefix, middle) or ``psm`` by the fourth. Null texts count as empty. All rows and columns stay,
    repeated rows too; a column named like ``into`` is replaced.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole, F.lit(mark))
    plain = (whole == "") | marked | (draws[2] % 100 >= CUT_PERCENT)
    cut = documents.withColumn(into, cuts(F.col(text), draws[0], draws[1], unit))
    first, second = F.col(f"{into}.first"), F.col(f"{into}.second")
    prefix, middle = F.substring(whole, F.lit(1), first), F.substring(whole, first + 1, second - first)
    suffix = F.substring(whole, second + 1, F.length(whole))
    form = F.when(plain, "plain").when(draws[3] % 100 < SUFFIX_FIRST_PERCENT, "spm").otherwise("psm")
    output = (
        F.when(form == "plain", whole)
        .when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    chars = lambda count: F.when(~plain, count.cast("long"))
    return cut.withColumn(
        into,
        F.struct(
            F.col(f"{into}.n").cast("long").alias("n"),
            form.alias("form"),
            chars(first).alias("prefix_chars"),
            chars(second - first).alias("middle_chars"),
            output.alias("output"),
        ),
    )


def restored(output: Column, form: Column) -> Column:
    """The text from which ``output`` was made; exact, since a text that is cut holds no mark.

    A mark cannot arise where a part meets a mark either: it would have to begin or end inside one.
    """
    parts = F.split(output, "<[PSM]>")
    part = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
    )
