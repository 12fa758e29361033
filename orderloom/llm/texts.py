"""Words and lines of whole texts as numpy arrays over their UTF-8 bytes.

A batch of texts is one byte buffer with offsets, as Arrow holds it. Words are the runs of
bytes other than space and 0x09-0x0D; multi-byte characters never contain those bytes, so
byte runs and character runs are the same. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are looked at in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that powers have inverses modulo 2**64
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def mix(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finalizer of splitmix64)."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; one more offset than texts."""
    wide = pa.large_binary() if pa.types.is_large_binary(texts.type) else pa.large_string()
    texts = pc.fill_null(texts, b"" if wide == pa.large_binary() else "").cast(wide)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base, size = int(ends[0]), int(ends[-1] - ends[0])
    held = np.frombuffer(data, np.uint8, size, base) if size else np.zeros(0, np.uint8)
    return held, ends - base


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows (first, one past the last) of about ``limit`` bytes; a longer text is alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield first, last
        first = last


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``buffers`` in runs of whole texts of about ``limit`` bytes, in order."""
    data, offsets = buffers(texts)
    for first, last in row_slices(offsets, limit):
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


@dataclass
class Runs:
    """Byte ranges and the number of the text each lies in."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def per_text(self, n: int) -> np.ndarray:
        return np.bincount(self.text, minlength=n)


def lower(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z only."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> Runs:
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return Runs(starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1)


def lines(data: np.ndarray, offsets: np.ndarray) -> Runs:
    """The \\n-split lines; an empty text is one empty line."""
    feeds = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], feeds + 1])
    ends = np.concatenate([feeds, offsets[1:]])
    text = np.arange(len(offsets) - 1)
    owner = np.searchsorted(offsets, feeds, "right") - 1
    starts_of, ends_of = np.concatenate([text, owner]), np.concatenate([owner, text])
    by_start, by_end = np.lexsort((starts, starts_of)), np.lexsort((ends, ends_of))
    return Runs(starts[by_start], ends[by_end], starts_of[by_start])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The powers of ``base`` up to ``n``; those for a slice are kept."""
    if n > SLICE_BYTES + 4096:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, out=out)
    if base not in _KEPT:
        _KEPT[base] = _powers(base, SLICE_BYTES + 4097)
    return _KEPT[base]


_KEPT: dict[np.uint64, np.ndarray] = {}


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any byte range."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers(_STEP, len(data))[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the bytes stand."""
    value = (sums[ends] - sums[starts]) * _powers(_STEP_BACK, len(sums))[starts]
    return mix(value + (ends - starts).astype(np.uint64))


def hashes(data: np.ndarray, runs: Runs) -> np.ndarray:
    return span_hashes(prefix_sums(data), runs.starts, runs.ends)


def shingles(word_hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size`` words in a row within a text, and the place of its first word."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.flatnonzero(text[:n] == text[size - 1 :])
    value = np.zeros(len(whole), np.uint64)
    for k in range(size):
        value = mix(value * _STEP + word_hashes[whole + k])
    return value, whole


def distinct_per_text(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs, ordered by text, then value."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], text[new]
