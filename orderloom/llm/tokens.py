"""Token counts and token pieces of whole texts.

Texts are cut where a byte-level tokenizer cuts them in any case: before the white space in
front of a word. A pre-token never reaches over such a place and no rule looks to the left of
it, so chunks can be counted on their own and remembered by the Python worker for its later
tasks. What is remembered is bounded by ``CACHE_ENTRIES`` chunks of at most ``CACHE_CHARS``
characters; other chunks are worked out each time they occur.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 48
# A text with a run of white space as long as this is encoded by the tokenizers library itself:
# tiktoken goes back over such runs on a stack that ends at a million characters.
LIBRARY_WHITE = 100_000

# The white space of Unicode, and the published pattern of byte-level pre-tokens.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CHUNKS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+").findall

_WHITE_RUNS = re.compile(f"[{_WHITE}]+").finditer

_HELD = "_orderloom_llm_held"

COUNTS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in letters)
    return letters | {b: chr(256 + k) for k, b in enumerate(rest)}


class Known(dict):
    """Remembers ``work(key)`` for short keys; ``trim`` keeps it bounded."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key: str):
        value = self.work(key)
        if len(key) <= CACHE_CHARS:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHE_ENTRIES:
            self.clear()


class MergeCounter:
    """Counts the tokens of a byte-level vocabulary by merging, without looking up ids."""

    def __init__(self, path: str):
        spec = self.load(path)
        model = spec["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.letters = byte_letters()
        self.specials = special_splitter([t["content"] for t in spec.get("added_tokens", [])])
        self.pre_tokens = regex.compile(_PRE_TOKENS).findall
        self.parts = Known(self.merged)
        self.chunks = Known(self.chunk)

    @staticmethod
    def load(path: str) -> dict:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or cut.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level merge vocabulary")
        if cut.get("add_prefix_space") or not cut.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError(f"{path} uses options that are not supported")
        return spec

    def merged(self, pre_token: str) -> int:
        """Initial symbols minus merges; the lowest rank goes first, the leftmost among equals."""
        symbols = list(map(self.letters.__getitem__, pre_token.encode()))
        n = count = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.ranks
        found = map(ranks.get, zip(symbols, symbols[1:]))
        heap = [(rank, i) for i, rank in enumerate(found) if rank is not None]
        heapq.heapify(heap)
        while heap:
            rank, left = heapq.heappop(heap)
            right = after[left]
            # An entry is stale when its pair was changed by a merge beside it.
            if right >= n or ranks.get((symbols[left], symbols[right])) != rank:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            count -= 1
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                rank = ranks.get((symbols[left], symbols[follower]))
                if rank is not None:
                    heapq.heappush(heap, (rank, left))
            leader = before[left]
            if leader >= 0:
                rank = ranks.get((symbols[leader], symbols[left]))
                if rank is not None:
                    heapq.heappush(heap, (rank, leader))
        return count

    def chunk(self, text: str) -> int:
        if (text[1:] if text[0] == " " else text).isalpha():  # letters are one pre-token
            return self.merged(text)
        return sum(map(self.parts.__getitem__, self.pre_tokens(text)))

    def __call__(self, text: str) -> int:
        """The tokens of a text; the string of an added token is one."""
        self.parts.trim()
        self.chunks.trim()
        texts = self.specials(text)
        return len(texts) // 2 + sum(sum(map(self.chunks.__getitem__, _CHUNKS(t))) for t in texts[::2])


class Encoder:
    """Token ids of whole texts for a byte-level vocabulary, as the tokenizers library gives them.

    The vocabulary file is the library's; the ids are looked up by tiktoken, which is five times
    as fast. Texts with ``LIBRARY_WHITE`` characters of white space in a row go to the library
    itself. Strings of added tokens become their ids.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        spec = MergeCounter.load(path)
        bytes_of = {letter: bytes([b]) for b, letter in byte_letters().items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        ranks = {b"".join(map(bytes_of.__getitem__, token)): i for token, i in vocabulary.items()}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens=added
        )

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> np.ndarray:
        if len(text) >= LIBRARY_WHITE and any(m.end() - m.start() >= LIBRARY_WHITE for m in _WHITE_RUNS(text)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.encoding.encode_to_numpy(text, allowed_special="all")


def per_process(kind, path: str):
    """One ``kind(path)`` for each Python worker process, kept for its later tasks."""
    held = sys.modules.setdefault(_HELD, types.ModuleType(_HELD)).__dict__
    key = f"{kind.__name__} {path}"
    if key not in held:
        held[key] = kind(path)
    return held[key]


def special_splitter(strings: list[str]):
    """Cut a text at the strings of added tokens; these stand at the odd places of the result."""
    if not strings:
        return lambda text: [text]
    longest_first = sorted(strings, key=lambda s: (-len(s), s))
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split


def token_counts(text: Column, path: str) -> Column:
    """A struct ``n_bytes, n_tokens`` of each whole text.

    Null and empty texts have no bytes and no tokens. Texts of any length are counted whole;
    equal texts get equal counts. ``path`` is a byte-level ``.json`` vocabulary that every
    executor can open; strings of its added tokens count as one token each.
    """

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = per_process(MergeCounter, path)
        for batch in batches:
            held = ["" if t is None else t for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(t.encode()) for t in held], pa.int64()),
                    pa.array([counter(t) for t in held], pa.int64()),
                ],
                ["n_bytes", "n_tokens"],
            )

    return F.arrow_udf(count, COUNTS)(text)


def token_pieces(text: Column, path: str, capacity: int, end_id: int = 0) -> Column:
    """The pieces of each whole text: an array of ``piece, start, length, ids_crc32``.

    A text's ids, then ``end_id``, make one piece if at most ``capacity`` long. A longer one is
    cut into pieces of exactly ``capacity`` ids, but for the first, which takes what is left
    over. Null and empty texts are one piece that holds ``end_id`` alone.
    """
    end = np.array([end_id], np.uint32)

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = per_process(Encoder, path)
        for batch in batches:
            rows = []
            for text in batch.to_pylist():
                ids = np.append(encode(text or ""), end).astype("<u4")
                n = len(ids)
                first = n % capacity or capacity
                places = [0, *range(first, n + 1, capacity)]
                rows.append(
                    [
                        {"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[a:b])}
                        for k, (a, b) in enumerate(zip(places, places[1:]))
                    ]
                )
            yield pa.array(rows, _PIECES_ARROW)

    return F.arrow_udf(cut, PIECES)(text)


_PIECES_ARROW = pa.list_(
    pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
)
