"""Pieces lie gapless in sequences that are few; the pieces are the tokenizer's."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.size))
    for held in by.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= capacity
    return len(by)


def test_rule_takes_the_place_of_least_squares():
    """Each placement is the best of all that are possible, counted anew."""
    capacity, rng = 12, np.random.default_rng(1)
    lengths = rng.integers(1, capacity + 1, 200)
    sequence, offset = packing.sum_of_squares(lengths, capacity)
    used = {}
    for size, place, at in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):

        def squares(target):
            after = dict(used)
            after[target] = after.get(target, 0) + size
            gaps = np.bincount([capacity - u for u in after.values()], minlength=capacity + 1)
            return (gaps[1:] ** 2).sum()

        options = [k for k, u in used.items() if u + size <= capacity] + [len(used)]
        assert squares(place) == min(map(squares, options)) and used.get(place, 0) == at
        used[place] = at + size


@pytest.mark.parametrize("shard", [8, 4096])
def test_pack(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    monkeypatch.setattr(packing, "OPEN_SEQUENCES", max(2, shard // 8))
    rng = np.random.default_rng(3)
    rows = [(int(k % 9), int(s), "own") for k, s in enumerate(rng.integers(1, 101, 700))]
    df = spark.createDataFrame(rows, "doc_id long, size long, offset string").repartition(3)
    out = packing.pack(df, "size", 100).collect()
    assert len(out) == 700 and out[0].asDict().keys() == {"doc_id", "size", "sequence_id", "offset"}
    least = sum(r[1] for r in rows) / 100
    assert check_layout(out, 100) <= least * (1.06 if shard > 8 else 1.25)


def test_pack_edges(spark):
    rows = [(None,), (0,), (-3,), (10,), (10,), (4,), (4,)]
    df = spark.createDataFrame(rows, "size int")
    out = packing.pack(df, "size", 10).collect()
    assert sorted(str((r.size, r.offset)) for r in out if r.sequence_id is None) == ["(-3, None)", "(0, None)", "(None, None)"]
    assert check_layout([r for r in out if r.sequence_id is not None], 10) == 3
    assert packing.pack(df.limit(0), "size", 10).count() == 0
    with pytest.raises(Exception, match="longer than 9"):
        packing.pack(df, "size", 9).collect()


def test_pieces_are_the_tokenizers(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [None, "", "a", "word " * 50, "é中😀 <|endoftext|> x\n\n  y", "z" * 300, "a <|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in df.select("doc_id", F.inline(tokens.token_pieces(F.col("text"), PATH, 20))).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert sum(r.length for r in got[k]) == len(ids)
        at = 0
        for n, r in enumerate(sorted(got[k], key=lambda r: r.piece)):
            assert r.piece == n and r.start == at and (n == 0 or r.length == 20) and 0 < r.length <= 20
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
