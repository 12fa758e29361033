"""Counts and ids against the tokenizers library."""

import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = [*" \n\t\r  \x1c\x1f\x85\xa0 ​᠎　 aAbé'sslvermt'd19²٣!<|>endoftext|中\U0001f600́.\x00", "<|endoftext|>", "'ll", " "]


def test_random_texts():
    library, rng = Tokenizer.from_file(PATH), random.Random(3)
    counter, encoder = tokens.MergeCounter(PATH), tokens.Encoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choices(LETTERS, k=rng.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert counter(text) == len(ids)
        assert encoder(text).tolist() == ids


def test_documents_and_edges(spark):
    library = Tokenizer.from_file(PATH)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    edges = [(None, None), (-1, ""), (-2, "a" * 20000), (-3, "aB" * 9000), (-4, " \n" * 5000), (-4, "x")]
    docs = docs.union(spark.createDataFrame(edges, docs.schema)).withColumn("c", F.lit(1))
    rows = docs.withColumn("counted", tokens.token_counts(F.col("text"), PATH)).collect()
    assert len(rows) == 206
    for r in rows:
        text = r.text or ""
        assert r.counted.n_bytes == len(text.encode())
        assert r.counted.n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 3)
    counter = tokens.MergeCounter(PATH)
    text = " ".join(f"w{k}" for k in range(50))
    first = counter(text)
    assert counter("b") == 1 and len(counter.chunks) == 1 and counter(text) == first


def test_other_vocabularies_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="not supported"):
        tokens.MergeCounter(str(tmp_path / "v.json"))


@pytest.mark.parametrize("text", [
    " " * 1_000_001 + "x", "a" + "\n" * 1_000_001, "b　<|endoftext|>" + "　\n" * 500_001 + "<|endoftext|>  é x",
    "x" + " \t" * 50_000 + "y", "x" + " " * 99_999 + "y",
])
def test_long_white_space(text):
    library = Tokenizer.from_file(PATH)
    assert tokens.Encoder(PATH)(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_of_long_white_space(spark):
    df = spark.createDataFrame([(1, "x" + "\n" * 1_000_001), (2, "y")], "doc_id long, text string")
    pieces = df.select("doc_id", F.inline(tokens.token_pieces(F.col("text"), PATH, 2048)))
    got = dict(pieces.groupBy("doc_id").agg(F.sum("length")).collect())
    ids = Tokenizer.from_file(PATH).encode("x" + "\n" * 1_000_001, add_special_tokens=False).ids
    assert got == {1: len(ids) + 1, 2: 2}


@pytest.mark.parametrize("seed", range(3))
def test_ids_and_counts_over_the_whole_vocabulary(seed):
    """Every token of the vocabulary, in random order and random joins, with and without white space between them."""
    library, rng = Tokenizer.from_file(PATH), random.Random(seed)
    counter, encoder = tokens.MergeCounter(PATH), tokens.Encoder(PATH)
    every = list(range(library.get_vocab_size()))
    rng.shuffle(every)
    at = 0
    while at < len(every):
        size = rng.randint(1, 400)
        words = [library.decode([k], skip_special_tokens=False) for k in every[at : at + size]]
        at += size
        text = rng.choice(["", " ", "\n", ""]).join(words)
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder(text).tolist() == ids and counter(text) == len(ids)
