"""Fill-in-middle against a plain Python reading of its rules."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import middle, texts

UNITS = {"word": re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"), "line": re.compile(r"[^\n]*\n|[^\n]+")}


def plain(key, text, unit="word"):
    text = text or ""
    units = UNITS[unit].findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return (n, "plain", None, None, text)
    p, m, s = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def some_texts(n, seed=3):
    draw = random.Random(seed)
    pieces = ["a", "word", "é", "漢字", "🙂", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\xa0", "<", ">", "<P", "S>", "<M>", "."]
    out = ["".join(draw.choices(pieces, [6, 6, 4, 3, 2, 8, 2, 4, 1, 1, 1, 1, 1, 1, 1, 1, 0.05, 3], k=draw.randrange(60))) for _ in range(n)]
    return ["", None, " ", "\n", "x", " x ", *out]


@pytest.mark.parametrize("unit", ["word", "line"])
def test_equals_plain_reading(spark, unit):
    held = list(enumerate(some_texts(1500)))
    df = spark.createDataFrame(held, "doc_id long, text string")
    found = middle.fill_in_middle(df, unit=unit)
    found = found.select("doc_id", "fim.*", middle.restored(F.col("fim.output"), F.col("fim.form")).alias("back"))
    rows = {r[0]: tuple(r[1:]) for r in found.collect()}
    for key, text in held:
        assert rows[key] == (*plain(key, text, unit), text or ""), (key, text)
    assert {r[1] for r in rows.values()} == {"plain", "spm", "psm"}


def test_odd_rows(spark):
    """Null keys, repeated rows, a very long text, clashing columns, no rows."""
    long = " ".join(f"w{k}" for k in range(200_000)) + "\n"
    held = [(None, "a b c d", "x"), (1, long, None), (1, long, None), (2, None, "y"), (3, " " * 300_000, "z")]
    df = spark.createDataFrame(held, "doc_id long, text string, fim string").withColumn("n", F.lit(1))
    found = middle.fill_in_middle(df)
    assert found.columns == ["doc_id", "text", "fim", "n"]
    rows = [(r.doc_id, r.text, tuple(r.fim)) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(((k, t, plain(k, t)) for k, t, _ in held), key=str)
    assert middle.fill_in_middle(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 128, 1000])
def test_ranks(size):
    classes = np.random.default_rng(size).integers(0, 7, size).astype(np.uint8)
    matrix, at = middle.WaveletMatrix(classes), np.arange(size + 1)
    for symbol in range(7):
        expected = np.concatenate([[0], np.cumsum(classes == symbol)])
        assert (matrix.rank(symbol, at) == expected).all()


def test_classes_of_neighbouring_texts():
    data, offsets = texts.buffers(pa.array(["ab", "", " c\n", "é d ", "\n"]))
    classes, first = middle.character_classes(data, offsets)
    assert first.tolist() == [0, 2, 2, 5, 9, 10]
    assert classes.tolist() == [
        middle.INNER, middle.LAST_WORD, middle.SPACE, middle.WORD_END, middle.LAST_FEED,
        middle.WORD_END, middle.SPACE, middle.WORD_END, middle.LAST_SPACE, middle.LAST_FEED,
    ]
