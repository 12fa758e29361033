"""Removed bytes against a plain reading of the rule."""

import random

import pytest

from orderloom.llm import suffixes, texts


def plain(rows, length):
    """rows in document order: remaining bytes, removed bytes and runs of each."""
    seen, out = set(), []
    for text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            string = data[i : i + length]
            if string in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(string)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((bytes(b for b, g in zip(data, gone) if not g), sum(gone), runs))
    return out


def got(df, **how):
    rows = suffixes.remove_repeats(df, **how).collect()
    return {r.doc_id: (bytes(r.left.kept), r.left.n_removed, r.left.n_spans) for r in rows}


def made(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abé ", k=rng.randint(20, 260))) for _ in range(12)]
    rows = []
    for _ in range(80):
        parts = [rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choices("abcdé \n", k=rng.randint(1, 90))) for _ in range(rng.randint(0, 5))]
        cut = [p[rng.randint(0, 30) : len(p) - rng.randint(0, 30)] if rng.random() < 0.5 else p for p in parts]
        rows.append("".join(cut))
    return rows + [None, "", "a" * 700, "ab" * 300, "a" * 99, "a" * 100, rows[5], rows[5]]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("block", [3, 20_000])
def test_against_plain_rule(spark, monkeypatch, seed, block):
    monkeypatch.setattr(suffixes, "BLOCK_CONTEXTS", block)
    rows = made(seed)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    out = got(df, length=100)
    assert [out[k] for k in range(len(rows))] == plain(rows, 100)


def test_texts_above_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_CHUNK", 400)
    rows = made(7)
    rows += ["".join(rows[k] or "" for k in range(30)), "".join(rows[k] or "" for k in range(20, 50))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(2)
    out = got(df, length=100)
    assert [out[k] for k in range(len(rows))] == plain(rows, 100)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, df.collect()))
    out = got(df)
    assert [out[k] for k, _ in rows] == plain([t for _, t in rows], 100)


def test_order_and_columns(spark):
    same = "0123456789" * 11
    rows = [(3, same, "x"), (None, same, "y"), (-5, same, "z"), (3, same, "w"), (9, None, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, left string")
    out = suffixes.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "left"]
    removed = sorted((str(r.doc_id), r.left.n_removed) for r in out.collect())
    within = len(same) - 10  # a string of ten bytes over and over repeats itself from the tenth byte on
    assert [k for k, _ in removed] == ["-5", "3", "3", "9", "None"]
    assert dict(removed)["None"] == within - 0 and dict(removed)["-5"] == 110 and dict(removed)["9"] == 0
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_hashes_do_not_depend_on_the_place():
    import numpy as np

    data = np.frombuffer(b"xxabcabcab", np.uint8)
    sums = texts.prefix_sums(data)
    a = texts.span_hashes(sums, np.array([2, 5, 0]), np.array([5, 8, 3]))
    assert a[0] == a[1] != a[2]
