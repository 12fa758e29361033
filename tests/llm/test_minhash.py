"""Components against all pairs of plain Python sets."""

import random
import re

import numpy as np
import pytest

from orderloom.llm import components, minhash


def plain_sets(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def plain_components(rows, size, percent=80):
    sets = {k: plain_sets(t, size) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    by = {}
    for k, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(k)
    pairs = {(a, b) for held in by.values() for i, a in enumerate(held) for b in held[i + 1 :]}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


def got(df, **how):
    return {r.id: (r.n_shingles, r.component) for r in minhash.near_duplicates(df, **how).collect()}


def made(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "And", "é", "x\x1cy", *map(str, range(400))]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 90))] for _ in range(n // 10)]
    rows = []
    for k in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words = [w.upper() for w in words]
        rows.append((k * 3 - 20, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(9001, None), (9002, ""), (9003, "  \n"), (9004, "one"), (9005, "ONE"), (9006, "one two")]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("block", [60, 2_000_000])
def test_against_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df, size=4) == plain_components(rows, 4)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs, size=4) == plain_components(rows, 4)
    assert got(docs) == plain_components(rows, 5)


def test_a_group_of_near_copies_without_a_centre(spark):
    """A chain in which only neighbours are similar enough, and the ends are not."""
    words = [f"w{k}" for k in range(160)]
    rows = []
    for k in range(30):
        rows.append((100 - k, " ".join(words)))
        words[5 * k : 5 * k + 5] = [f"n{k}.{i}" for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, size=4) == plain_components(rows, 4)
    assert {c for _, c in got(df, size=4).values()} == {71}


def test_edges(spark):
    rows = [(None, "a b c d e f", 1), (None, None, 2), (4, "a b c d e f", 3), (4, "a b c d e f", 4), (2, "a b c d e f", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component int")
    out = sorted(minhash.near_duplicates(df).collect(), key=str)
    assert [(r.id, r.component) for r in out if r.id is not None] == [(2, 2), (4, 2), (4, 2)]
    assert [r.component for r in out if r.id is None] == [None, None]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert minhash.near_duplicates(df.where("text is null")).count() == 1


def plain_rows(rows, size, percent=80):
    """By row: the row kept for it. Rows are linked by their sets, whatever their identifiers."""
    found = plain_components([(k, t) for k, (_, t) in enumerate(rows)], size, percent)
    members = {}
    for k, (key, text) in enumerate(rows):
        if key is not None and plain_sets(text, size):
            members.setdefault(found[k][1], []).append(k)
    leader = {k: k for k in range(len(rows))}
    for held in members.values():
        first = min(held, key=lambda k: (rows[k][0], k))
        leader.update({k: first for k in held})
    return leader


@pytest.mark.parametrize("seed, block", [(0, 60), (1, 2_000_000)])
def test_shared_and_null_identifiers(spark, monkeypatch, seed, block):
    """Several texts under one identifier, exact repeats, nulls: each row by its own set."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(minhash, "BLOCK_SIGNATURES", 3 if block == 60 else 4096)
    rng = random.Random(seed)
    texts = [t for _, t in made(seed, 90)]
    # A null identifier links nothing, so its text must not connect others either.
    rows = [(rng.choice([1, 2, 3, 4, 5, 6, 7, 8]), t) for t in texts] + [(None, "alone " * 3 + str(k)) for k in range(3)]
    rows += rng.sample(rows, 30)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "n long, doc_id long, text string").repartition(3)
    out = {r.row: (r.id, r.component, r.leader) for r in minhash.near_duplicates(df, size=4, row="n").collect()}
    leader = plain_rows(rows, 4)
    assert out == {k: (rows[k][0], rows[leader[k]][0], leader[k]) for k in range(len(rows))}
    # Which of several rows with the smallest identifier stays is up to their places in the table.
    left = minhash.keep_first(df, size=4).collect()
    assert len({leader[r.n] for r in left}) == len(left) == len(set(leader.values()))
    assert all(r.doc_id == rows[leader[r.n]][0] for r in left)


def test_a_text_under_a_shared_identifier_is_not_lost(spark):
    a, b = (" ".join(f"{t}{k}" for k in range(60)) for t in "ab")
    df = spark.createDataFrame([(5, a, "x"), (5, b, "y"), (1, a + " tail", "z")], "doc_id long, text string, _near_row string")
    assert sorted((r.doc_id, r.text) for r in minhash.keep_first(df).collect()) == [(1, a + " tail"), (5, b)]
    out = sorted((r.id, r.component) for r in minhash.near_duplicates(df).collect())
    assert out == [(1, 1), (5, 1), (5, 5)]


def test_distant_signatures_of_one_key_are_no_candidates():
    rng = np.random.default_rng(2)
    symbols = np.repeat(rng.integers(0, 1 << 16, (1, 64)), 6, 0).astype("<u2")
    for k, wrong in enumerate((0, 31, 32, 20, 64, 64)):
        symbols[k, :wrong] ^= k + 1
    symbols[5] = symbols[4]
    symbols[5, 60:] ^= 9
    found = minhash.links_within(np.arange(6), symbols)
    assert sorted(found) == [(0, 1), (0, 3), (4, 5)] or {frozenset(x) for x in found} >= {frozenset((0, 1)), frozenset((4, 5))}
    reach = {k: k for k in range(6)}
    for x, y in found:
        reach[y] = reach[x]
    true = (symbols[:, None] != symbols[None]).sum(-1) <= minhash.WRONG_SYMBOLS
    assert all(reach[x] == reach[y] for x, y in zip(*np.nonzero(true)))
    assert reach[4] != reach[0] and all(true[x, y] or any(true[x, z] and true[z, y] for z in range(6)) for x, y in found)


def test_signatures_meet_within_the_guaranteed_distance(spark):
    rng = np.random.default_rng(4)
    one = rng.integers(0, 1 << 16, minhash.SYMBOLS).astype("<u2")
    rows = []
    for k in range(40):
        other = one.copy()
        other[rng.choice(minhash.SYMBOLS, 31, replace=False)] ^= 1
        rows.append((k, bytearray(other.tobytes())))
    df = spark.createDataFrame([(-1, bytearray(one.tobytes())), *rows], "id int, signature binary")
    keys = {r.id: set(r.k) for r in df.select("id", minhash.chunk_keys(df.signature).alias("k")).collect()}
    assert all(keys[-1] & keys[k] for k in range(40))


@pytest.mark.parametrize("links", [[(k, k + 1) for k in range(60)], [(0, k) for k in range(50)], [(7, 7), (None, 3)], [(5, 2), (2, 5), (9, 5), (8, 1)]])
def test_components(spark, links):
    root = {}
    for a, b in links:
        if a is not None and a != b:
            for x in (a, b):
                root.setdefault(x, x)
    for _ in range(70):
        for a, b in links:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.id: r.component for r in components.components(df).collect()} == root
