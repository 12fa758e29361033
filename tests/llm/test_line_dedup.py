"""Deleted lines against a plain reading of the rule."""

import random
import re

import pytest

from orderloom.llm import line_dedup


def plain(rows, run_words):
    """rows: (order, text) in the order that counts. The text left over and the lines deleted.

    A line goes if any run of lines around it, of ``run_words`` words or more, stands earlier.
    """
    seen, out = set(), []
    for _, text in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        used = [k for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        gone = set()
        for i in range(len(used)):
            words = 0
            for j in range(i, len(used)):
                words += len(re.findall(r"[^\x20\x09-\x0D]+", lines[used[j]]))
                if words >= run_words:
                    content = tuple(lines[k] for k in used[i : j + 1])
                    if content in seen:
                        gone |= set(used[i : j + 1])
                    seen.add(content)
        kept = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        out.append((kept, len(lines), len(gone)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_rule(spark, seed):
    rng = random.Random(seed)
    pool = ["", "  ", "a b c", "a", "é \x1c", "x y z w v u t", "one two", "$1 \\0", "a b c "]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(60)] + [None, "", "\n", "\n\na"]
    texts += ["a\n" * 40, "\n".join(pool * 3)] * 2
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(df, run_words=5).collect()}
    assert [got[k] for k, _ in rows] == plain(rows, 5)


def test_clashing_columns_nulls_and_equal_orders(spark):
    same = "p q r\ns t u\nv w"
    rows = [(1, same, 3, "k"), (1, same, 4, "k"), (None, same, 5, "k"), (2, None, 6, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, hash string")
    out = line_dedup.dedup_lines(df, run_words=4)
    assert out.columns == ["doc_id", "text", "hash", "n_lines", "n_removed"]
    got = out.collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 3, 3]
    assert [r.text for r in got if r.doc_id is None] == [same]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_unrelated_texts_stay(spark):
    df = spark.range(30).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 80), x -> id * 100 + x)) as text")
    assert line_dedup.dedup_lines(df).where("n_removed > 0").count() == 0


def test_whole_runs_go_to_both_ends(spark):
    line = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    run = [line("s", 5), line("a", 60), line("b", 30), line("c", 10)]
    rows = [(1, "\n".join(run)), (2, "\n".join([line("x", 3), *run, line("y", 3)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: rows[0][1], 2: "\n".join([line("x", 3), line("y", 3)])}


def test_a_match_goes_on_where_only_a_later_copy_does(spark):
    """The first copy ends after the long line; the second goes on, and so does the third."""
    line = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    rows = [(1, line("a", 60)), (2, "\n".join([line("a", 60), line("b", 9)])), (3, "\n".join([line("x", 3), line("a", 60), line("b", 9)]))]
    rows += [(4, "\n".join([line("c", 9), line("a", 60)])), (5, "\n".join([line("c", 9), line("a", 60), line("y", 2)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: line("a", 60), 2: line("b", 9), 3: line("x", 3), 4: line("c", 9), 5: line("y", 2)}
    assert [got[k] for k, _ in rows] == [t for t, _, _ in plain(rows, 50)]
