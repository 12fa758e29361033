"""Targets against step-by-step resharing; the mix against its bounds."""

import random

import pytest
from pyspark.sql import functions as F

from orderloom.llm import mixing


def reshared(sizes, weights=mixing.WEIGHTS, most=mixing.MOST_COPIES):
    """Share, cut off, share the excess again until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, left = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in capped]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]] if free else []
        if not over:
            return capped | {s: left * weight[s] / total for s in free}
        for s in over:
            capped[s] = most * sizes[s]
        left = sum(sizes.values()) - sum(capped.values())


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "A", "a", "ä", "z", "zz", "\U0001f600", "￮"]
    rows = [(rng.choice(names), rng.choice([0, 1, 5, 40, 3000 * (seed > 1)])) for _ in range(60)]
    sizes = {}
    for s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    df = spark.createDataFrame(rows, "source string, size long")
    got = {r.source: r for r in mixing.source_targets(df, "source", "size").collect()}
    want = reshared(sizes)
    assert set(got) == set(want)
    for s, t in want.items():
        assert got[s].source_size == sizes[s] and got[s].target == pytest.approx(t, rel=1e-9, abs=1e-9)


def test_targets_of_nothing(spark):
    df = spark.createDataFrame([("a", 0), (None, None)], "source string, size long")
    assert [(r.source_size, r.target) for r in mixing.source_targets(df, "source", "size").collect()] == [(0, 0.0)] * 2
    assert mixing.source_targets(df.limit(0), "source", "size").count() == 0


def test_mix_meets_targets_and_repeats(spark):
    """A hot source, equal rows, null keys, zero sizes and a clashing column."""
    rows = [(k % 50 if k % 7 else None, "hot" if k % 3 else f"s{k % 5}", k % 90, "x") for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, words long, target string").repartition(5)
    df = df.withColumn("source", F.when(F.col("doc_id") == 3, None).otherwise(F.col("source")))
    fixed = spark.createDataFrame(df.collect(), df.schema)
    out = mixing.mix(fixed, F.col("words"))
    assert out.columns == ["doc_id", "source", "words", "size", "source_size", "target", "copies"]
    assert out.count() == len(rows)
    assert out.where("copies < 0 or copies > 3 or copies != floor(copies)").count() == 0
    for r in out.groupBy("source").agg(F.sum(F.expr("copies * size")).alias("n"), F.first("target").alias("t")).collect():
        assert abs(r.n - r.t) <= 45
    again = mixing.mix(fixed, F.col("words"))
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert mixing.repeated(out).count() == out.agg(F.sum("copies")).first()[0]
    assert mixing.mix(fixed.limit(0), F.col("words")).count() == 0


def test_levels_keep_group_sizes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    df = spark.range(500).selectExpr("id as doc_id", "'one' as source", "1 + id % 9 as words")
    two = df.union(df.selectExpr("doc_id + 500", "'two'", "words"))
    for r in mixing.mix(two, F.col("words")).groupBy("source").agg(
        F.sum(F.expr("copies * size")).alias("n"), F.first("target").alias("t")
    ).collect():
        assert abs(r.n - r.t) <= 4.5


def test_words(spark):
    df = spark.createDataFrame([(None,), ("",), (" a\tb\x0bc\x1cd e ",), ("é",)], "t string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 4, 1]
