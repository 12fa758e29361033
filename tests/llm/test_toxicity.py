"""The factorization machine: its formula, what it learns, and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import texts, toxicity


def test_terms_are_letter_runs_and_stems():
    rows = ["Idiot, idiot!", "", "x1yz\nÉté", None, "ab"]
    bucket, owner = toxicity.hashed_terms(*texts.buffers(pa.array(rows)))
    one = lambda s: toxicity.hashed_terms(*texts.buffers(pa.array([s])))[0].tolist()
    assert sorted(bucket[owner == 0]) == sorted(one("idiot") * 2)
    assert len(set(one("idiot"))) == 2 and len(set(one("idiotic"))) == 4
    stems = lambda s: set(one(s)) - {one(s)[0]}
    assert stems("idiotic") & stems("idioten")
    assert sorted(bucket[owner == 2]) == sorted(one("x") + one("yz") + one("Été"))
    assert not len(bucket[owner == 1]) and not len(bucket[owner == 3])


def test_log_odds_equal_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    model = toxicity.FactorMachine(np.arange(20), 0.3, draw.normal(size=20), draw.normal(size=(20, 3)))
    held = [draw.choice(20, k, replace=False) for k in (0, 1, 2, 7, 20)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in held])])
    found = model.log_odds(np.concatenate(held), first)
    for own, value in zip(held, found):
        pairs = sum(model.factors[a] @ model.factors[b] for i, a in enumerate(own) for b in own[i + 1 :])
        assert value == pytest.approx(model.bias + model.weights[own].sum() + pairs)


INSULTS = ["loser", "idiot", "clown", "moron"]
GROUPS = ["northers", "southers", "westers", "easters"]


def pairs_table(spark, n=1500):
    """Toxic are texts with an insult and a group; either alone is as common and harmless."""
    draw = random.Random(5)
    rows = []
    for k in range(n):
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words = [f"{draw.choice('bcdfgh')}{draw.choice('aeiou')}{draw.choice('lmnrst')}" for _ in range(draw.randrange(5, 60))]
        words += [draw.choice(INSULTS)] * insult + [draw.choice(GROUPS)] * group
        draw.shuffle(words)
        rows.append((k, " ".join(words), int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def accuracy(model, table):
    judged = toxicity.judge(table.where(toxicity.held_out(F.col("doc_id"))), model)
    return judged.agg(F.avg((F.col("toxicity.predicted") == F.col("toxic")).cast("int"))).first()[0]


def test_pairs_are_learnt_where_weights_alone_fail(spark):
    table = pairs_table(spark).cache()
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    assert accuracy(model, table) > 0.97
    # Of the pairs, an insult and a group push towards toxic, two insults do not.
    place = lambda w: int(np.flatnonzero(np.isin(model.buckets, toxicity.hashed_terms(*texts.buffers(pa.array([w])))[0]))[0])
    a, b = model.factors[[place(w) for w in INSULTS]], model.factors[[place(w) for w in GROUPS]]
    assert (a @ b.T).min() > 0
    alone = toxicity.train(docs, labels, factors=0)
    score = lambda text: float(alone.scores(*texts.buffers(pa.array([text])))[0])
    gain = lambda one, other: np.log(one / (1 - one)) - np.log(other / (1 - other))
    assert gain(score("loser northers"), score("northers")) == pytest.approx(gain(score("loser"), score("")))


@pytest.mark.parametrize("folder, caught", [("sf0.01", 0.6), ("sf0.1", 0.85)])
def test_held_out_accuracy(spark, folder, caught):
    read = lambda name: spark.read.parquet(f"/root/testdata/{folder}/{name}.parquet")
    docs = read("documents").select("doc_id", "text")
    labels = read("labels")
    judged = toxicity.judge(docs.join(labels, "doc_id"), toxicity.train(docs, labels))
    rows = judged.where(toxicity.held_out(F.col("doc_id"))).select("toxic", "toxicity.*").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean(toxic) >= caught and np.mean(clean) <= 0.01
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_reruns_agree_and_other_columns_do_not_count(spark):
    table = pairs_table(spark, 400)
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    again = toxicity.train(docs.repartition(7), labels.withColumn("quality", F.lit(None)).repartition(3))
    assert (model.buckets == again.buckets).all() and (model.factors == again.factors).all()
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {r.doc_id for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()} == set(held)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (toxicity.train(docs, turned).weights == model.weights).all()


def test_odd_rows(spark):
    """Nulls, odd and double labels, labels of one kind, clashing columns, repeated rows, no rows."""
    docs = spark.createDataFrame(
        [(None, "idiot", "a"), (1, None, "b"), (1, "", "b"), (2, "idiot " * 50_000, "c"), (2, "idiot " * 50_000, "c")],
        "doc_id long, text string, toxicity string",
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 7), (None, 1), (3, None), (9, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = toxicity.train(docs, some)
        rows = toxicity.judge(docs, model).select("doc_id", "toxicity.*").collect()
        assert len(rows) == 5 and len({r.score for r in rows}) == 1 and 0 < rows[0].score < 1
    assert toxicity.judge(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0
    assert re.match("double", toxicity.judge(docs, model).schema["toxicity"].dataType["score"].dataType.simpleString())
