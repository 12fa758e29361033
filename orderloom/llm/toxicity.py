"""Toxicity: a factorization machine over hashed terms of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import texts
from orderloom.session import materialise

# Bounds of what is learnt from: labelled documents, and terms that get weights.
SAMPLE_DOCS = 6000
MOST_TERMS = 4096
# Terms are hashed to so many buckets; a bucket that fewer sampled documents hold has no weight.
HASH_BITS = 20
LEAST_DOCS = 3
# One document in so many is never learnt from.
HELD_OUT = 5
# A term is a run of letters, or its first letters: so many characters of it.
STEMS = (4, 5, 6)
# Numbers that describe what a term does beside other terms.
FACTORS = 4

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def _letter_runs(data: np.ndarray, offsets: np.ndarray) -> texts.Runs:
    inside = np.concatenate([_LETTER[data], [False]])
    begins = inside[:-1].copy()
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins[1:] &= ~inside[:-2] | first[1:-1]
    stops = inside[:-1] & (~inside[1:] | first[1:])
    starts = np.flatnonzero(begins)
    return texts.Runs(starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, "right") - 1)


def hashed_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every term, with repeats: lower-cased runs of letters and their stems.

    Letters are A-Z, a-z and all characters beyond ASCII.
    """
    data = texts.lower(data)
    runs = _letter_runs(data, offsets)
    sums = texts.prefix_sums(data)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(chars, runs.starts)
    beyond = np.append(chars, np.full(max(STEMS) + 1, len(data)))
    values, owners = [texts.span_hashes(sums, runs.starts, runs.ends)], [runs.text]
    for size in STEMS:
        end = beyond[first + size]
        long = np.flatnonzero(end < runs.ends)
        values.append(texts.mix(texts.span_hashes(sums, runs.starts[long], end[long]) + np.uint64(size)))
        owners.append(runs.text[long])
    bucket = (np.concatenate(values) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    return bucket, np.concatenate(owners)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows between each place in ``first`` and the next."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


@dataclass
class FactorMachine:
    """log-odds = bias + the weights of a text's terms + the products of the factors of its pairs of terms."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def log_odds(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """``terms`` are places in ``buckets``, distinct in a text; ``first`` is where each text's begin."""
        held = self.factors[terms]
        pairs = _sums(held, first) ** 2 - _sums(held**2, first)
        return self.bias + _sums(self.weights[terms], first) + pairs.sum(1) / 2

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        terms, first = np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        if len(self.buckets):
            bucket, owner = hashed_terms(data, offsets)
            place = np.searchsorted(self.buckets, bucket)
            known = self.buckets[np.minimum(place, len(self.buckets) - 1)] == bucket
            key = np.unique(owner[known] * len(self.buckets) + place[known])
            terms, first = key % len(self.buckets), np.searchsorted(key, np.arange(n + 1) * len(self.buckets))
        return logistic(self.log_odds(terms, first))

    @classmethod
    def fit(
        cls,
        buckets: np.ndarray,
        places: list[np.ndarray],
        labels: list[int],
        factors: int = FACTORS,
        passes: int = 60,
        penalty: float = 1e-4,
    ) -> FactorMachine:
        """Maximum likelihood with a quadratic penalty, by steps over small batches with adaptive rates.

        ``places`` are those of each text's distinct terms in ``buckets``. Without texts of both labels
        or without buckets the score is the share of label 1 for all texts, without texts a half.
        """
        y = np.array(labels, float)
        share = (y.sum() + 0.5) / (len(y) + 1)
        bias = float(np.log(share / (1 - share)))
        if not 0 < y.sum() < len(y):
            buckets = buckets[:0]
        draw = np.random.default_rng(7)
        model = cls(buckets, bias, np.zeros(len(buckets)), draw.normal(0, 0.05, (len(buckets), factors)))
        if not len(buckets):
            return model
        rates = [np.full(1, 1e-6), np.full(len(buckets), 1e-6), np.full((len(buckets), factors), 1e-6)]
        for _ in range(passes):
            for batch in np.array_split(draw.permutation(len(y)), max(1, len(y) // 64)):
                terms = np.concatenate([places[k] for k in batch])
                size = np.array([len(places[k]) for k in batch])
                first = np.concatenate([[0], np.cumsum(size)])
                of = np.repeat(np.arange(len(batch)), size)
                used, slot = np.unique(terms, return_inverse=True)
                own = model.factors[terms]
                error = y[batch] - logistic(model.log_odds(terms, first))
                push = error[of] / len(batch)
                turned = np.zeros((len(used), factors))
                np.add.at(turned, slot, push[:, None] * (_sums(own, first)[of] - own))
                slopes = (
                    np.array([error.mean()]),
                    np.bincount(slot, push, len(used)) - penalty * model.weights[used],
                    turned - penalty * model.factors[used],
                )
                rates[0] += slopes[0] ** 2
                rates[1][used] += slopes[1] ** 2
                rates[2][used] += slopes[2] ** 2
                model.bias += 0.1 * float(slopes[0][0] / np.sqrt(rates[0][0]))
                model.weights[used] += 0.1 * slopes[1] / np.sqrt(rates[1][used])
                model.factors[used] += 0.02 * slopes[2] / np.sqrt(rates[2][used])
        return model


def logistic(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))


def telling(held: DataFrame) -> np.ndarray:
    """The buckets that stand out by label, ascending; at most the ``MOST_TERMS`` clearest.

    ``held`` has a ``label`` and distinct ``buckets`` for each text. Of the buckets in ``LEAST_DOCS``
    texts or more, those are taken whose likelihood ratio with the label exceeds twice the log of
    their number, which about one of them all does by chance.
    """
    n, ones = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    counted = held.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket")
    counted = counted.agg(F.count(F.lit(1)).alias("times"), F.sum("label").alias("with_one"))
    counted = materialise(counted.where(F.col("times") >= LEAST_DOCS), "terms")
    limit = 2 * float(np.log(max(counted.count(), 1)))
    times, one = F.col("times"), F.col("with_one")
    cells = (
        (one, times * ones / n),
        (times - one, times * (n - ones) / n),
        (ones - one, (n - times) * ones / n),
        (n - times - ones + one, (n - times) * (n - ones) / n),
    )
    ratio = sum((F.when(seen > 0, 2 * seen * F.log(seen / due)).otherwise(0.0) for seen, due in cells), F.lit(0.0))
    clearest = counted.withColumn("ratio", F.round(ratio, 6)).where(F.col("ratio") > limit)
    clearest = clearest.orderBy(F.desc("ratio"), "bucket").limit(MOST_TERMS).select("bucket").collect()
    return np.array(sorted(r.bucket for r in clearest), np.int64)


def held_out(identifier: Column) -> Column:
    """True for the documents that are never learnt from; a null identifier counts as empty text, which is one."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit(""))) % HELD_OUT == 0


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    factors: int = FACTORS,
) -> FactorMachine:
    """Fit on a bounded sample of the labelled documents that are not ``held_out``; only their texts count.

    The sample is the ``SAMPLE_DOCS`` labels whose identifiers have the lowest hashes, so reruns agree.
    Terms are taken from whole texts and counted in Spark; the driver gets the chosen buckets and the
    places of those in each text. Texts of one label with the same terms count once, so copies do not
    outvote the rest. Labels other than 0 and 1, null identifiers, and labels without a document are
    left out; where an identifier has several labels or documents, each pair counts.
    """
    key = F.col(id_column)
    few = (
        labels.where(key.isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
        .select(key.alias("_id"), F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(SAMPLE_DOCS)
    )
    # At most SAMPLE_DOCS pairs of numbers.
    sample = documents.select(key.alias("_id"), F.col(text).alias("text")).join(F.broadcast(few), "_id")
    held = sample.select(F.col("_label").alias("label"), "text").mapInArrow(_buckets, "label int, buckets array<int>")
    held = held.withColumn("key", F.xxhash64("buckets")).dropDuplicates(["label", "key"])
    held = materialise(held, "labelled")
    labelled = dict(held.groupBy("label").count().collect())
    buckets = telling(held) if len(labelled) == 2 else np.zeros(0, np.int64)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.flatnonzero(np.isin(buckets, b)).astype(np.int32) for b in batch.column("buckets").to_pylist()]
            columns = [batch.column("key"), batch.column("label"), pa.array(own, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "label", "places"])

    rows = held.mapInArrow(placed, "key long, label int, places array<int>").collect()
    rows = sorted(rows, key=lambda r: (r.key, r.label))
    return FactorMachine.fit(buckets, [np.array(r.places, np.int64) for r in rows], [r.label for r in rows], factors)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, held = batch.column("label").to_pylist(), []
        for data, offsets in texts.slices(batch.column("text")):
            values, owner = texts.distinct_per_text(*hashed_terms(data, offsets))
            held += np.split(values.astype(np.int32), np.searchsorted(owner, np.arange(1, len(offsets) - 1)))
        for at in range(0, len(labels), 200):
            part = [pa.array(labels[at : at + 200], pa.int32()), pa.array(held[at : at + 200], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(part, ["label", "buckets"])


def scores(text: Column, model: FactorMachine) -> Column:
    """The probability of label 1 for each whole text; null and empty texts get that of no terms."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.scores(data, offsets) for data, offsets in texts.slices(batch)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]))

    return F.arrow_udf(score, T.DoubleType())(text)


def judge(documents: DataFrame, model: FactorMachine, text: str = "text", into: str = "toxicity") -> DataFrame:
    """Add a struct ``into`` with ``score`` and ``predicted`` (1 from a score of a half on).

    All rows and columns stay, repeated rows too; a column named like ``into`` is replaced.
    """
    scored = documents.withColumn(into, F.struct(scores(F.col(text), model).alias("score")))
    predicted = F.when(F.col(f"{into}.score") >= 0.5, 1).otherwise(0)
    return scored.withColumn(into, F.col(into).withField("predicted", predicted))
