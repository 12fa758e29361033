"""Batch enrichment: call a provider for each row, in batches, on many tasks."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.ranks import number_rows

BATCH_ROWS = 50
MAX_RETRIES = 2
CENTER_SCHEMA = "order_center map<string,array<string>>"


# Pause before a call is tried again, doubled each time, and the longest one.
BACK_OFF_SECONDS = 0.05
LONGEST_PAUSE = 5.0


def call_in_batches(
    keys: list, provider: Callable, batch_rows: int = BATCH_ROWS, max_retries: int = MAX_RETRIES
) -> list:
    """Answers for ``keys`` in order; a failed batch is called again as a whole."""
    answers: list = []
    for start in range(0, len(keys), batch_rows):
        batch = keys[start : start + batch_rows]
        for attempt in range(max_retries + 1):
            try:
                done = [provider(key) for key in batch]
                break
            except Exception:
                if attempt == max_retries:
                    raise
        answers.extend(done)
    return answers


def call_side_by_side(
    keys: Iterable,
    provider: Callable,
    in_flight: int = 16,
    max_retries: int = MAX_RETRIES,
    back_off: float = BACK_OFF_SECONDS,
) -> Iterator[tuple[str | None, str | None]]:
    """``(answer, error)`` for each key in order, with at most ``in_flight`` calls going on.

    A call that fails is tried again after a growing pause; one that keeps failing gives its error
    and no answer, and ends nothing else.
    """

    def call(key):
        for attempt in range(max_retries + 1):
            try:
                return provider(key), None
            except Exception as error:
                problem = f"{type(error).__name__}: {error}"
                if attempt < max_retries:
                    time.sleep(min(back_off * 2**attempt, LONGEST_PAUSE))
        return None, problem

    with ThreadPoolExecutor(in_flight) as pool:
        waiting: deque = deque()
        for key in keys:
            if len(waiting) >= in_flight:
                yield waiting.popleft().result()
            waiting.append(pool.submit(call, key))
        while waiting:
            yield waiting.popleft().result()


def enrich(
    df: DataFrame,
    provider: Callable[[int], str],
    key: str = "order_id",
    batch_rows: int = BATCH_ROWS,
    max_retries: int = MAX_RETRIES,
    tasks: int | None = None,
    in_flight: int | None = None,
) -> DataFrame:
    """Add ``order_center`` from the JSON text the provider answers for each key.

    Tasks work side by side on their batches, those of the input by default. With ``tasks`` the
    distinct keys alone are spread evenly, called once each and joined back, for inputs of few splits
    where calls, not bytes, are the cost; the other columns are not moved for it. Only the key
    crosses to Python, in Arrow batches; Spark parses the answers. A call that keeps failing fails
    its task, which Spark runs again.

    With ``in_flight`` a task has so many calls under way at a time, tries each again on its own, and
    a key that keeps failing is a row with its error in ``error`` and no center.
    """
    asked = df.select(F.col(key).alias("_key")).distinct().repartition(tasks) if tasks else df.withColumn("_key", F.col(key))

    fields = ["answer", "error"] if in_flight else ["answer"]

    def answers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            keys = batch.to_pylist()
            if in_flight:
                found = list(call_side_by_side(keys, provider, in_flight, max_retries))
            else:
                found = [(text,) for text in call_in_batches(keys, provider, batch_rows, max_retries)]
            columns = [pa.array([row[k] for row in found], pa.string()) for k in range(len(fields))]
            yield pa.StructArray.from_arrays(columns, fields)

    answer = F.arrow_udf(answers, ", ".join(f"{name} string" for name in fields))
    answered = asked.withColumn("_found", answer(F.col("_key")))
    if tasks:
        answered = df.join(answered, F.col(key).eqNullSafe(F.col("_key")), "left")
    parsed = F.from_json("_found.answer", CENTER_SCHEMA)["order_center"]
    out = answered.withColumn("order_center", parsed)
    if in_flight:
        out = out.withColumn("error", F.col("_found.error"))
    return out.drop("_found", "_key")


def center_name(column: str = "order_center"):
    """The single value inside the nested answer."""
    return F.get(F.try_element_at(F.col(column), F.lit("0")), F.lit(0))


def assign_batches(df: DataFrame, key: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Number the batches of an even split in key order.

    There are ``ceil(n / batch_rows)`` batches whose sizes differ by at most one, the
    larger ones first. ``key`` should be unique.
    """
    numbered = number_rows(df, [key], column="_pos")
    n = numbered.count()
    batches = max(-(-n // batch_rows), 1)
    small, larger = divmod(n, batches)
    edge = larger * (small + 1)
    pos = F.col("_pos")
    batch = F.when(pos < edge, F.floor(pos / (small + 1))).otherwise(
        larger + F.floor((pos - edge) / max(small, 1))
    )
    return numbered.withColumn("batch_no", (batch + 1).cast("int")).drop("_pos")
