"""Late usage records, gap quantiles, file cursors, calls under way, JSON documents, schema history, row order."""

import json
import random
import threading
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

import orderloom
from orderloom.operators import enrichment, freshness, listing, quality, regression
from orderloom.operators.usage import usage_hourly
from orderloom.streaming.arrivals import FileCursor, files_since
from orderloom.streaming.usage import run_usage, usage_so_far

cloudpickle.register_pickle_by_value(orderloom)
T0 = datetime(2024, 1, 1)
HISTORY = "query_id string, query_text string, start_time timestamp_ntz, credits double"


def record(key, minutes, model="m"):
    return (f"q{key}", f"select 1 /* opaque_id[[[{model}:{key}]]] */", T0 + timedelta(minutes=minutes), 1.0)


def test_late_and_repeated_records_equal_the_table(spark, tmp_path):
    first = [record(k, k) for k in range(0, 600, 2)] + [record(0, 0), record(590, 590)]
    second = [record(k, k) for k in range(481, 700, 2)] + [record(k, k) for k in range(500, 560, 2)] + [("x", "no comment", T0, 9.0)]
    landing, target, cursor = (str(tmp_path / n) for n in ("landing", "target", "cursor"))
    for arrival in (first, second):
        spark.createDataFrame(arrival, HISTORY).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(HISTORY).parquet(landing)
        run_usage(spark, stream, target, cursor, "query_id", lateness="2 hours")
    found = usage_so_far(spark, target)
    whole = spark.createDataFrame([*first, *second], HISTORY).dropDuplicates(["query_id"])
    assert rows(found.drop("n_batches")) == rows(usage_hourly(whole, "2024-01-03 00:00:00"))
    assert {r.hour.hour: r.n_batches for r in found.collect()}[9] == 2
    run_usage(spark, spark.readStream.schema(HISTORY).parquet(landing), target, cursor, "query_id", lateness="2 hours")
    assert rows(usage_so_far(spark, target)) == rows(found)


@pytest.mark.parametrize("n, share", [(2, 0.99), (60, 0.9), (3000, 0.99), (30_000, 0.99)])
def test_gap_quantiles(spark, n, share):
    draw = random.Random(n)
    times, at = [], 0
    for _ in range(n):
        times.append(at)
        at += draw.choice([1, 5, 60, 3600]) * draw.randrange(1, 50)
    data = [("a", T0 + timedelta(seconds=t)) for t in times] + [("a", T0), ("one", T0), (None, None)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz").repartition(5)
    found = freshness.gap_quantile(df, "k", "ts", share).collect()
    gaps = np.diff(sorted(times))
    assert [(r.k, r.n_gaps, r.last_gap) for r in found] == [("a", n - 1, gaps[-1])]
    rank = (gaps <= found[0].limit_gap).mean(), (gaps < found[0].limit_gap).mean()
    assert rank[0] >= share - 0.004 and rank[1] <= share + 0.004
    if n < 4096:
        assert found[0].limit_gap == np.sort(gaps)[int(np.ceil(round(share * (n - 1), 6))) - 1]
    assert found[0].anomalous == (gaps[-1] > found[0].limit_gap)


def test_two_files_of_one_moment_are_read_once_each(spark, tmp_path):
    import os

    schema, cursor = spark.sql("select 1 as id").schema, 0
    seen = []
    for name, moment in (("a", 1000), ("b", 1000), ("c", 2000), ("a", 2000)):
        (tmp_path / f"{name}.csv").write_text(f"{len(seen)}\n")
        os.utime(tmp_path / f"{name}.csv", (moment, moment))
        df, cursor = files_since(spark, str(tmp_path), schema, FileCursor.from_json(cursor.to_json()) if seen else 0, "csv")
        seen.append(rows(df))
        again, same = files_since(spark, str(tmp_path), schema, cursor, "csv")
        assert again.count() == 0 and same == cursor
    assert seen == [[(0,)], [(1,)], [(2,)], [(3,)]]


def test_calls_under_way_are_bounded_and_failures_stay_rows():
    now, most, lock = [0], [0], threading.Lock()

    def slow(key):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        if key % 10 == 3:
            raise TimeoutError(f"key {key}")
        return f"<{key}>"

    began = time.perf_counter()
    found = list(enrichment.call_side_by_side(range(100), slow, in_flight=8, max_retries=1, back_off=0.001))
    assert time.perf_counter() - began < 0.8 * 110 * 0.01 and 2 <= most[0] <= 8
    assert found == [(None, f"TimeoutError: key {k}") if k % 10 == 3 else (f"<{k}>", None) for k in range(100)]


def test_a_call_is_tried_again_with_growing_pauses():
    times = []

    def shaky(key):
        times.append(time.perf_counter())
        if len(times) < 4:
            raise ConnectionError
        return "ok"

    assert list(enrichment.call_side_by_side([1], shaky, max_retries=3, back_off=0.02)) == [("ok", None)]
    pauses = np.diff(times)
    assert pauses[0] >= 0.02 and pauses[1] >= 0.04 and pauses[2] >= 0.08


def test_failing_keys_are_rows_and_spread_keys_are_joined_back(spark):
    def provider(key):
        if key is None or key % 5 == 0:
            raise LookupError("unknown")
        return json.dumps({"order_center": {"0": [f"c{key}"]}})

    df = spark.range(40).select(F.when(F.col("id") % 20 < 19, F.col("id") % 20).alias("order_id"), "id")
    for tasks in (None, 3):
        out = enrichment.enrich(df, provider, max_retries=0, tasks=tasks, in_flight=4)
        assert out.columns == ["order_id", "id", "order_center", "error"] and out.count() == 40
        assert out.where("error is null").count() == 30
        assert out.where("error is not null and order_center is not null").count() == 0
    plan = enrichment.enrich(df, provider)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def listing_rows(spark, data):
    return spark.createDataFrame(data, "location string, repository string, asset_key string")


def expected_document(data):
    out, grouped = {}, {}
    for location, repository, key in sorted(data):
        grouped.setdefault((location, repository), []).append(key)
    for (location, repository), keys in sorted(grouped.items()):
        out[location if repository == "__repository__" else f"{location}/{repository}"] = keys
    return json.dumps(out, indent=2)


@pytest.mark.parametrize("seed", range(3))
def test_written_document_is_the_json_object(spark, tmp_path, seed):
    """A group larger than a partition, clashing names, characters to escape."""
    draw = random.Random(seed)
    data = [("big", "r", f"key/{k:05}") for k in range(3000 if seed == 0 else 3)]
    data += [(draw.choice("ab"), draw.choice(["r", "s", "__repository__"]), f'"k\\{k}"') for k in range(seed * 9)]
    data += [("a/r", "__repository__", "late")] * seed
    path = str(tmp_path / "doc")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        listing.write_json_document(listing_rows(spark, data).repartition(7), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(p for p in (tmp_path / "doc").iterdir() if p.name.startswith("part-"))
    text = "".join(p.read_text() for p in files)
    assert text.rstrip("\n") == expected_document(data)
    assert seed or len(files) > 1
    assert list(json.loads(text)) == list(json.loads(expected_document(data)))


def test_document_without_keys(spark, tmp_path):
    listing.write_json_document(listing_rows(spark, []), str(tmp_path / "doc"))
    assert json.loads("".join(p.read_text() for p in (tmp_path / "doc").glob("part-*"))) == {}


def test_rejected_documents_keep_their_columns(spark):
    good = '[{"assetKey":{"path":["a"]}}]'
    data = [(1, good), (2, None), (3, "{"), (4, '{"assetKey":1}'), (5, "[]"), (6, "[1]"), (7, "text"), (8, "")]
    df = spark.createDataFrame(data, "n int, document string")
    assert [r.n for r in listing.rejected_documents(df).orderBy("n").collect()] == [2, 3, 4, 6, 7, 8]
    assert listing.from_documents(df.where("n in (1, 5)")).count() == 1


def test_paths_of_nested_types():
    schema = T._parse_datatype_string("a int, b struct<c:array<struct<d:map<string,array<int>>>>>")
    assert quality.column_paths(schema) == [
        ("a", "int"), ("b", "struct"), ("b.c", "array"), ("b.c.element", "struct"), ("b.c.element.d", "map"),
        ("b.c.element.d.key", "string"), ("b.c.element.d.value", "array"), ("b.c.element.d.value.element", "int"),
    ]


def test_history_over_builds(spark):
    data = [(b, "a", "int") for b in (1, 3, 7, 9)] + [(1, "b", "int"), (7, "b", "int"), (9, "b", "string")]
    found = quality.schema_history(spark.createDataFrame(data, "build int, column_path string, type string"))
    assert rows(found.select("column_path", "type", "valid_from", "valid_to")) == rows(
        spark.createDataFrame(
            [("a", "int", 1, None), ("b", "int", 1, 3), ("b", "int", 7, 9), ("b", "string", 9, None)],
            "a string, b string, c int, d int",
        )
    )
    assert quality.schema_history(spark.createDataFrame([], "build int, column_path string, type string")).count() == 0


def test_texts_in_the_order_of_rows(spark, tmp_path):
    draw = random.Random(2)
    data = [(draw.choice("ab"), draw.choice(["z", "y", None, "x"]), k) for k in range(200)]
    for at in range(0, 200, 50):
        spark.createDataFrame(data[at : at + 50], "k string, t string, n int").coalesce(1).write.mode("append").parquet(str(tmp_path / f"f{at:03}"))
    files = spark.read.parquet(*(str(tmp_path / f"f{at:03}") for at in range(0, 200, 50)))
    names = {r[0]: r[1] for r in files.groupBy("_metadata.file_name").agg(F.min("n")).collect()}
    inside = [row for name in sorted(names) for row in data[names[name] : names[name] + 50]]
    found = regression.text_parts_in_row_order(files, "k").orderBy("k", "position").collect()
    for key in "ab":
        assert [r.part for r in found if r.k == key] == [t for k, t, _ in inside if k == key and t is not None]
