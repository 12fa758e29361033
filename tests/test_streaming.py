import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.sources.tables import TableStore
from orderloom.streaming.arrivals import append_arrivals, files_since
from orderloom.streaming.latest import land_by_day, refresh_latest
from orderloom.streaming.windows import run_window_counts, window_counts

SCHEMA = "t timestamp_ntz, k string, value double"
T0 = datetime(2024, 1, 1)


def batch(spark, first, count):
    data = [(T0 + timedelta(hours=first + i), "ab"[i % 2], float(i)) for i in range(count)]
    return spark.createDataFrame(data, SCHEMA)


def test_each_file_arrives_once(spark, tmp_path):
    landing, target, cursor = (str(tmp_path / n) for n in ("landing", "target", "cursor"))
    schema = batch(spark, 0, 1).schema
    assert append_arrivals(spark, landing, schema, target, cursor) is False
    batch(spark, 0, 10).write.parquet(landing)
    assert append_arrivals(spark, landing, schema, target, cursor) is True
    append_arrivals(spark, landing, schema, target, cursor)
    assert spark.read.parquet(target).count() == 10
    batch(spark, 10, 5).write.mode("append").parquet(landing)
    append_arrivals(spark, landing, schema, target, cursor, files_per_batch=1)
    assert spark.read.parquet(target).count() == 15


def test_a_replaced_file_is_seen_again(spark, tmp_path):
    path = tmp_path / "customers.csv"
    schema = spark.sql("select 1 as id").schema
    df, cursor = files_since(spark, str(path), schema, 0, "csv")
    assert (df.count(), cursor) == (0, 0)
    path.write_text("1\n2\n")
    df, cursor = files_since(spark, str(path), schema, cursor, "csv")
    assert df.count() == 2 and cursor > 0
    df, again = files_since(spark, str(path), schema, cursor, "csv")
    assert (df.count(), again) == (0, cursor)
    time.sleep(0.05)
    path.write_text("3\n")
    df, later = files_since(spark, str(path), schema, cursor, "csv")
    assert rows(df) == [(3,)] and later > cursor


@pytest.mark.parametrize("name", ["UTC", "America/New_York"])
def test_closed_stream_windows_equal_the_table(spark, zone, tmp_path, name):
    zone(name)
    landing = str(tmp_path / "landing")
    batch(spark, 0, 50).coalesce(1).write.parquet(landing)
    table = spark.read.parquet(landing)
    settings = {"ts": "t", "key": "k", "width": "6 hours", "lateness": "1 hour"}
    stream = spark.readStream.schema(table.schema).parquet(landing)
    run_window_counts(spark, stream, str(tmp_path / "out"), str(tmp_path / "cursor"), **settings)
    closed = window_counts(table, **settings).where(F.col("window_start") + F.expr("interval 6 hours") <= F.expr("timestamp_ntz'2024-01-03 00:00:00'"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(closed)
    assert closed.count() == 16


def test_only_the_latest_day_is_rebuilt(spark, tmp_path):
    landing, cursor = str(tmp_path / "landing"), str(tmp_path / "cursor")
    store = TableStore(spark, str(tmp_path / "store"))
    schema = batch(spark, 0, 1).schema

    def build(day):
        start = F.col("t").cast("date").cast("timestamp_ntz").alias("t")
        return day.groupBy(start).agg(F.count("*").alias("n"))

    def state():
        return {r["t"].day: r["n"] for r in store.read("a.t").collect()}

    land_by_day(batch(spark, 0, 30), landing, "t")
    refresh_latest(spark, landing, schema, store, "a.t", build, "t", cursor)
    assert state() == {2: 6}
    # Late rows for the first day: the latest day is built again, the first is not.
    land_by_day(batch(spark, 3, 2), landing, "t")
    refresh_latest(spark, landing, schema, store, "a.t", build, "t", cursor)
    assert state() == {2: 6}
    land_by_day(batch(spark, 30, 30), landing, "t")
    refresh_latest(spark, landing, schema, store, "a.t", build, "t", cursor)
    assert state() == {2: 6, 3: 12}


def test_touched_days_are_rebuilt(spark, tmp_path):
    landing, cursor = str(tmp_path / "landing"), str(tmp_path / "cursor")
    store = TableStore(spark, str(tmp_path / "store"))
    schema = batch(spark, 0, 1).schema

    def build(day):
        return day.groupBy(F.date_trunc("day", "t").cast("timestamp_ntz").alias("t")).agg(F.count("*").alias("n"))

    for first, count in ((0, 60), (3, 2), (50, 1)):
        land_by_day(batch(spark, first, count), landing, "t")
        refresh_latest(spark, landing, schema, store, "a.t", build, "t", cursor, days="touched")
    assert {r["t"].day: r["n"] for r in store.read("a.t").collect()} == {1: 26, 2: 24, 3: 13}
