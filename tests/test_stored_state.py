"""Safe replacement of tables, parents of a table, stored versions."""

import json
import re
from datetime import date, datetime
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import versions
from orderloom.sources.file_listing import list_files, partition_versions
from orderloom.sources.ledger import VersionLedger
from orderloom.sources.tables import TableStore
from orderloom.streaming.parents import ParentWatch


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def numbers(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("n"))


def test_a_failed_build_leaves_the_table(spark, store, tmp_path):
    store.replace(numbers(spark, 0, 10), "a.t")
    broken = numbers(spark, 0, 1000).select(F.when(F.col("n") == 999, F.raise_error(F.lit("no"))).otherwise(F.col("n")).alias("n"))
    with pytest.raises(Exception, match="no"):
        store.replace(broken, "a.t")
    assert rows(store.read("a.t")) == [(k,) for k in range(10)]
    assert len(list((tmp_path / "store/a/t").glob("data-*"))) == 1


def test_a_table_is_replaced_from_itself_and_readers_go_on(spark, store):
    store.replace(numbers(spark, 0, 10), "a.t")
    reader = store.read("a.t")
    store.replace(store.read("a.t").where("n >= 5"), "a.t")
    assert store.read("a.t").count() == 5 and reader.count() == 10
    store.replace(store.read("a.t").unionByName(store.read("a.t")), "a.t")
    assert store.read("a.t").count() == 10


def test_old_folders_go(spark, store, tmp_path):
    folder = tmp_path / "store/a/t"
    numbers(spark, 0, 3).write.parquet(str(folder))
    assert store.read("a.t").count() == 3
    for last in range(1, 6):
        store.replace(numbers(spark, 0, last), "a.t")
    assert store.read("a.t").count() == 5
    assert len(list(folder.glob("data-*"))) == 2 and len(list(folder.glob("_published/0*"))) == 2
    assert not list(folder.glob("*.parquet"))


def test_a_pointer_without_text_does_not_count_and_numbers_are_taken_once(spark, store, tmp_path):
    store.replace(numbers(spark, 0, 4), "a.t")
    (tmp_path / "store/a/t/_published/0000000002").write_text("")
    assert store.read("a.t").count() == 4
    store.replace(numbers(spark, 0, 6), "a.t")
    assert store.read("a.t").count() == 6

    def beaten(folder):
        numbers(spark, 0, 1).write.parquet(folder)
        store.replace(numbers(spark, 0, 7), "a.t")

    with pytest.raises(Exception, match="exists"):
        store.publish("a.t", beaten)
    assert store.read("a.t").count() == 7


def test_windows_are_replaced_inside_the_current_folder(spark, store):
    days = spark.createDataFrame([(datetime(2024, 1, d), d) for d in (1, 2, 3)], "ts timestamp_ntz, n int")
    store.replace_window(days, "a.t", "ts")
    store.replace_window(days.where("n = 2").withColumn("n", F.lit(20)), "a.t", "ts", "2024-01-02", "2024-01-03")
    assert sorted(r.n for r in store.read("a.t").collect()) == [1, 3, 20]
    assert store.newest_part("a.t", "part_day") == "2024-01-03"
    store.replace_window(days.where("n = 1"), "a.t", "ts")
    assert [r.n for r in store.read("a.t").collect()] == [1]


def test_listing_opens_no_file(spark, tmp_path):
    """Files that are no Parquet are listed all the same."""
    assert list_files(spark, str(tmp_path / "none")).collect() == []
    for part in ("2024-01-01", "2024-01-02"):
        (tmp_path / f"t/part_day={part}").mkdir(parents=True)
        (tmp_path / f"t/part_day={part}/a.parquet").write_text("not parquet")
    assert list_files(spark, str(tmp_path / "t")).count() == 2
    before = dict(rows(partition_versions(spark, str(tmp_path / "t"), "part_day")))
    (tmp_path / "t/part_day=2024-01-02/b.parquet").write_text("more")
    after = dict(rows(partition_versions(spark, str(tmp_path / "t"), "part_day")))
    assert before["2024-01-01"] == after["2024-01-01"] and before["2024-01-02"] != after["2024-01-02"]


def test_the_latest_day_is_rebuilt_for_any_parent(spark, store):
    def land(name, *days):
        data = spark.createDataFrame([(datetime(2024, 1, d),) for d in days], "ts timestamp_ntz")
        for d in days:
            store.replace_window(data, name, "ts", f"2024-01-{d:02}", f"2024-01-{d + 1:02}")

    watch = ParentWatch(store, "c.child", ["p.a", "p.b"])

    def build(part, parents):
        parts = [store.read(p).where(F.col("part_day") == F.lit(part).cast("date")).select("ts", F.lit(p).alias("p")) for p in parents]
        return reduce(DataFrame.unionByName, parts)

    assert watch.refresh(build, "ts") == ([], False)
    land("p.a", 1, 2)
    states, built = watch.refresh(build, "ts")
    assert built and {s.parent: s.state for s in states} == {"p.a": "updated", "p.b": "missing"}
    assert watch.refresh(build, "ts")[1] is False
    land("p.b", 1)  # not the latest day
    assert watch.refresh(build, "ts")[1] is False
    land("p.b", 2)
    states, built = watch.refresh(build, "ts")
    assert built and {s.parent: s.state for s in states} == {"p.a": "current", "p.b": "updated"}
    assert rows(store.read("c.child").select("p")) == [("p.a",), ("p.b",)]
    land("p.a", 3)
    states, built = watch.refresh(build, "ts")
    assert built and {s.parent: s.state for s in states} == {"p.a": "updated", "p.b": "missing"}
    assert store.read("c.child").where(F.col("part_day") == F.lit(date(2024, 1, 2))).count() == 2
    # A run that fails after the child was written is done again.
    land("p.a", 3)
    watch.store.replace(watch.built().where("part != '2024-01-03'"), watch.ledger)
    assert watch.refresh(build, "ts")[1] is True and watch.refresh(build, "ts")[1] is False


def hashed(spark, texts):
    return versions.content_hashes(spark.createDataFrame(list(texts.items()), "k string, text string"), "k", ["text"])


def test_ledger_over_runs(spark, store):
    ledgers = []

    def ledger():
        ledgers.append(VersionLedger(store, "l.t", "k", buckets=4))
        return ledgers[-1]

    texts = {f"k{n}": "a" for n in range(20)}
    assert ledger().due(hashed(spark, texts)).count() == 0
    ledger().record(hashed(spark, {k: v for k, v in texts.items() if k != "k0"}))
    texts |= {"k0": "b", "k1": "b", "k2": "b", "k99": "b"}
    due = ledger().due(hashed(spark, texts))
    assert sorted(r.k for r in due.collect()) == ["k1", "k2"]  # k0 and k99 were never built
    ledger().record(hashed(spark, {"k1": "b", "k99": "b"}).unionByName(spark.createDataFrame([(None, "x")], "k string, content_hash string")))
    assert sorted(r.k for r in ledger().due(hashed(spark, texts)).collect()) == ["k2"]
    assert ledger().read().count() == 20 and VersionLedger(store, "l.t", "k", buckets=99).buckets == 4
    for held in ledgers:
        held.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ledger_")]
    assert ledger().read().count() == 20


def test_the_ledger_is_not_shuffled(spark, store):
    ledger = VersionLedger(store, "l.plan", "k", buckets=4)
    ledger.record(hashed(spark, {f"k{n}": "a" for n in range(50)}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan = ledger.due(hashed(spark, {"k1": "b"}))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)
    left = plan[: plan.index("FileScan")]
    assert "Exchange" not in left and len(re.findall("Exchange", plan)) == 1, plan
    assert json.dumps("4 out of 4")[1:-1] in plan
