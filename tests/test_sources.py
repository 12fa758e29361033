import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import session
from orderloom.schemas import LOCATIONS_FILE, RAW_USERS
from orderloom.sources import files, html_tables, payloads
from orderloom.sources.tables import TableStore

DAY = 86_400_000


def test_payload_rows_follow_all_index_keys(spark):
    doc = {
        "user_id": {"0": 0, "1": 1},
        "company": {"0": "FoodCo", "1": "ShopMart", "2": "SportTime"},
        "is_test_user": {"0": False, "2": True},
        "created_at": {"0": 1684972800000, "1": 1684972800123},
    }
    df = spark.createDataFrame([(7, json.dumps(doc)), (8, "{bad"), (9, "{}"), (10, None)], "page int, payload string")
    got = rows(payloads.decode(df, RAW_USERS))
    day = datetime(2023, 5, 25)
    assert got == [
        (7, 0, 0, "FoodCo", False, day),
        (7, 1, 1, "ShopMart", None, day.replace(microsecond=123000)),
        (7, 2, None, "SportTime", True, None),
    ]
    assert [r[0] for r in rows(payloads.rejected(df, RAW_USERS))] == [10, 8, 9]


def test_encode_and_decode_are_inverse(spark):
    users = spark.createDataFrame(
        [(i, f"c{i % 3}", i % 2 == 0, datetime(2023, 5, 25 + i % 5, i)) for i in range(20)], RAW_USERS
    )
    paged = users.withColumn("page", (F.col("user_id") / 8).cast("int")).withColumn("position", F.col("user_id") % 8)
    packed = payloads.encode(paged, ["page"], "position", RAW_USERS.names)
    assert packed.count() == 3
    assert rows(payloads.decode(packed, RAW_USERS).select(*RAW_USERS.names)) == rows(users)


PAGES = {
    1: "<p>x</p><table><tr><th>a</th><th>b</th></tr><tr><td>1 &amp; 2</td><td><b>x</b> <i>y</i><br>z</td></tr></table>"
    "<table><tr><td>second</td></tr></table>",
    2: "<p>no rows here</p>",
    3: "<table><thead><tr><td>h</td></tr></thead><tbody><tr><td colspan=2>w</td><td rowspan='2'>r</td></tr>"
    "<tr><td>p<td>q</tr></tbody></table>",
    4: "<table><tr><td>outer<table><tr><td>inner</td></tr></table></td><td>n</td></tr></table>",
    5: "<table><tr><td>open<script>var t='<td>no</td>';</script></td><td>end",
    6: "",
    7: None,
    8: "<table></table><table><tr><td>late</td></tr></table>",
}


def test_first_table_of_each_page(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "page_id long, html string")
    got = {(r.page_id, r.row_no): (r.is_header, list(r.cells)) for r in html_tables.table_rows(pages).collect()}
    assert got == {
        (1, 0): (True, ["a", "b"]),
        (1, 1): (False, ["1 & 2", "x y z"]),
        (3, 0): (True, ["h"]),
        (3, 1): (False, ["w", "w", "r"]),
        (3, 2): (False, ["p", "q", "r"]),
        (4, 0): (False, ["outerinner", "n"]),
        (5, 0): (False, ["open", "end"]),
        (8, 0): (False, ["late"]),
    }


def test_all_tables_and_positions(spark):
    pages = spark.createDataFrame(list(PAGES.items()), "page_id long, html string")
    every = html_tables.table_rows(pages, first_only=False)
    assert rows(every.where("table_no = 1").select("page_id", F.col("cells")[0])) == [(1, "second")]
    named = html_tables.positional(html_tables.table_rows(pages).where("page_id = 3"), ["a", "b", "c", "d"])
    assert rows(named) == [(3, 1, "w", "w", "r", None), (3, 2, "p", "q", "r", None)]


def test_csv_scan_infers_types(spark, tmp_path):
    spark.range(1, 524).withColumnRenamed("id", "order_id").write.option("header", True).csv(str(tmp_path / "c"))
    df = files.scan_csv(spark, str(tmp_path / "c"))
    assert df.count() == 523
    assert isinstance(df.schema["order_id"].dataType, (T.IntegerType, T.LongType))


def test_full_refresh_replaces_and_reports(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for count, epoch in ((5, 100), (3, 200)):
        path = str(tmp_path / f"csv{count}")
        one = spark.range(count).select(F.col("id").alias("l_user_id"), *[F.lit("v").alias(c) for c in LOCATIONS_FILE.names[1:]])
        one.write.option("header", True).csv(path)
        stored, report = files.full_refresh(store, path, LOCATIONS_FILE, "raw_data.locations", epoch)
    assert (stored.count(), stored.select("_sling_loaded_at").distinct().first()[0]) == (3, 200)
    row = report.first()
    assert (row["table_name"], row["n_rows"], row["n_columns"]) == ("raw_data.locations", 3, 6)
    assert "_sling_loaded_at:int" in row["columns"]


@pytest.fixture
def days(spark):
    return spark.createDataFrame(
        [(d, h, datetime(2024, 1, d, h)) for d in (1, 2, 3, 4) for h in (0, 12, 23)], "d int, h int, t timestamp_ntz"
    )


def test_window_replace_touches_its_days_only(spark, tmp_path, days):
    store = TableStore(spark, str(tmp_path))
    store.replace_window(days, "s.t", "t")
    late = days.where("d <> 3").withColumn("h", F.col("h") + 100)
    for _ in range(2):
        got = store.replace_window(late, "s.t", "t", "2024-01-02", "2024-01-04")
        counts = {r[0]: (r[1], r[2]) for r in got.groupBy("d").agg(F.count("*"), F.max("h")).collect()}
        # Day 3 lies in the window and got no row, day 4 starts on its open end.
        assert counts == {1: (3, 23), 2: (3, 123), 4: (3, 23)}
    assert store.read_window("s.t", "2024-01-02", "2024-01-03").columns == ["d", "h", "t"]
    assert store.read_window("s.t", "2024-01-02", "2024-01-03").count() == 3


def test_range_backfill_equals_single_days(spark, tmp_path, days):
    store = TableStore(spark, str(tmp_path))
    whole = rows(store.replace_window(days, "a.whole", "t", "2024-01-01", "2024-01-05"))
    for d in (1, 2, 3, 4):
        single = store.replace_window(days, "a.single", "t", f"2024-01-0{d}", f"2024-01-0{d + 1}")
    assert rows(single) == whole


def test_a_window_without_rows_gives_an_empty_table(spark, tmp_path, days):
    store = TableStore(spark, str(tmp_path))
    got = store.replace_window(days, "s.none", "t", "2030-01-01", "2030-01-02")
    assert got.count() == 0 and got.columns == ["d", "h", "t", "part_day"]
    assert store.replace_window(days, "s.none", "t", "2024-01-01", "2024-01-02").count() == 3


def test_windows_prune_partitions(spark, tmp_path, days):
    store = TableStore(spark, str(tmp_path))
    store.replace_window(days, "s.t", "t")
    plan = store.read_window("s.t", "2024-01-02", "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_day" in plan


def test_one_folder_per_key(spark, tmp_path, days):
    store = TableStore.for_environment(spark, "BRANCH", {"LOCAL": "/nowhere", "BRANCH": str(tmp_path)})
    store.replace_by_key(days, "m.k", "d")
    store.replace_by_key(days.where("d = 2").limit(1), "m.k", "d")
    got = dict(store.read("m.k").groupBy("d").count().collect())
    assert got == {1: 3, 2: 1, 3: 3, 4: 3}
    assert store.exists("m.k") and not store.exists("m.other")


def test_a_full_rebuild_leaves_nothing_behind(spark, tmp_path, days):
    store = TableStore(spark, str(tmp_path))
    store.replace_window(days, "s.t", "t")
    assert store.replace_window(days.where("d = 2"), "s.t", "t").select("d").distinct().count() == 1
    empty = store.replace_window(days.limit(0), "s.t", "t")
    assert empty.count() == 0 and empty.columns == ["d", "h", "t", "part_day"]


@pytest.mark.parametrize("ends, grain", [
    (("2024-01-01", "2024-01-08"), "month"), (("2024-02-01", "2025-01-01"), "year"),
    (("2024-01-01 06:00:00", "2024-01-02"), "day"),
])
def test_windows_that_cut_a_partition_are_refused(spark, tmp_path, days, ends, grain):
    store = TableStore(spark, str(tmp_path))
    store.replace_window(days, "s.t", "t", grain=grain)
    with pytest.raises(ValueError, match="not the beginning"):
        store.replace_window(days.limit(0), "s.t", "t", *ends, grain=grain)
    assert store.read("s.t").count() == days.count()


def test_keys_keep_their_spelling(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    df = spark.createDataFrame([("007", 1), ("7", 2), ("true", 3), ("2024-01-01", 4), (None, 5)], "sku string, n int")
    assert rows(store.replace_by_key(df, "m.k", "sku").select("sku", "n")) == rows(df)
    store.replace_by_key(spark.createDataFrame([("007", 9)], "sku string, n int"), "m.k", "sku")
    assert rows(store.read_key("m.k", "sku", "007").select("sku", "n")) == [("007", 9)]
    assert rows(store.read_key("m.k", "sku", "7").select("sku", "n")) == [("7", 2)]
    plan = store.read_key("m.k", "sku", "7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_key" in plan


def test_one_bad_value_empties_one_cell(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.BooleanType()), T.StructField("t", T.TimestampNTZType())])
    pages = [
        (1, '{"a":{"0":1,"1":"x","2":3.0,"3":1.5,"k":4},"b":{"0":true,"1":"yes"},"t":{"0":"soon","1":0}}'),
        (2, '{"a":{"0":1}} and more'), (3, '{"a":{"0":1}},{"a":{"0":2}}'), (4, '{"a":{"0":99999999999999999999}}'), (5, '[{"a":{"0":1}}]'),
    ]
    df = spark.createDataFrame(pages, "page int, payload string")
    got = {(r.page, r.row_index): (r.a, r.b, r.t) for r in payloads.decode(df, schema).collect()}
    assert got == {
        (1, 0): (1, True, None), (1, 1): (None, None, datetime(1970, 1, 1)), (1, 2): (3, None, None), (1, 3): (None, None, None),
        (1, None): (4, None, None), (4, 0): (None, None, None),
    }
    assert rows(payloads.bad_values(df, schema)) == [
        (1, 0, "t", "soon"), (1, 1, "a", "x"), (1, 1, "b", "yes"), (1, 3, "a", "1.5"), (4, 0, "a", "99999999999999999999"),
    ]
    assert [r[0] for r in rows(payloads.rejected(df, schema))] == [2, 3, 5]


def test_odd_spans_do_not_stop_the_job(spark):
    cells = {
        1: "<td colspan='\u00b2'>x</td>", 2: "<td colspan=1000000000>x</td>", 3: "<td colspan=-3>x</td><td colspan='two'>y</td>",
        4: f"<td colspan={'9' * 5000}>x</td>", 5: "<td rowspan=0>x</td><td>y</td></tr><tr><td>z</td></tr><tr><td>w</td>",
    }
    pages = spark.createDataFrame([(k, f"<table><tr>{c}</tr></table>") for k, c in cells.items()], "page_id long, html string")
    got = {}
    for r in html_tables.table_rows(pages).orderBy("page_id", "row_no").collect():
        assert r.error is None
        got.setdefault(r.page_id, []).append(list(r.cells))
    assert got[1] == [["x"]] and got[3] == [["x", "y"]]
    assert len(got[2][0]) == len(got[4][0]) == 1000
    assert got[5] == [["x", "y"], ["x", "z"], ["x", "w"]]


def test_a_page_that_fails_is_a_row(spark, monkeypatch):
    def fail(html, first_only):
        raise ValueError("odd page")

    monkeypatch.setattr(html_tables, "_read_tables", fail)
    pages = spark.createDataFrame([(1, "<table><tr><td>x</td></tr></table>")], "page_id long, html string")
    out = html_tables.table_rows(pages)
    assert out.collect()[0].error == "ValueError: odd page"
    assert html_tables.positional(out, ["a"]).count() == 0


class Settings:
    """A session of which only settings are asked."""

    def __init__(self, **settings):
        self.conf, self.settings = self, {k.replace("_", "."): v for k, v in settings.items()}
        self.sparkContext = self
        self.applicationId = "app-1"

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_lies_in_shared_folders(spark, tmp_path, monkeypatch):
    shared = {"spark_checkpoint_dir": "s3a://b/tmp/", "spark_sql_warehouse_dir": "s3a://b/w"}
    assert session.scratch_root(Settings(**shared)) == "s3a://b/tmp/orderloom/app-1"
    del shared["spark_checkpoint_dir"]
    assert session.scratch_root(Settings(**shared)) == "s3a://b/w/orderloom/app-1"
    monkeypatch.setattr(session, "scratch_root", lambda _: f"{tmp_path}/orderloom/app")
    assert session.materialise(spark.range(3), "t").count() == 3
    assert len(list(tmp_path.glob("orderloom/app/t-*"))) == 1
    session.clear_scratch(spark)
    assert list(tmp_path.glob("orderloom/*")) == []
