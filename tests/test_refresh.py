import json
import uuid
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.plans import queries_sources, refresh
from orderloom.schemas import RAW_LOCATIONS
from orderloom.session import side_by_side
from orderloom.sources.order_views import OrderViews
from orderloom.sources.tables import TableStore

DAY0 = datetime(2023, 5, 25)


def pages(spark, days):
    """Ten orders and ten users per day, as the source serves them."""
    orders, users = [], []
    for d in range(days):
        day = DAY0 + timedelta(days=d)
        ms = int((day - datetime(1970, 1, 1)).total_seconds() * 1000)
        at = {str(i): i for i in range(10)}
        orders.append((day, json.dumps({
            "user_id": {k: (i * 7 + d) % 12 for k, i in at.items()},
            "order_id": {k: f"{d}-{i}" for k, i in at.items()},
            "quantity": {k: i % 4 + d for k, i in at.items()},
            "purchase_price": {k: 1.5 * i for k, i in at.items()},
            "sku": {k: f"sku{i % 3}" for k, i in at.items()},
            "dt": {k: ms + i * 3_600_000 for k, i in at.items()},
        })))
        users.append((day, json.dumps({
            "user_id": at,
            "company": {k: ["FoodCo", "ShopMart", "SportTime", "FamilyLtd"][i % 4] for k, i in at.items()},
            "is_test_user": {k: i == 9 for k, i in at.items()},
            "created_at": {k: ms for k in at},
        })))
    schema = "part_start timestamp_ntz, payload string"
    return spark.createDataFrame(orders, schema), spark.createDataFrame(users, schema)


@pytest.fixture
def store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    places = [(i, f"street {i}", "NY", "US", "10000", 1) for i in range(6)]
    store.replace(spark.createDataFrame(places, RAW_LOCATIONS), refresh.LOCATIONS)
    return store


def test_load_refresh_forecast_and_check(spark, store):
    orders, users = pages(spark, 4)
    refresh.ingest_window(store, orders, users, "2023-05-25", "2023-05-28")
    # Three days in one run: thirty orders, each on its own day.
    assert store.read(refresh.ORDERS).count() == 30
    assert dict(store.read(refresh.ORDERS).groupBy(F.dayofmonth("dt")).count().collect()) == {25: 10, 26: 10, 27: 10}
    refresh.refresh_models(store)
    joined = store.read(refresh.ORDERS_AUGMENTED)
    assert store.read(refresh.COMPANY_PERF).agg(F.sum("n_orders")).first()[0] == joined.count() > 30
    before = {t: rows(store.read(t)) for t in (refresh.ORDERS_AUGMENTED, refresh.ORDER_STATS, refresh.TOP_USERS)}
    refresh.ingest_window(store, orders, users, "2023-05-25", "2023-05-28")
    refresh.refresh_models(store)
    assert {t: rows(store.read(t)) for t in before} == before

    # A further day: dated tables gain it, their other days stay as they were.
    refresh.ingest_window(store, orders, users, "2023-05-28", "2023-05-29")
    refresh.refresh_models(store, "2023-05-28", "2023-05-29")
    assert store.read(refresh.ORDERS_CLEANED).count() == 40
    kept = store.read(refresh.ORDER_STATS).where("order_date < '2023-05-28'")
    assert rows(kept) == before[refresh.ORDER_STATS]
    assert store.read(refresh.WEEKLY_SUMMARY).count() == 4

    model = refresh.run_forecast(store)
    assert refresh.load_model(store) == model
    assert store.read(refresh.PREDICTED).count() == 31 == store.read(refresh.ALL_ORDERS).count()
    assert store.read(refresh.MODEL_STATS).count() == 1
    assert refresh.publish_products(store).select("sku").distinct().count() == 3

    checks = {r["check"]: r["passed"] for r in refresh.run_checks(store).collect()}
    assert checks["orders_cleaned.user_id not null"] is True
    assert checks["order_total above zero"] is False
    assert checks["check_users"] is False


def test_enrichment_job(spark, store):
    rows_in = spark.range(20).withColumnRenamed("id", "order_id")
    out = refresh.run_enrichment(store, rows_in, lambda key: '{"order_center": {"0": ["albany"]}}', tasks=2)
    assert out.count() == 20 and out.first()["order_center"] == {"0": ["albany"]}


class CountingStore(TableStore):
    """Remembers how many stages the last write of each dated table took."""

    stages: dict[str, int] = {}

    def publish(self, table, write, tag=""):
        context, group = self.spark.sparkContext, uuid.uuid4().hex
        context.setJobGroup(group, table)
        try:
            super().publish(table, write, tag)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        tracker = context.statusTracker()
        jobs = tracker.getJobIdsForGroup(group)
        self.stages[table] = len({stage for job in jobs for stage in tracker.getJobInfo(job).stageIds})


def test_row_by_row_tables_are_written_without_a_shuffle(spark, tmp_path):
    store = CountingStore(spark, str(tmp_path))
    orders, users = pages(spark, 40)
    places = [(i, f"street {i}", "NY", "US", "10000", 1) for i in range(6)]
    store.replace(spark.createDataFrame(places, RAW_LOCATIONS), refresh.LOCATIONS)
    refresh.ingest_window(store, orders, users, "2023-05-25", "2023-07-04")
    raw = store.read_window(refresh.ORDERS)
    undated = raw.limit(1).withColumn("dt", F.lit(None).cast("timestamp_ntz"))
    for grain in ("month", "day"):
        # Stored by the partitions of the models, and by others.
        store.replace_window(raw.unionAll(undated).localCheckpoint(), refresh.ORDERS, "dt", grain="month")
        refresh.refresh_models(store, grain=grain)
        assert store.stages[refresh.ORDERS_CLEANED] == store.stages[refresh.ORDERS_AGGREGATED] == 1
        cleaned = store.read(refresh.ORDERS_CLEANED)
        assert cleaned.count() == 401 and cleaned.columns[8:] == [f"part_{grain}"]
        assert rows(store.read(refresh.ORDERS_AGGREGATED)) == rows(cleaned)
        day = F.col("dt").cast("date")
        wrong = ~F.col(f"part_{grain}").eqNullSafe(day if grain == "day" else F.trunc(day, grain))
        assert cleaned.where(wrong).count() == 0
        assert store.read_window(refresh.ORDERS_CLEANED, grain="year").columns == cleaned.columns[:8]


def test_rebuild_takes_orders_out_of_the_stored_table(spark, monkeypatch):
    """The star tables are joined once; the second build begins with what is stored."""
    joined, whole = [], OrderViews.raw_orders
    monkeypatch.setattr(OrderViews, "raw_orders", lambda self, sku=True: joined.append(1) or whole(self, sku))
    got = queries_sources.refresh_rebuild(spark, "/root/testdata/sf0.001")
    last = got.agg(F.max("order_date")).first()[0]
    assert len(joined) == 1 and last < datetime(1998, 1, 1)


def test_models_load_raw_tables_at_once(spark, monkeypatch):
    batches = []

    def noted(session, *steps):
        batches.append(len(steps))
        side_by_side(session, *steps)

    monkeypatch.setattr(queries_sources, "side_by_side", noted)
    assert queries_sources.refresh_models(spark, "/root/testdata/sf0.001").count() == 13
    assert batches == [3]


def test_side_by_side_ends_all_steps_and_raises(spark):
    done = []

    def fails():
        raise ValueError("one")

    with pytest.raises(ValueError, match="one"):
        side_by_side(spark, fails, lambda: done.append(spark.range(5).count()))
    assert done == [5]
