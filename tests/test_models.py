from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.functions import joins
from orderloom.operators import augment, cleaned, stats, windows
from orderloom.schemas import RAW_LOCATIONS, RAW_ORDERS, RAW_USERS

D1, D2 = datetime(2023, 5, 25, 10), datetime(2023, 5, 26, 0)


@pytest.fixture
def raw(spark):
    orders = spark.createDataFrame(
        [
            (1, "a", 2, 10.0, "s1", D1),
            (1, "b", 1, 5.0, "s2", D2),
            (2, "c", 0, 7.0, "s1", D1),
            (3, "d", 4, None, "s1", D2),
            (9, "e", 3, 2.0, "s3", D1),
            (4, "f", 1, 1.0, "s3", D1),
        ],
        RAW_ORDERS,
    )
    users = spark.createDataFrame(
        [
            (1, "FoodCo", False, D1),
            (1, "FoodCo", False, D2),
            (2, "ShopMart", False, D1),
            (3, "FoodCo", None, D1),
            (4, "FoodCo", True, D1),
        ],
        RAW_USERS,
    )
    locations = spark.createDataFrame(
        [(1, "x", "NY", "US", "00001", 1), (2, "y", "CA", "US", "00002", 1), (2, "z", "WA", "US", "00003", 1), (7, "w", "TX", "US", "00004", 1)],
        RAW_LOCATIONS,
    )
    return cleaned.orders_cleaned(orders), cleaned.users_cleaned(users), cleaned.locations_cleaned(locations)


def test_unknown_and_test_flags_are_dropped(raw):
    assert [r[0] for r in rows(raw[1].select("user_id"))] == [1, 1, 2]


def test_orders_keep_their_columns(raw):
    assert raw[0].columns == "user_id quantity purchase_price sku dt dt_2 order_date order_total".split()
    assert dict(raw[0].select("sku", "order_total").where("user_id = 2").collect()) == {"s1": 0.0}
    assert rows(cleaned.orders_aggregated(raw[0])) == rows(raw[0])


def test_both_join_plans_agree_and_fan_out(raw):
    small = augment.orders_augmented(*raw)
    large = augment.orders_augmented(*raw, broadcast_limit=-1)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    # User 1 is listed twice, user 2 has two places, 3, 4 and 9 have neither.
    assert [r[0] for r in rows(small.select("user_id"))] == [1, 1, 1, 1, 2, 2, 3, 4, 9]
    missing = small.where("user_id in (3, 4, 9)").select("company", "state", "zip_code").distinct()
    assert rows(missing) == [(None, None, None)]


def test_one_join_reads_orders_when_sides_are_large(raw, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = augment.orders_augmented(*raw, broadcast_limit=-1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FullOuter") == 1 and plan.count("LeftOuter") == 1


def test_a_hot_user_changes_no_result(spark):
    orders = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("user_id"),
        F.lit(2).alias("quantity"),
        F.lit(1.5).alias("purchase_price"),
        F.lit("s").alias("sku"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 40 as int))").alias("dt"),
    )
    orders = cleaned.orders_cleaned(orders)
    users = spark.range(0, 60, 2).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("id") % 4 == 0, "A").otherwise("B").alias("company"),
    )
    places = users.select("user_id", F.lit("NY").alias("state"), F.lit("0").alias("zip_code"))
    small = augment.orders_augmented(orders, users, places)
    large = augment.orders_augmented(orders, users, places, broadcast_limit=-1)
    assert small.count() == large.count() > 300_000
    assert rows(stats.company_stats(small)) == rows(stats.company_stats(large))
    perf = stats.company_perf(stats.company_stats(small))
    near = rows(stats.top_users_from_orders(orders, users, places).select("user_id", F.round("pct_revenue", 9)))
    assert near == rows(stats.top_users(large, perf).select("user_id", F.round("pct_revenue", 9)))


def test_statistics_agree_with_each_other(raw):
    joined = augment.orders_augmented(*raw)
    total = joined.count()
    by_company = stats.company_stats(joined)
    perf = stats.company_perf(by_company)
    for table in (by_company, stats.sku_stats(joined), stats.order_stats(joined), perf):
        assert table.agg(F.sum("n_orders")).first()[0] == total
    assert perf.where("company is null").count() == 1
    assert perf.agg(F.sum("total_revenue")).first()[0] == joined.agg(F.sum("order_total")).first()[0]
    assert rows(stats.min_order(perf)) == [(2,)]


def test_shares_from_orders_equal_shares_from_joined(raw):
    joined = augment.orders_augmented(*raw)
    perf = stats.company_perf(stats.company_stats(joined))
    expected = rows(stats.top_users(joined, perf))
    assert rows(stats.top_users_from_orders(*raw)) == expected
    by_user = {r[0]: r[1:] for r in expected}
    assert by_user[1] == (50.0, 1.0)
    # A company without revenue and a user without company give no share.
    assert by_user[2] == (0.0, None)
    assert by_user[9] == (6.0, None)
    assert by_user[3] == (None, None)


def test_average_of_an_empty_company_is_null(spark):
    perf = spark.createDataFrame([("a", 0, 1.0), ("b", 2, 5.0)], "company string, n_orders long, total_revenue double")
    assert rows(stats.avg_orders(perf)) == [("a", None), ("b", 2.5)]


def test_window_ends(raw):
    orders = raw[0]
    closed = windows.in_window(orders, "dt", "2023-05-25", "2023-05-26")
    half = windows.in_window(orders, "dt", "2023-05-25", "2023-05-26", closed="left")
    assert (closed.count(), half.count()) == (6, 4)
    with pytest.raises(ValueError):
        windows.in_window(orders, "dt", "2023-05-25", "2023-05-26", closed="right")


def test_capacity_is_inclusive(spark):
    days = spark.createDataFrame([(D1, 49.9), (D1, 50.0), (D2, 51.0)], "order_date timestamp_ntz, num_orders double")
    assert [r[1] for r in rows(stats.big_orders(days))] == [50.0, 51.0]


def test_item_filter_reaches_the_partitions(spark, raw, tmp_path):
    stats.sku_stats(augment.orders_augmented(*raw)).write.partitionBy("sku").parquet(str(tmp_path / "t"))
    one = stats.key_product_deepdive(spark.read.parquet(str(tmp_path / "t")), "s1")
    assert "PartitionFilters: [isnotnull(sku" in one._jdf.queryExecution().executedPlan().toString()


def test_latest_row_of_each_key(spark):
    data = [(1, "a", 1, None), (1, "b", 3, {"k": 1}), (1, "c", 2, None), (2, "x", None, None), (None, "n", 5, None), (3, "p", 1, None), (3, "q", 1, None)]
    df = spark.createDataFrame([r[:3] for r in data], "id int, v string, t int")
    assert rows(stats.dedupe_latest(df, "id", "t")) == [(None, "n", 5), (1, "b", 3), (2, "x", None), (3, "q", 1)]


def test_files_tell_the_size_of_plain_tables(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 as k").write.parquet(str(tmp_path / "t"))
    plain = spark.read.parquet(str(tmp_path / "t"))
    assert joins.planned_bytes(plain.where("k = 3").select("id")) > 0
    assert joins.planned_bytes(plain.groupBy("k").count()) is None
    assert joins.small(1 << 20, plain, plain.groupBy("k").count()) and not joins.small(10, plain)


def test_totals_from_orders_equal_totals_from_joined(raw):
    """Users listed twice, without orders, and orders without a user: the joins multiply, and so do the sums."""
    joined = augment.orders_augmented(*raw)
    assert rows(stats.order_stats_from_orders(*raw)) == rows(stats.order_stats(joined))
    expected = rows(stats.company_stats(joined))
    assert rows(stats.company_stats_from_orders(*raw)) == expected
    orders, users, locations = raw
    assert rows(stats.order_stats_from_orders(orders, users.limit(0), locations.limit(0))) == rows(stats.order_stats(orders))
    assert stats.company_stats_from_orders(orders.limit(0), users, locations).count() == 0
