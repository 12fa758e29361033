from datetime import datetime

import pytest
from conftest import rows

from orderloom.operators import profile, quality

T0 = datetime(2023, 5, 25)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(1, T0, 0.0), (2, T0, -1.0), (3, T0, None), (None, T0, 5.0)], "user_id long, dt timestamp_ntz, order_total double"
    )


def test_row_checks(orders):
    assert quality.not_null(orders, "user_id").count() == 1
    assert [r[0] for r in rows(quality.greater_than_zero(orders, "order_total"))] == [1, 2]
    assert rows(quality.order_total_not_positive(orders)) == [(1, T0, 0.0), (2, T0, -1.0)]


def test_patterns(spark):
    df = spark.createDataFrame([("FoodCo",), ("ShopMart",), ("other",), ("foodco",), (None,)], "company string")
    assert rows(quality.like_patterns(df, "company")) == [("foodco",), ("other",)]
    every = quality.like_patterns(df, "company", ["%o%", "%C%"], match_on="all")
    assert rows(every) == [("ShopMart",), ("foodco",), ("other",)]
    with pytest.raises(ValueError):
        quality.like_patterns(df, "company", match_on="some")


def test_company_set(spark):
    users = spark.createDataFrame([("ShopMart",), ("FoodCo",), ("FoodCo",), ("SportTime",), ("FamilyLtd",), (None,)], "company string")
    row = quality.check_users(users).first()
    assert (row["passed"], row["severity"], row["metadata"]) == (False, "WARN", {"unexpected": "2", "missing": "1"})
    found = rows(quality.set_difference(users, "company", quality.EXPECTED_COMPANIES))
    assert found == [(None, "unexpected"), ("DiscountStore", "missing"), ("FoodCo", "unexpected")]
    same = quality.check_users(users.where("company is not null"), ["ShopMart", "FoodCo", "SportTime", "FamilyLtd"])
    assert same.first()["passed"] is True


def test_average_check_is_strict(spark):
    for value, passed in ((49.99, True), (50.0, False)):
        averages = spark.createDataFrame([("b", 1.0), ("a", value)], "company string, avg_order double")
        row = quality.check_avg_orders(averages).first()
        assert (row["passed"], row["metadata"]["threshold"]) == (passed, "50")


def test_verdict_of_row_checks(orders):
    row = quality.failing_rows_verdict(quality.not_null(orders, "user_id"), "ids").first()
    assert tuple(row) == ("ids", False, "WARN", {"n_failing": "1"})
    assert quality.check_not_empty(orders, "any").first()["passed"] is True
    assert quality.check_not_empty(orders.limit(0), "any").first()["passed"] is False


def test_schema_changes(spark):
    old = spark.createDataFrame([(1, "x", 2.0), (2, None, 3.0)], "a int, b string, c double")
    new = spark.createDataFrame([(1, 2.0, True)], "a long, c double, d boolean")
    assert rows(quality.schema_changes(old, new)) == [
        ("a", "retyped", "int", "bigint", 2, 1),
        ("b", "removed", "string", None, 1, 0),
        ("d", "added", None, "boolean", 0, 1),
    ]
    assert quality.schema_changes(old, old).count() == 0


def test_catalog_has_tags_and_nulls(spark):
    users = spark.createDataFrame([(1, "x"), (2, None)], "user_id long, company string")
    got = profile.column_catalog(profile.annotate(users, "users_cleaned"), "users_cleaned")
    assert rows(got.select("column_name", "data_type", "tags", "n_rows", "n_null")) == [
        ("company", "string", "", 2, 1),
        ("user_id", "bigint", "PII", 2, 0),
    ]
    tagged = profile.tag_columns(got, {"user_id": "PII"})
    assert rows(tagged.select("column_name", "tag")) == [("company", None), ("user_id", "PII")]


def test_averages_of_nothing_fail_the_check(spark):
    none = spark.createDataFrame([], "company string, avg_order double")
    assert [r.passed for r in quality.check_avg_orders(none).collect()] == [False]
    some = spark.createDataFrame([("b", 1.0), (None, 90.0), ("a", 99.0)], "company string, avg_order double")
    assert [r.passed for r in quality.check_avg_orders(some).collect()] == [False]
    assert [r.passed for r in quality.check_avg_orders(some.where("company = 'b'")).collect()] == [True]


def test_builds_that_agree_are_not_read(spark, tmp_path):
    spark.range(5).selectExpr("id as a", "id as b").write.parquet(str(tmp_path / "t"))
    same = spark.read.parquet(str(tmp_path / "t"))
    plan = quality.schema_changes(same, same)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    plan = quality.schema_changes(same, same.withColumnRenamed("b", "c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "count(a" not in plan
