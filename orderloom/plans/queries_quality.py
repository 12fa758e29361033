"""Queries over the data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import cleaned, quality, stats
from orderloom.plans.queries_models import augmented, perf
from orderloom.plans.registry import over, query
from orderloom.session import scratch_path
from orderloom.sources.order_views import OrderViews
from orderloom.sources.tables import TableStore


def flat(verdicts):
    """Verdicts with their metadata as sorted text, which any engine can compare."""
    parts = F.transform(
        F.array_sort(F.map_entries("metadata")), lambda e: F.concat_ws("=", e["key"], e["value"])
    )
    return verdicts.withColumn("metadata", F.array_join(parts, ";"))


@query("check_not_null", over("sales", then="""
    select user_id, order_date, sku, order_total, state
    from sales where company is null"""))
def check_not_null(spark, folder):
    rows = quality.not_null(augmented(OrderViews(spark, folder)), "company")
    return rows.select("user_id", "order_date", "sku", "order_total", "state")


@query("check_not_null_verdict", over("sales", then="""
    select 'user_id not null' as "check", count(*) = count(user_id) as passed, 'ERROR' as severity,
           'n_failing=' || (count(*) - count(user_id)) as metadata from sales"""))
def check_not_null_verdict(spark, folder):
    rows = quality.not_null(augmented(OrderViews(spark, folder), sku=False), "user_id")
    return flat(quality.failing_rows_verdict(rows, "user_id not null", quality.ERROR))


@query("check_not_null_failing_verdict", over("sales", then="""
    select 'company not null' as "check", count(*) = count(company) as passed, 'ERROR' as severity,
           'n_failing=' || (count(*) - count(company)) as metadata from sales"""))
def check_not_null_failing_verdict(spark, folder):
    """Orders of left-out users have no company."""
    rows = quality.not_null(augmented(OrderViews(spark, folder), sku=False), "company")
    return flat(quality.failing_rows_verdict(rows, "company not null", quality.ERROR))


@query("check_greater_than_zero", """
    select c_custkey, c_name, c_acctbal from customer where c_acctbal <= 0""")
def check_greater_than_zero(spark, folder):
    customers = OrderViews(spark, folder).table("customer").select("c_custkey", "c_name", "c_acctbal")
    return quality.greater_than_zero(customers, "c_acctbal")


@query("check_order_total", """
    select o_custkey as user_id, o_orderdate as dt, cast(l_quantity as integer) * l_discount as order_total
    from lineitem join orders on l_orderkey = o_orderkey
    where cast(l_quantity as integer) * l_discount <= 0""")
def check_order_total(spark, folder):
    """Discounts take the place of prices: these can be zero, prices of the test tables cannot."""
    v = OrderViews(spark, folder)
    lines, orders = v.table("lineitem"), v.table("orders")
    raw = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").alias("purchase_price"),
        F.lit(None).cast("string").alias("sku"),
        F.col("o_orderdate").alias("dt"),
    )
    return quality.order_total_not_positive(cleaned.orders_cleaned(raw))


@query("check_like_any", """
    select c_custkey as user_id, c_mktsegment as company from customer
    where c_acctbal >= 0 and not regexp_matches(c_mktsegment, 'BUILD|MOB|^HOUSE')""")
def check_like_any(spark, folder):
    users = OrderViews(spark, folder).users().select("user_id", "company")
    return quality.like_patterns(users, "company", ["%BUILD%", "%MOB%", "HOUSE%"])


@query("check_like_all", """
    select c_custkey as user_id, c_mktsegment as company from customer
    where c_acctbal >= 0 and (not contains(c_mktsegment, 'U') or not contains(c_mktsegment, 'I'))""")
def check_like_all(spark, folder):
    users = OrderViews(spark, folder).users().select("user_id", "company")
    return quality.like_patterns(users, "company", ["%U%", "%I%"], match_on="all")


@query("check_avg_orders", over("companies", then="""
    select 'check_avg_orders' as "check", revenue / n_orders < 50 as passed, 'ERROR' as severity,
           round(revenue / n_orders, 2) as actual_average
    from companies order by company nulls first limit 1"""))
def check_avg_orders(spark, folder):
    out = quality.check_avg_orders(stats.avg_orders(perf(spark, folder)))
    actual = F.col("metadata")["actual average"].cast("double")
    return out.select("check", "passed", "severity", actual.alias("actual_average"))


@query("check_users", """
    with wanted as (select unnest(['BUILDING', 'AUTOMOBILE', 'FURNITURE', 'DISCOUNT']) as v),
         seen as (select distinct c_mktsegment as v from customer),
         counts as (select (select count(*) from seen anti join wanted using (v)) as un,
                           (select count(*) from wanted anti join seen using (v)) as mi)
    select 'check_users' as "check", un + mi = 0 as passed, 'WARN' as severity,
           'missing=' || mi || ';unexpected=' || un as metadata from counts""")
def check_users(spark, folder):
    users = OrderViews(spark, folder).raw_users()
    return flat(quality.check_users(users, ["BUILDING", "AUTOMOBILE", "FURNITURE", "DISCOUNT"]))


@query("check_users_difference", """
    with wanted as (select unnest(['BUILDING', 'AUTOMOBILE', 'FURNITURE', 'DISCOUNT']) as v),
         seen as (select distinct c_mktsegment as v from customer)
    select v as value, 'unexpected' as side from seen anti join wanted using (v)
    union all
    select v, 'missing' from wanted anti join seen using (v)""")
def check_users_difference(spark, folder):
    users = OrderViews(spark, folder).raw_users()
    return quality.set_difference(users, "company", ["BUILDING", "AUTOMOBILE", "FURNITURE", "DISCOUNT"])


@query("check_schema_change", over("members", then="""
    select 'company' as column_name, 'removed' as change, 'string' as old_type, null as new_type,
           count(company) as old_values, 0 as new_values from members
    union all
    select 'segment', 'added', null, 'string', 0, count(company) from members
    union all
    select 'user_id', 'retyped', 'bigint', 'string', count(user_id), count(user_id) from members"""))
def check_schema_change(spark, folder):
    """Two stored builds of the users; the second renames one column and retypes another."""
    store = TableStore(spark, scratch_path(spark, "builds"))
    users = OrderViews(spark, folder).users()
    old = store.replace(users, "builds.first")
    retyped = users.withColumn("user_id", F.col("user_id").cast("string"))
    new = store.replace(retyped.withColumnRenamed("company", "segment"), "builds.second")
    return quality.schema_changes(old, new)


@query("schema_history", """
    select unnest(['user_id', 'user_id', 'place', 'place.state', 'place.zip', 'place.zip', 'tags', 'tags.element',
                   'tags.element.name', 'counts', 'counts.key', 'counts.value', 'counts.value']) as column_path,
           unnest(['bigint', 'string', 'struct', 'string', 'string', 'int', 'array', 'struct', 'string', 'map', 'string',
                   'int', 'bigint']) as type,
           unnest([1, 4, 1, 1, 1, 3, 2, 2, 2, 1, 1, 1, 2]) as valid_from,
           unnest([4, null, null, null, 2, null, 4, 4, 4, null, null, 2, null]) as valid_to
    where exists (select 1 from customer)""")
def schema_history(spark, folder):
    """Columns, nested ones included, of four stored builds of the users, and the builds they hold for."""
    store, v = TableStore(spark, scratch_path(spark, "history")), OrderViews(spark, folder)
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    state, zip_text = F.col("c_mktsegment").alias("state"), nation.alias("zip")
    counts = lambda kind: F.create_map(F.lit("n"), F.col("c_nationkey").cast(kind)).alias("counts")
    tags = F.array(F.struct(F.col("c_name").alias("name"))).alias("tags")
    number = nation.cast("int").alias("zip")
    builds = [
        [key.alias("user_id"), F.struct(state, zip_text).alias("place"), counts("int")],
        [key.alias("user_id"), F.struct(state).alias("place"), counts("bigint"), tags],
        [key.alias("user_id"), F.struct(state, number).alias("place"), counts("bigint"), tags],
        [key.cast("string").alias("user_id"), F.struct(state, number).alias("place"), counts("bigint")],
    ]
    rows = []
    for build, columns in enumerate(builds, 1):
        stored = store.replace(v.table("customer").select(*columns), "builds.users")
        rows.append(quality.schema_rows(stored, build))
    return quality.schema_history(reduce(DataFrame.unionByName, rows))
