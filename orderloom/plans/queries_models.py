"""Queries over the order models."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import augment, cleaned, quality, regression, stats, windows
from orderloom.operators.profile import annotate, column_catalog, profile_tables, tag_columns
from orderloom.plans.registry import over, query
from orderloom.session import materialise, scratch_path
from orderloom.sources.order_views import OrderViews
from orderloom.sources.tables import TableStore

WINDOW = ("1996-03-01", "1996-06-01")


def money(name: str):
    return F.round(name, 2).alias(name)


def augmented(v: OrderViews, sku: bool = True):
    return augment.orders_augmented(v.orders(sku), v.users(), v.locations())


@query("top_users", over("companies", then="""
    select user_id, round(sum(order_total), 2) as total_revenue,
           round(sum(order_total) / nullif(any_value(revenue), 0), 6) as pct_revenue
    from sales left join companies using (company) group by user_id"""))
def top_users(spark, folder):
    v = OrderViews(spark, folder)
    shares = stats.top_users_from_orders(v.orders(sku=False), v.users(), v.locations())
    return shares.select("user_id", money("total_revenue"), F.round("pct_revenue", 6).alias("pct_revenue"))


@query("orders_cleaned", over("lines", then="select * from lines"))
def orders_cleaned(spark, folder):
    return OrderViews(spark, folder).orders()


@query("orders_aggregated", over("lines", then="select * from lines"))
def orders_aggregated(spark, folder):
    return cleaned.orders_aggregated(OrderViews(spark, folder).orders())


@query("users_cleaned", over("members", then="select * from members"))
def users_cleaned(spark, folder):
    return OrderViews(spark, folder).users()


@query("locations_cleaned", over("places", then="""
    select c_custkey as user_id, c_name as street_address, n_name as state, r_name as country, zip_code,
           1700000000 as _sling_loaded_at from places"""))
def locations_cleaned(spark, folder):
    return OrderViews(spark, folder).locations()


@query("orders_augmented", over("sales", then="select * from sales"))
def orders_augmented(spark, folder):
    return augmented(OrderViews(spark, folder))


@query("company_stats", over("sales", then="""
    select order_date, company, count(*) as n_orders, round(sum(order_total), 2) as total_revenue
    from sales group by all"""))
def company_stats(spark, folder):
    v = OrderViews(spark, folder)
    out = stats.company_stats_from_orders(v.orders(sku=False), v.users(), v.locations())
    return out.withColumn("total_revenue", money("total_revenue"))


@query("sku_stats", over("sku_days", then="select * from sku_days"))
def sku_stats(spark, folder):
    return stats.sku_stats(augmented(OrderViews(spark, folder))).withColumn("total_revenue", money("total_revenue"))


@query("order_stats", over("days", then="""
    select cast(day as timestamp) as order_date, n as n_orders, round(revenue, 2) as total_revenue from days"""))
def order_stats(spark, folder):
    v = OrderViews(spark, folder)
    out = stats.order_stats_from_orders(v.orders(sku=False), v.users(), v.locations())
    return out.withColumn("total_revenue", money("total_revenue"))


def perf(spark, folder):
    return stats.company_perf(stats.company_stats(augmented(OrderViews(spark, folder), sku=False)))


@query("company_perf", over("companies", then="""
    select company, n_orders, round(revenue, 2) as total_revenue from companies"""))
def company_perf(spark, folder):
    return perf(spark, folder).withColumn("total_revenue", money("total_revenue"))


@query("avg_orders", over("sales", then="""
    select company, round(sum(order_total) / count(*), 2) as avg_order from sales group by company"""))
def avg_orders(spark, folder):
    return stats.avg_orders(perf(spark, folder)).withColumn("avg_order", money("avg_order"))


@query("users_latest", """
    select user_id, max(company) as company, created_at from (
        select c_custkey % 500 as user_id, c_mktsegment as company,
               timestamp '2023-05-25' + to_days(cast(c_custkey % 365 as integer)) as created_at from customer)
    where (user_id, created_at) in (
        select c_custkey % 500, max(timestamp '2023-05-25' + to_days(cast(c_custkey % 365 as integer)))
        from customer group by 1) group by user_id, created_at""")
def users_latest(spark, folder):
    """Users that were loaded several times, once each."""
    users = OrderViews(spark, folder).raw_users().select((F.col("user_id") % 500).alias("user_id"), "company", "created_at")
    return stats.dedupe_latest(users, "user_id", "created_at")


@query("min_order", over("companies", then="select min(n_orders) as min_order from companies"))
def min_order(spark, folder):
    return stats.min_order(perf(spark, folder))


def summary(spark, folder):
    return stats.weekly_order_summary(stats.order_stats(augmented(OrderViews(spark, folder), sku=False)))


@query("weekly_order_summary", over("days", then="""
    select cast(day as timestamp) as order_date, n as num_orders from days"""))
def weekly_order_summary(spark, folder):
    return summary(spark, folder)


@query("big_orders_observed", over("days", then="""
    select cast(day as timestamp) as order_date, n as num_orders from days where n >= 35"""))
def big_orders_observed(spark, folder):
    return stats.big_orders(summary(spark, folder), capacity=35)


@query("key_product_deepdive", over("sku_days", then="""
    select * from sku_days where sku = 'Brand#4'"""))
def key_product_deepdive(spark, folder):
    """Item statistics in one folder per item; the folder of one item is read."""
    store = TableStore(spark, scratch_path(spark, "by-key"))
    store.replace_by_key(stats.sku_stats(augmented(OrderViews(spark, folder))), "marketing.key_product_deepdive", "sku")
    one = store.read_key("marketing.key_product_deepdive", "sku", "Brand#4")
    return one.withColumn("total_revenue", money("total_revenue"))


@query("preview_sku", over("sku_days", then="""
    select * from sku_days where sku = 'Brand#4' order by order_date limit 5"""))
def preview_sku(spark, folder):
    one = stats.key_product_deepdive(stats.sku_stats(augmented(OrderViews(spark, folder))), "Brand#4")
    return stats.preview(one, ["order_date"], 5).withColumn("total_revenue", money("total_revenue"))


@query("preview_raw", "select o_orderkey as order_id from orders order by 1 limit 3")
def preview_raw(spark, folder):
    ids = OrderViews(spark, folder).table("orders").select(F.col("o_orderkey").alias("order_id"))
    return stats.preview(ids, ["order_id"], 3)


@query("incremental_window", over("lines", then="""
    select user_id, sku, dt, order_total from lines
    where dt between timestamp '1996-03-01' and timestamp '1996-06-01'"""))
def incremental_window(spark, folder):
    rows = cleaned.orders_cleaned(OrderViews(spark, folder).raw_orders(), *WINDOW)
    return rows.select("user_id", "sku", "dt", "order_total")


@query("incremental_window_half_open", over("sales", then="""
    select user_id, sku, company, order_date, order_total from sales
    where month(order_date) between 3 and 5 and year(order_date) = 1996"""))
def incremental_window_half_open(spark, folder):
    v = OrderViews(spark, folder)
    rows = augment.orders_augmented(v.orders(), v.users(), v.locations(), *WINDOW, closed="left")
    return rows.select("user_id", "sku", "company", "order_date", "order_total")


@query("weekly_rollup", over("days", then="""
    select cast(day - cast(dayofweek(day) as integer) as timestamp) as week_start,
           cast(sum(n) as bigint) as n_orders, round(sum(revenue), 2) as total_revenue, count(*) as n_days
    from days group by week_start"""))
def weekly_rollup(spark, folder):
    days = stats.order_stats(augmented(OrderViews(spark, folder), sku=False))
    return windows.weekly_rollup(days).withColumn("total_revenue", money("total_revenue"))


@query("distinct_companies", "select distinct c_mktsegment as company from customer")
def distinct_companies(spark, folder):
    return stats.distinct_values(OrderViews(spark, folder).raw_users(), "company")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@query("profile_row_counts", " union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows, (select count(*) from (describe {t})) as n_columns from {t}"
    for t in TABLES))
def profile_row_counts(spark, folder):
    v = OrderViews(spark, folder)
    rows = profile_tables({t: v.table(t) for t in TABLES})
    return rows.select("table_name", "n_rows", F.col("n_columns").cast("bigint").alias("n_columns"))


# Table, relation on the SQL side, column, type and tags.
CATALOG = [
    ("orders_augmented", "sales", "user_id", "bigint", "PII"),
    ("orders_augmented", "sales", "quantity", "int", ""),
    ("orders_augmented", "sales", "purchase_price", "double", ""),
    ("orders_augmented", "sales", "sku", "string", ""),
    ("orders_augmented", "sales", "dt", "timestamp_ntz", ""),
    ("orders_augmented", "sales", "dt_2", "timestamp_ntz", ""),
    ("orders_augmented", "sales", "order_date", "timestamp_ntz", ""),
    ("orders_augmented", "sales", "order_total", "double", ""),
    ("orders_augmented", "sales", "company", "string", ""),
    ("orders_augmented", "sales", "state", "string", ""),
    ("orders_augmented", "sales", "zip_code", "string", ""),
    ("users_cleaned", "members", "user_id", "bigint", "PII"),
    ("users_cleaned", "members", "created_at", "timestamp_ntz", ""),
    ("users_cleaned", "members", "company", "string", ""),
]


@query("column_catalog", over("sales", "members", then=" union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{d}' as data_type, '{g}' as tags, "
    f"count(*) as n_rows, sum(case when {c} is null then 1 else 0 end)::bigint as n_null from {r}"
    for t, r, c, d, g in CATALOG)))
def catalog(spark, folder):
    v = OrderViews(spark, folder)
    tables = {"orders_augmented": augmented(v), "users_cleaned": v.users()}
    first, second = (column_catalog(annotate(df, name), name) for name, df in tables.items())
    return first.unionByName(second).drop("description")


@query("column_tags_upper", over("members", then=" union all ".join(
    f"select '{c}' as column_name, '{d}' as data_type, {g} as tag, count(*) as n_rows from members"
    for c, d, g in [("USER_ID", "bigint", "'PII'"), ("CREATED_AT", "timestamp_ntz", "null"),
                    ("COMPANY", "string", "null")])))
def column_tags_upper(spark, folder):
    users = OrderViews(spark, folder).users()
    listed = column_catalog(users.toDF(*[c.upper() for c in users.columns]), "USERS_CLEANED")
    return tag_columns(listed, {"USER_ID": "PII"}).select("column_name", "data_type", "tag", "n_rows")


def country_stats_frame(spark, folder):
    return regression.country_stats(OrderViews(spark, folder).country_cells())


@query("country_stats", over("countries", then="""
    select * exclude (pop_change), round(pop_change, 4) as pop_change from countries"""))
def country_stats(spark, folder):
    out = country_stats_frame(spark, folder)
    return out.withColumn("pop_change", F.round("pop_change", 4))


@query("check_country_stats", over("countries", then="""
    select 'check_country_stats' as "check", exists (from countries) as passed"""))
def check_country_stats(spark, folder):
    rows = country_stats_frame(spark, folder)
    return quality.check_not_empty(rows, "check_country_stats").select("check", "passed")


MEANS = """
    means as (select continent, avg(pop_change) as mean, count(*) as n from countries
              where pop_change is not null group by 1),
    base as (select coalesce(max(case when continent is null then mean end),
                             avg(case when continent is not null then mean end)) as m from means),
    scores as (select count(*) as n, sum((pop_change - mean) * (pop_change - mean)) as sse,
                      avg(abs(pop_change - mean)) as mae, var_pop(pop_change) * count(*) as total
               from countries s join means on s.continent is not distinct from means.continent
               where pop_change is not null)"""


@query("change_model", over("countries", extra=MEANS, then="""
    select 'continent_' || means.continent as feature, round(mean - m, 4) as coefficient,
           round(m, 4) as intercept, scores.n as n_samples, round(1 - sse / total, 4) as r2,
           round(sqrt(sse / scores.n), 4) as rmse, round(mae, 4) as mae
    from means cross join base cross join scores where means.continent is not null"""))
def change_model(spark, folder):
    rows = materialise(country_stats_frame(spark, folder), "countries")
    model = regression.change_model(rows).drop("continent")
    return model.withColumn("coefficient", F.round("coefficient", 4))


@query("continent_stats", over("countries", extra=MEANS, then="""
    select s.continent, coalesce(sum(pop_2022), 0) as pop_2022, coalesce(sum(pop_2023), 0) as pop_2023,
           round(coalesce(sum(pop_change), 0), 4) as pop_change,
           round(max(mean) - max(m), 4) as pop_change_factor
    from countries s left join means on s.continent = means.continent cross join base
    where s.continent is not null group by 1"""))
def continent_stats(spark, folder):
    rows = materialise(country_stats_frame(spark, folder), "countries")
    out = regression.continent_stats(rows, regression.change_model(rows))
    return out.withColumn("pop_change", F.round("pop_change", 4)).withColumn(
        "pop_change_factor", F.round("pop_change_factor", 4)
    )


@query("continent_texts", over("countries", then="""
    select continent, column_name, row_number() over (partition by continent, column_name order by part) - 1 as position,
           part
    from (select continent, 'country' as column_name, country as part from countries
          union all select continent, 'region', region from countries)
    where continent is not null and part is not null"""))
def continent_texts(spark, folder):
    """The joined texts of each continent, part by part."""
    return regression.text_parts(country_stats_frame(spark, folder), "continent")


@query("texts_in_row_order", """
    select c_mktsegment, 'c_name' as column_name,
           row_number() over (partition by c_mktsegment order by c_acctbal desc, c_custkey) - 1 as position, c_name as part
    from customer where c_mktsegment is not null and c_name is not null""")
def texts_in_row_order(spark, folder):
    """The joined names of each segment in the order in which the rows of a table of several files stand."""
    path = scratch_path(spark, "row-order")
    customers = OrderViews(spark, folder).table("customer")
    placed = customers.repartitionByRange(5, F.desc("c_acctbal"), "c_custkey").sortWithinPartitions(F.desc("c_acctbal"), "c_custkey")
    placed.select("c_mktsegment", "c_name").write.parquet(path)
    return regression.text_parts_in_row_order(spark.read.parquet(path), "c_mktsegment")


@query("country_bad_cells", """
    select p_partkey, column_name, text from (
        select p_partkey, 'pop_2022' as column_name, p_size || left(p_type, 1) as text from part where p_partkey % 3 = 0
        union all
        select p_partkey, 'pop_2023', p_brand from part where p_partkey % 2 = 0)""")
def country_bad_cells(spark, folder):
    """A country table of the parts in which every third and every second number is spoilt by letters."""
    part = OrderViews(spark, folder).table("part")
    size = F.col("p_size").cast("string")
    cells = part.select(
        "p_name",
        F.when(F.col("p_partkey") % 3 == 0, F.concat(size, F.left("p_type", F.lit(1)))).otherwise(size).alias("a"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.concat(F.lit(" 1,"), size)).alias("b"),
        F.lit("x").alias("c"),
        "p_brand",
        "p_type",
        "p_partkey",
    )
    return regression.bad_numbers(cells, keep=["p_partkey"])


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", "select c_custkey as user_id, " + ", ".join(
    f"case when c_mktsegment = '{s}' then 1 else 0 end as company_{s}" for s in _SEGMENTS) + " from customer")
def one_hot(spark, folder):
    return regression.one_hot(OrderViews(spark, folder).raw_users().select("user_id", "company"), "company", _SEGMENTS)


@query("one_hot_rows", """
    select c_custkey as user_id, 'company_' || c_mktsegment as feature, 1 as value from customer
    where c_mktsegment is not null""")
def one_hot_rows(spark, folder):
    return regression.one_hot_rows(OrderViews(spark, folder).raw_users().select("user_id", "company"), "company")
