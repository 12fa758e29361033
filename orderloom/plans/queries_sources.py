"""Queries over sources, sinks and enrichment."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.timestamps import ntz_literal
from orderloom.operators import enrichment, ingest, regression, stats
from orderloom.plans import refresh
from orderloom.plans.queries_models import MEANS, augmented
from orderloom.plans.registry import over, query
from orderloom.schemas import LOCATIONS_FILE, RAW_ORDERS
from orderloom.session import materialise, scratch_path, side_by_side
from orderloom.sources import files, html_tables, payloads
from orderloom.sources.order_views import LOAD_EPOCH, OrderViews
from orderloom.sources.tables import TableStore


@query("src_full_refresh", over("places", then="""
    select c_custkey as l_user_id, c_name as l_street_address, n_name as l_state, r_name as l_country,
           zip_code as l_zip_code, 1700000000 as _sling_loaded_at from places"""))
def src_full_refresh(spark, folder):
    """Locations written as CSV and loaded as a table, twice: the second load replaces the first."""
    base = scratch_path(spark, "csv")
    OrderViews(spark, folder).locations_file().write.option("header", True).csv(f"{base}/locations")
    store = TableStore(spark, f"{base}/store")
    for epoch in (LOAD_EPOCH - 60, LOAD_EPOCH):
        stored, _ = files.full_refresh(store, f"{base}/locations", LOCATIONS_FILE, "raw_data.locations", epoch)
    return stored


@query("src_csv_infer", "select o_orderkey as order_id, o_totalprice as total from orders")
def src_csv_infer(spark, folder):
    path = scratch_path(spark, "csv")
    orders = OrderViews(spark, folder).table("orders")
    orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total")).write.option(
        "header", True
    ).csv(path)
    scanned = files.scan_csv(spark, path)
    return scanned.withColumn("order_id", F.col("order_id").cast("bigint"))


@query("sink_table", over("members", then="select * from members"))
def sink_table(spark, folder):
    store = TableStore.for_environment(spark, "LOCAL", {"LOCAL": scratch_path(spark, "store")})
    return store.replace(OrderViews(spark, folder).users(), "cleaned.users_cleaned")


@query("sink_by_key", over("sku_days", then="select * from sku_days"))
def sink_by_key(spark, folder):
    """Item statistics in one folder per item, read back as one table."""
    store = TableStore(spark, scratch_path(spark, "by-key"))
    by_day = stats.sku_stats(augmented(OrderViews(spark, folder)))
    stored = store.replace_by_key(by_day, "marketing.key_product_deepdive", "sku")
    return stored.select("order_date", "sku", "n_orders", F.round("total_revenue", 2).alias("total_revenue"))


def load_raw(store: TableStore, views: OrderViews, orders: DataFrame) -> None:
    side_by_side(
        store.spark,
        lambda: store.replace_window(orders, refresh.ORDERS, "dt", grain="year"),
        lambda: store.replace(views.raw_users(), refresh.USERS),
        lambda: store.replace(views.raw_locations(), refresh.LOCATIONS),
    )


@query("refresh_rebuild", over("days", then="""
    select cast(day as timestamp) as order_date, n as n_orders, round(revenue, 2) as total_revenue
    from days where day < date '1998-01-01'"""))
def refresh_rebuild(spark, folder):
    """All models rebuilt after the orders of the last year were taken out: nothing of them stays."""
    store, v = TableStore(spark, scratch_path(spark, "warehouse")), OrderViews(spark, folder)
    load_raw(store, v, v.raw_orders().where(F.col("dt") < ntz_literal("1999-01-01")))
    refresh.refresh_models(store, grain="year")
    kept = store.read_window(refresh.ORDERS, grain="year").where(F.col("dt") < ntz_literal("1998-01-01"))
    store.replace_window(kept, refresh.ORDERS, "dt", grain="year", spread=False)
    refresh.refresh_models(store, grain="year")
    stored = store.read_window(refresh.ORDER_STATS)
    return stored.select("order_date", "n_orders", F.round("total_revenue", 2).alias("total_revenue"))


@query("refresh_models", over("companies", "members", "places", then="""
    select 'cleaned.orders_cleaned' as table_name, count(*) as n_rows, round(sum(order_total), 0) as total from lines
    union all select 'cleaned.orders_aggregated', count(*), round(sum(order_total), 0) from lines
    union all select 'cleaned.users_cleaned', count(*), sum(user_id) from members
    union all select 'cleaned.locations_cleaned', count(*), sum(c_custkey) from places
    union all select 'analytics.orders_augmented', count(*), round(sum(order_total), 0) from sales
    union all select 'analytics.company_stats', count(*), round(sum(revenue), 0)
        from (select order_date, company, sum(order_total) as revenue from sales group by 1, 2)
    union all select 'analytics.sku_stats', count(*), round(sum(revenue), 0)
        from (select order_date, sku, sum(order_total) as revenue from sales group by 1, 2)
    union all select 'analytics.order_stats', count(*), round(sum(revenue), 0)
        from (select order_date, sum(order_total) as revenue from sales group by 1)
    union all select 'analytics.weekly_order_summary', count(*), round(sum(n), 0)
        from (select order_date, count(*) as n from sales group by 1)
    union all select 'analytics.company_perf', count(*), round(sum(revenue), 0) from companies
    union all select 'marketing.top_users', count(*), round(sum(revenue), 0)
        from (select user_id, sum(order_total) as revenue from sales group by 1)
    union all select 'marketing.avg_orders', count(*), round(sum(revenue / n_orders), 0) from companies
    union all select 'marketing.min_order', 1, min(n_orders) from companies"""))
def refresh_models(spark, folder):
    """All models built one after another as stored tables, the dated ones by year: rows and a sum of each."""
    store, v = TableStore(spark, scratch_path(spark, "warehouse")), OrderViews(spark, folder)
    load_raw(store, v, v.raw_orders())
    refresh.refresh_models(store, grain="year")
    summed = {
        refresh.ORDERS_CLEANED: "order_total",
        refresh.ORDERS_AGGREGATED: "order_total",
        refresh.USERS_CLEANED: "user_id",
        refresh.LOCATIONS_CLEANED: "user_id",
        refresh.ORDERS_AUGMENTED: "order_total",
        refresh.COMPANY_STATS: "total_revenue",
        refresh.SKU_STATS: "total_revenue",
        refresh.ORDER_STATS: "total_revenue",
        refresh.WEEKLY_SUMMARY: "num_orders",
        refresh.COMPANY_PERF: "total_revenue",
        refresh.TOP_USERS: "total_revenue",
        refresh.AVG_ORDERS: "avg_order",
        refresh.MIN_ORDER: "min_order",
    }
    counted = [
        store.read(table).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(column), 0).cast("double").alias("total"))
        .select(F.lit(table).alias("table_name"), "n_rows", "total")
        for table, column in summed.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("country_chain", over("countries", extra=MEANS, then="""
    select 'countries.continent_stats' as table_name, s.continent as name,
           round(coalesce(sum(pop_change), 0), 4) as total, round(max(mean) - max(m), 4) as coefficient
    from countries s left join means on s.continent = means.continent cross join base
    where s.continent is not null group by 2
    union all
    select 'countries.change_model', 'continent_' || continent, scores.n, round(mean - m, 4)
    from means cross join base cross join scores where continent is not null"""))
def country_chain(spark, folder):
    """The country job; its linear model and its result are read back from their tables."""
    store = TableStore(spark, scratch_path(spark, "countries"))
    refresh.run_country_chain(store, OrderViews(spark, folder).country_cells())
    continents, model = store.read(refresh.CONTINENT_STATS), store.read(refresh.CHANGE_MODEL)
    return continents.select(
        F.lit(refresh.CONTINENT_STATS).alias("table_name"),
        F.col("continent").alias("name"),
        F.round("pop_change", 4).alias("total"),
        F.round("pop_change_factor", 4).alias("coefficient"),
    ).unionByName(
        model.select(
            F.lit(refresh.CHANGE_MODEL).alias("table_name"),
            F.col("feature").alias("name"),
            F.col("n_samples").cast("double").alias("total"),
            F.round("coefficient", 4).alias("coefficient"),
        )
    )


# Order headers as payload pages of one id block each; an id occurs once, so a page is bounded.
PAGE_IDS = 512


def order_pages(spark, folder):
    """Column-oriented pages of the orders, each of one month and one block of ids."""
    rows = OrderViews(spark, folder).table("orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.length("o_orderpriority").alias("quantity"),
        F.col("o_totalprice").alias("purchase_price"),
        F.col("o_orderstatus").alias("sku"),
        F.col("o_orderdate").alias("dt"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").cast("timestamp_ntz").alias("part_start"),
        F.floor(F.col("o_orderkey") / PAGE_IDS).alias("block"),
        (F.col("o_orderkey") % PAGE_IDS).alias("position"),
    )
    return payloads.encode(rows, ["part_start", "block"], "position", RAW_ORDERS.names)


_HEADERS = """
    select o_custkey as user_id, cast(o_orderkey as varchar) as order_id,
           cast(length(o_orderpriority) as integer) as quantity, o_totalprice as purchase_price,
           o_orderstatus as sku, o_orderdate as dt from orders"""


@query("src_columnar_json", _HEADERS)
def src_columnar_json(spark, folder):
    return payloads.decode(order_pages(spark, folder), RAW_ORDERS).select(*RAW_ORDERS.names)


@query("multi_partition_load", _HEADERS + """
    where o_orderdate >= timestamp '1996-02-01' and o_orderdate < timestamp '1996-08-01'""")
def multi_partition_load(spark, folder):
    """The pages of six partitions in one job."""
    return ingest.load_partitions(order_pages(spark, folder), RAW_ORDERS, "1996-02-01", "1996-08-01")


def mixed_pages(spark, folder):
    """A page for each order: good, with two spoilt values, broken off, or followed by more text."""
    orders = OrderViews(spark, folder).table("orders")
    kind, key = F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
    price = F.when(kind == 1, F.lit('"much"')).otherwise(F.col("o_totalprice").cast("string"))
    text = F.concat(
        F.lit('{"user_id":{"0":'), F.col("o_custkey").cast("string"), F.lit('.0},"order_id":{"0":"'), key,
        F.lit('"},"purchase_price":{"0":'), price, F.lit('},"quantity":{"0":'),
        F.when(kind == 1, "1.5").otherwise("2.0"), F.lit("}}"),
    )
    broken = F.left(text, F.length(text) - 1)
    page = F.when(kind == 2, broken).when(kind == 3, F.concat(text, F.lit(" and more"))).otherwise(text)
    return orders.select("o_orderkey", page.alias("payload"))


@query("payloads_rejected", """
    select o_orderkey from orders where o_orderkey % 5 in (2, 3)
    union all select -1 - doc_id from documents""")
def payloads_rejected(spark, folder):
    """Of good, partly bad and broken pages and plain documents, those that are no payload."""
    docs = OrderViews(spark, folder).table("documents")
    texts = docs.select((-1 - F.col("doc_id")).alias("o_orderkey"), F.col("text").alias("payload"))
    return payloads.rejected(mixed_pages(spark, folder).unionByName(texts), RAW_ORDERS).select("o_orderkey")


@query("payload_bad_values", """
    select o_orderkey, 0 as row_index, unnest(['purchase_price', 'quantity']) as column_name,
           unnest(['much', '1.5']) as text
    from orders where o_orderkey % 5 = 1""")
def payload_bad_values(spark, folder):
    return payloads.bad_values(mixed_pages(spark, folder), RAW_ORDERS)


@query("payload_good_values", """
    select o_orderkey, o_custkey as user_id, cast(o_orderkey as varchar) as order_id,
           case when o_orderkey % 5 = 1 then null else 2 end as quantity,
           case when o_orderkey % 5 = 1 then null else o_totalprice end as purchase_price
    from orders where o_orderkey % 5 not in (2, 3)""")
def payload_good_values(spark, folder):
    """A spoilt value empties its own cell only; whole numbers may be written with a fraction."""
    rows = payloads.decode(mixed_pages(spark, folder), RAW_ORDERS)
    return rows.select("o_orderkey", "user_id", "order_id", "quantity", "purchase_price")


_PAGE_NUMBERS = "cast(length(url) as double)", "cast(length(html) as double)"


@query("src_html_table", f"""
    select page_id, 'Page ' || page_id as country, {_PAGE_NUMBERS[0]} as pop_2022, {_PAGE_NUMBERS[1]} as pop_2023,
           split_part(url, '/', 4) as continent, url as region,
           round(({_PAGE_NUMBERS[1]} / nullif({_PAGE_NUMBERS[0]}, 0) - 1) * 100, 4) as pop_change
    from pages""")
def src_html_table(spark, folder):
    """Every page with a six-column table put in front of its whole text, read as the country table."""
    return country_pages(spark, folder, behind=False)


@query("src_html_all", f"""
    select page_id, 'Page ' || page_id as country, {_PAGE_NUMBERS[0]} as pop_2022, {_PAGE_NUMBERS[1]} as pop_2023,
           split_part(url, '/', 4) as continent, url as region,
           round(({_PAGE_NUMBERS[1]} / nullif({_PAGE_NUMBERS[0]}, 0) - 1) * 100, 4) as pop_change
    from pages""")
def src_html_all(spark, folder):
    """All tables of every page; the table stands behind the text, so the page is read to its end."""
    return country_pages(spark, folder, behind=True)


def country_pages(spark, folder, behind: bool):
    cells = [
        F.concat(F.lit("Page "), F.col("page_id").cast("string")),
        F.length("url").cast("string"),
        F.length("html").cast("string"),
        F.lit("0"),
        F.split("url", "/")[3],
        F.replace("url", F.lit("&"), F.lit("&amp;")),
    ]
    head = "<table><thead><tr>" + "".join(f"<th>c{i}</th>" for i in range(6)) + "</tr></thead><tr>"
    body = [part for cell in cells for part in (F.lit("<td>"), cell, F.lit("</td>"))]
    pages = OrderViews(spark, folder).table("pages")
    table = [F.lit(head), *body, F.lit("</tr></table>")]
    with_table = pages.select("page_id", F.concat(*(["html", *table] if behind else [*table, "html"])).alias("html"))
    rows = html_tables.table_rows(with_table, first_only=not behind)
    named = html_tables.positional(rows, regression.COUNTRY_COLUMNS)
    cells_first = named.select(*[F.col(f"`{c}`") for c in regression.COUNTRY_COLUMNS], "page_id")
    out = regression.country_stats(cells_first, keep=["page_id"])
    return out.withColumn("pop_change", F.round("pop_change", 4))


# The places an order can be handled at.
CENTERS = ["scranton", "albany", "new york"]


def center_answer(order_id: int) -> str:
    """A stand-in for the remote service: the same JSON shape, chosen by the id."""
    return json.dumps({"order_id": {"0": int(order_id)}, "order_center": {"0": [CENTERS[order_id % 3]]}})


@query("enriched_data", """
    select o_orderkey as order_id, o_totalprice as total, center,
           '{"0":["' || center || '"]}' as order_center
    from (select *, case o_orderkey % 3 when 0 then 'scranton' when 1 then 'albany' else 'new york' end as center
          from orders)""")
def enriched_data(spark, folder):
    orders = OrderViews(spark, folder).table("orders")
    rows = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"))
    out = enrichment.enrich(rows, center_answer)
    return out.select(
        "order_id", "total", enrichment.center_name().alias("center"), F.to_json("order_center").alias("order_center")
    )


@query("enriched_data_lookup", """
    select l_orderkey as order_id, l_linenumber as line, p_brand as brand, p_type as kind
    from lineitem left join part on l_partkey = p_partkey""")
def enriched_data_lookup(spark, folder):
    v = OrderViews(spark, folder)
    lines = v.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("key")
    )
    parts = v.table("part").select(
        F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")
    )
    return stats.lookup_join(lines, parts, "key").drop("key")


@query("enrich_batches", """
    select o_orderkey as order_id,
           cast(ntile((select cast(ceil(count(*) / 50.0) as bigint) from orders)) over (order by o_orderkey) as integer)
           as batch_no
    from orders""")
def enrich_batches(spark, folder):
    ids = OrderViews(spark, folder).table("orders").select(F.col("o_orderkey").alias("order_id"))
    return enrichment.assign_batches(ids, "order_id")


def shaky_answer(order_id: int) -> str:
    """The stand-in service, which knows no order whose id is divisible by eleven."""
    if order_id % 11 == 0:
        raise LookupError(f"order {order_id} is not known")
    return center_answer(order_id)


@query("enriched_data_errors", """
    select o_orderkey as order_id, case when o_orderkey % 11 <> 0 then
               case o_orderkey % 3 when 0 then 'scranton' when 1 then 'albany' else 'new york' end end as center,
           case when o_orderkey % 11 = 0 then 'LookupError: order ' || o_orderkey || ' is not known' end as error
    from orders""")
def enriched_data_errors(spark, folder):
    """Sixteen calls under way in each task; a key that keeps failing is a row with its error."""
    rows = OrderViews(spark, folder).table("orders").select(F.col("o_orderkey").alias("order_id"))
    out = enrichment.enrich(rows, shaky_answer, max_retries=0, in_flight=16)
    return out.select("order_id", enrichment.center_name().alias("center"), "error")


@query("sink_safe_replace", over("members", then="""
    select 'built' as state, count(*) as n_rows, sum(user_id) as total from members
    union all select 'failed', count(*), sum(user_id) from members
    union all select 'from itself', count(*), sum(user_id) from members where user_id % 2 = 0
    union all select 'reader before', count(*), sum(user_id) from members"""))
def sink_safe_replace(spark, folder):
    """A table after a build, after a build that failed midway, and after one that reads the table itself.

    A frame opened before the last build still reads what it was opened on.
    """
    store, name = TableStore(spark, scratch_path(spark, "safe")), "cleaned.users_cleaned"
    users = OrderViews(spark, folder).users().select("user_id", "company")

    def state(label, df):
        total = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("user_id").alias("total"))
        return total.select(F.lit(label).alias("state"), "n_rows", "total")

    before = store.replace(users, name)
    built = materialise(state("built", before), "state")
    last = F.lit(users.agg(F.max("user_id")).first()[0])
    broken = users.withColumn("company", F.when(F.col("user_id") == last, F.raise_error(F.lit("broken"))).otherwise("new"))
    try:
        store.replace(broken, name)
    except Exception as error:
        if "broken" not in str(error):
            raise
    failed = materialise(state("failed", store.read(name)), "state")
    store.replace(store.read(name).where("user_id % 2 = 0"), name)
    states = [built, failed, state("from itself", store.read(name)), state("reader before", before)]
    return reduce(DataFrame.unionByName, states)
