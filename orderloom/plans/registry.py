"""Registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# The shared relations of the SQL side. They are stated over the star-schema tables on
# their own terms: a line finds its buyer in one lookup, and every total is taken
# straight from the lines.
RELATIONS = {
    "lines": """
        select o_custkey as user_id, cast(l_quantity as integer) as quantity,
               l_extendedprice / nullif(l_quantity, 0) as purchase_price, p_brand as sku,
               o_orderdate as dt, o_orderdate as dt_2, o_orderdate as order_date,
               cast(l_quantity as integer) * (l_extendedprice / nullif(l_quantity, 0)) as order_total
        from lineitem join orders on o_orderkey = l_orderkey left join part on p_partkey = l_partkey""",
    "sales": """
        select lines.*, buyer.company, buyer.state, buyer.zip_code
        from lines left join (
            select c_custkey, case when c_acctbal >= 0 then c_mktsegment end as company,
                   (select n_name from nation where n_nationkey = c_nationkey) as state,
                   right('00000' || c_nationkey, 5) as zip_code
            from customer) buyer on buyer.c_custkey = lines.user_id""",
    "days": """
        select cast(order_date as date) as day, count(*) as n, sum(order_total) as revenue from sales group by day""",
    "companies": """
        select company, count(*) as n_orders, sum(order_total) as revenue from sales group by company""",
    "sku_days": """
        select order_date, sku, count(*) as n_orders, round(sum(order_total), 2) as total_revenue
        from sales group by order_date, sku""",
    "members": """
        select c_custkey as user_id, c_mktsegment as company,
               timestamp '2023-05-25 00:00:00' + to_days(cast(c_custkey % 365 as integer)) as created_at
        from customer where c_acctbal >= 0""",
    "places": """
        select c_custkey, c_name, right('00000' || c_nationkey, 5) as zip_code, n_name, r_name
        from customer left join (nation left join region on r_regionkey = n_regionkey)
             on n_nationkey = c_nationkey""",
    "points": """
        select epoch_ns(cast(day as timestamp)) / 1e18 - 1.6095 as x, cast(n as double) as y,
               cast(day as timestamp) as moment
        from days""",
    "loglinear": """
        select exp(regr_intercept(ln(y), x)) as a, regr_slope(ln(y), x) as b, count(*) as n
        from points where y > 0""",
    "countries": """
        select n_name as country, cast(users as double) as pop_2022, cast(sold as double) as pop_2023,
               r_name as continent, r_name || ' ' || right(n_name, 1) as region,
               100.0 * sold / nullif(users, 0) - 100 as pop_change
        from nation left join region on r_regionkey = n_regionkey
             left join (select c_nationkey, count(distinct c_custkey) as users,
                               nullif(count(o_orderkey), 0) as sold
                        from customer left join orders on o_custkey = c_custkey
                        group by c_nationkey) on c_nationkey = n_nationkey""",
    "changed": """
        select source as location, case when lang = 'en' then '__repository__' else lang end as repository,
               lang || '/' || source || '/doc_' || cast(doc_id as varchar) as asset_key
        from documents join labels using (doc_id)
        where toxic = 0 and quality in (0, 1)""",
}

# Needed by a relation, in build order.
NEEDS = {
    "sales": ["lines"],
    "days": ["sales"],
    "companies": ["sales"],
    "sku_days": ["sales"],
    "points": ["days"],
    "loglinear": ["points"],
}


def over(*relations: str, then: str, extra: str = "", recursive: bool = False) -> str:
    """SQL text with the named relations, and all they need, in front."""
    wanted: list[str] = []

    def take(name: str) -> None:
        for needed in NEEDS.get(name, []):
            take(needed)
        if name not in wanted:
            wanted.append(name)

    for name in relations:
        take(name)
    ctes = [f"{name} as ({RELATIONS[name]})" for name in wanted]
    if extra:
        ctes.append(extra)
    return f"with {'recursive ' if recursive else ''}{', '.join(ctes)} {then}"


# Gauss-Newton from the log-linear line; far more steps than it needs to settle.
FITTED = """
    fit(i, a, b) as (
        select 0, a, b from loglinear
        union all
        select i + 1, a + (bb * ar - ab * br) / (aa * bb - ab * ab),
               b + (aa * br - ab * ar) / (aa * bb - ab * ab)
        from (select i, a, b, sum(e * e) as aa, sum(e * a * x * e) as ab, sum(a * x * e * a * x * e) as bb,
                     sum(e * (y - a * e)) as ar, sum(a * x * e * (y - a * e)) as br
              from (select i, a, b, x, y, exp(b * x) as e from fit cross join points where i < 20)
              group by i, a, b)
    ),
    model as (select a, b from fit where i = 20)"""


def with_model(*relations: str, then: str, extra: str = "") -> str:
    tail = FITTED if not extra else f"{FITTED}, {extra}"
    return over("loglinear", *relations, then=then, extra=tail, recursive=True)
