"""Order statistics by company, item, day and user, and the figures derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.joins import broadcast_if_small
from orderloom.functions.timestamps import start_of_day
from orderloom.operators.windows import in_window


def _count_and_revenue():
    return F.count(F.lit(1)).alias("n_orders"), F.sum("order_total").alias("total_revenue")


def company_stats(augmented: DataFrame) -> DataFrame:
    """Per order time and company; orders without a company form their own group."""
    return augmented.groupBy("order_date", "company").agg(*_count_and_revenue())


def company_stats_from_orders(orders: DataFrame, users: DataFrame, locations: DataFrame) -> DataFrame:
    """``company_stats`` straight from the cleaned tables.

    Orders are summed per user and order time in the map tasks before they meet the companies; the
    number of user and location rows a user has multiplies the sums as the joins would the orders.
    """
    spent = orders.groupBy("user_id", "order_date").agg(*_count_and_revenue())
    memberships = users.groupBy("user_id", "company").agg(F.count(F.lit(1)).alias("_m"))
    places = locations.groupBy("user_id").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
    times = F.coalesce("_m", F.lit(1)) * F.coalesce("_k", F.lit(1))
    joined = spent.join(memberships, "user_id", "left").join(places, "user_id", "left")
    return joined.groupBy("order_date", "company").agg(*_summed_times(times))


def order_stats_from_orders(orders: DataFrame, users: DataFrame, locations: DataFrame) -> DataFrame:
    """``order_stats`` straight from the cleaned tables: sums per user and day, times the rows of the user.

    Only users that the joins would multiply have a row on the other side.
    """
    day = start_of_day("order_date").alias("order_date")
    spent = orders.groupBy("user_id", day).agg(*_count_and_revenue())
    ones = [users.select("user_id", F.lit(1).alias("m"), F.lit(0).alias("k")), locations.select("user_id", F.lit(0).alias("m"), F.lit(1).alias("k"))]
    held = ones[0].unionAll(ones[1]).groupBy("user_id").agg(F.sum("m").alias("m"), F.sum("k").alias("k"))
    many = held.select("user_id", (F.greatest("m", F.lit(1)) * F.greatest("k", F.lit(1))).alias("_times")).where("_times > 1")
    joined = spent.join(many, "user_id", "left")
    return joined.groupBy("order_date").agg(*_summed_times(F.coalesce("_times", F.lit(1))))


def _summed_times(times: Column):
    revenue = F.sum(F.col("total_revenue") * times)
    return F.sum(F.col("n_orders") * times).alias("n_orders"), revenue.alias("total_revenue")


def sku_stats(augmented: DataFrame) -> DataFrame:
    return augmented.groupBy("order_date", "sku").agg(*_count_and_revenue())


def order_stats(
    augmented: DataFrame, start: str | None = None, end: str | None = None, closed: str = "both"
) -> DataFrame:
    """Per day."""
    days = augmented.withColumn("order_date", start_of_day("order_date"))
    if start is not None:
        days = in_window(days, "order_date", start, end, closed)
    return days.groupBy("order_date").agg(*_count_and_revenue())


def weekly_order_summary(
    stats: DataFrame, start: str | None = None, end: str | None = None, closed: str = "both"
) -> DataFrame:
    """Order counts under the name the forecast reads. Rows stay daily."""
    rows = stats if start is None else in_window(stats, "order_date", start, end, closed)
    return rows.select("order_date", F.col("n_orders").alias("num_orders"))


def company_perf(stats: DataFrame) -> DataFrame:
    return stats.groupBy("company").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("total_revenue").alias("total_revenue")
    )


def top_users(augmented: DataFrame, perf: DataFrame) -> DataFrame:
    """Revenue per user and its share of the revenue of the user's company.

    Every user is listed, in no order. Orders are summed per user and company before
    they meet the company totals, so neither the join nor the final sum sees raw orders.
    """
    sums = augmented.groupBy("user_id", "company").agg(F.sum("order_total").alias("_part"))
    return _shares(sums, perf)


def top_users_from_orders(orders: DataFrame, users: DataFrame, locations: DataFrame) -> DataFrame:
    """``top_users`` straight from the cleaned tables.

    Orders are summed per user before the joins; the number of user and location rows
    a user has multiplies that sum exactly as the joins would multiply the orders. The
    per-user result also gives the company totals, so orders are read once. Adaptive
    execution knows the size of the totals before it joins them.
    """
    spent = orders.groupBy("user_id").agg(F.sum("order_total").alias("_spent"))
    memberships = users.groupBy("user_id", "company").agg(F.count(F.lit(1)).alias("_m"))
    places = locations.groupBy("user_id").agg(F.count(F.lit(1)).alias("_k"))
    sums = (
        spent.join(memberships, "user_id", "left")
        .join(places, "user_id", "left")
        .select(
            "user_id",
            "company",
            (F.col("_spent") * F.coalesce("_m", F.lit(1)) * F.coalesce("_k", F.lit(1))).alias("_part"),
        )
    )
    perf = sums.groupBy("company").agg(F.sum("_part").alias("total_revenue"))
    return _shares(sums, perf)


def _shares(sums: DataFrame, perf: DataFrame) -> DataFrame:
    totals = perf.select("company", F.col("total_revenue").alias("_company_revenue"))
    return (
        sums.join(totals, "company", "left")
        .groupBy("user_id")
        .agg(F.sum("_part").alias("total_revenue"), F.max("_company_revenue").alias("_company_revenue"))
        .select(
            "user_id",
            "total_revenue",
            F.try_divide("total_revenue", "_company_revenue").alias("pct_revenue"),
        )
    )


def avg_orders(perf: DataFrame) -> DataFrame:
    """Average order value per company."""
    return perf.select("company", F.try_divide("total_revenue", "n_orders").alias("avg_order"))


def dedupe_latest(df: DataFrame, key: str, at: str) -> DataFrame:
    """The latest row of each key, for tables that are loaded again and again; a NULL time is earliest.

    Of rows of one time the greatest, column by column, stays. Rows are compared in the map tasks
    first, so a key with very many rows is one row per task.
    """
    latest = F.max(F.struct(F.col(at), *[F.col(c) for c in df.columns if c not in (key, at)])).alias("_row")
    kept = df.groupBy(key).agg(latest)
    return kept.select(*[F.col(c) if c == key else F.col(f"_row.`{c}`") for c in df.columns])


def min_order(perf: DataFrame) -> DataFrame:
    """The smallest order count of a company, as one row."""
    return perf.agg(F.min("n_orders").alias("min_order"))


def key_product_deepdive(stats: DataFrame, sku: str) -> DataFrame:
    return stats.where(F.col("sku") == sku)


def preview(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """The first rows in a stated order, for reports."""
    return df.orderBy(*order).limit(rows)


def big_orders(predicted: DataFrame, capacity: float = 50) -> DataFrame:
    """Days that reach the capacity."""
    return predicted.where(F.col("num_orders") >= capacity)


def all_orders(predicted: DataFrame) -> DataFrame:
    return predicted.select("order_date", "num_orders")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def lookup_join(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Attach the attributes of a keyed table to each row."""
    return df.join(broadcast_if_small(lookup), key, "left")
