"""Time windows: predicates, partition sequences and weekly roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.timestamps import as_ntz, ntz_literal, start_of_day


def window_predicate(ts: str, start: str, end: str, closed: str = "both") -> Column:
    """``closed='both'`` keeps rows on either end, ``'left'`` is half-open."""
    low, high = ntz_literal(start), ntz_literal(end)
    if closed == "both":
        return (F.col(ts) >= low) & (F.col(ts) <= high)
    if closed == "left":
        return (F.col(ts) >= low) & (F.col(ts) < high)
    raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")


def in_window(df: DataFrame, ts: str, start: str, end: str, closed: str = "both") -> DataFrame:
    return df.where(window_predicate(ts, start, end, closed))


def daily_partitions(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The days of ``[start, end)``, one row each."""
    first, stop = ntz_literal(start), ntz_literal(end)
    days = F.sequence(first, stop, F.expr("interval 1 day"))
    return (
        spark.range(1)
        .select(F.explode(days).alias("part_start"))
        .where(F.col("part_start") < stop)
        .select("part_start", (F.col("part_start") + F.expr("interval 1 day")).alias("part_end"))
    )


def partitions_with_rows(df: DataFrame, ts: str) -> DataFrame:
    """Row count per day partition."""
    return df.groupBy(start_of_day(ts).alias("part_start")).agg(F.count(F.lit(1)).alias("n_rows"))


# The epoch was a Thursday: an offset of three days starts weeks on Sunday.
SUNDAY_OFFSET = "3 days"


def weekly_rollup(order_stats: DataFrame) -> DataFrame:
    """Daily order statistics to weeks that start on Sunday."""
    week = F.window(as_ntz("order_date"), "7 days", "7 days", SUNDAY_OFFSET)
    return (
        order_stats.groupBy(week.alias("week"))
        .agg(
            F.sum("n_orders").alias("n_orders"),
            F.sum("total_revenue").alias("total_revenue"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .select(F.col("week.start").alias("week_start"), "n_orders", "total_revenue", "n_days")
    )
