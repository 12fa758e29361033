"""Cleaned tables: raw orders, users and locations with settled names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.timestamps import as_ntz
from orderloom.operators.windows import in_window
from orderloom.schemas import LOAD_STAMP


def orders_cleaned(
    raw_orders: DataFrame,
    start: str | None = None,
    end: str | None = None,
    closed: str = "both",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Orders with their total; with a window only the orders placed in it. ``keep`` names further columns to keep."""
    rows = raw_orders if start is None else in_window(raw_orders, "dt", start, end, closed)
    return rows.select(
        "user_id",
        "quantity",
        "purchase_price",
        "sku",
        "dt",
        F.col("dt").alias("dt_2"),
        as_ntz("dt").alias("order_date"),
        (F.col("quantity") * F.col("purchase_price")).alias("order_total"),
        *keep,
    )


def orders_aggregated(cleaned: DataFrame) -> DataFrame:
    """All orders as they are: in spite of its name this table is not aggregated."""
    return cleaned.select("*")


def users_cleaned(raw_users: DataFrame) -> DataFrame:
    """Users without test accounts; an unknown flag is dropped too."""
    return raw_users.where(~F.col("is_test_user")).select("user_id", "created_at", "company")


def locations_cleaned(raw_locations: DataFrame) -> DataFrame:
    return raw_locations.select(
        F.col("l_user_id").alias("user_id"),
        F.col("l_street_address").alias("street_address"),
        F.col("l_state").alias("state"),
        F.col("l_country").alias("country"),
        F.col("l_zip_code").alias("zip_code"),
        LOAD_STAMP,
    )
