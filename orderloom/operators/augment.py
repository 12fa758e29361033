"""Orders with the company and location of their user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.joins import BROADCAST_BYTES, small
from orderloom.operators.windows import in_window


def orders_augmented(
    orders: DataFrame,
    users: DataFrame,
    locations: DataFrame,
    start: str | None = None,
    end: str | None = None,
    closed: str = "both",
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join of orders with users and with locations on the user.

    Unmatched orders keep NULLs; a user listed twice doubles that user's orders.
    Sides known or measured to be small are broadcast and the orders stay where they are.
    Larger ones are merged with each other first, which gives the same rows: the
    orders then meet a single shuffled join, whose hot users adaptive execution can split.
    """
    if start is not None:
        orders = in_window(orders, "order_date", start, end, closed)
    company = users.select("user_id", "company")
    place = locations.select("user_id", "state", "zip_code")
    if small(broadcast_limit, company, place):
        joined = orders.join(F.broadcast(company), "user_id", "left")
        joined = joined.join(F.broadcast(place), "user_id", "left")
    else:
        joined = orders.join(company.join(place, "user_id", "full"), "user_id", "left")
    return joined.select(*[orders[c] for c in orders.columns], "company", "state", "zip_code")
