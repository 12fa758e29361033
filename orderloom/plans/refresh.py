"""Jobs over a table store: ingest, refresh the models of a window, forecast, enrich, check."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from orderloom.operators import augment, cleaned, forecast, ingest, profile, quality, regression, stats
from orderloom.operators.enrichment import enrich
from orderloom.schemas import RAW_ORDERS, RAW_USERS
from orderloom.session import side_by_side
from orderloom.sources.tables import GRAINS, TableStore

# The schema each table is stored in.
ORDERS, USERS, LOCATIONS = "raw_data.orders", "raw_data.users", "raw_data.locations"
ORDERS_CLEANED, USERS_CLEANED = "cleaned.orders_cleaned", "cleaned.users_cleaned"
LOCATIONS_CLEANED, ORDERS_AGGREGATED = "cleaned.locations_cleaned", "cleaned.orders_aggregated"
ORDERS_AUGMENTED, COMPANY_STATS = "analytics.orders_augmented", "analytics.company_stats"
SKU_STATS, ORDER_STATS = "analytics.sku_stats", "analytics.order_stats"
WEEKLY_SUMMARY, COMPANY_PERF = "analytics.weekly_order_summary", "analytics.company_perf"
TOP_USERS, AVG_ORDERS = "marketing.top_users", "marketing.avg_orders"
MIN_ORDER, DEEPDIVE = "marketing.min_order", "marketing.key_product_deepdive"
MODEL, PREDICTED = "forecasting.order_forecast_model", "forecasting.predicted_orders"
BIG_ORDERS, ALL_ORDERS = "forecasting.big_orders", "forecasting.all_orders"
COUNTRY_STATS, CHANGE_MODEL = "countries.country_stats", "countries.change_model"
CONTINENT_STATS = "countries.continent_stats"
MODEL_STATS, ENRICHED = "forecasting.model_stats_by_month", "enrichment.enriched_data"


def ingest_window(
    store: TableStore, order_pages: DataFrame, user_pages: DataFrame, start: str, end: str, grain: str = "day"
) -> None:
    """Load the payload pages of ``[start, end)``; running it again replaces the same partitions."""
    orders = ingest.load_partitions(order_pages, RAW_ORDERS, start, end)
    users = ingest.load_partitions(user_pages, RAW_USERS, start, end)
    store.replace_window(orders, ORDERS, "dt", start, end, grain)
    store.replace_window(users, USERS, "created_at", start, end, grain)


def refresh_models(
    store: TableStore, start: str | None = None, end: str | None = None, grain: str = "day"
) -> None:
    """Rebuild all models; with a window the dated ones only for its partitions.

    Each table is stored once and read by the ones after it, so the joined orders are
    not computed again for each of their readers. Tables that do not read each other are
    written side by side, so the last tasks of one leave no core idle.
    """

    def dated(table: str) -> DataFrame:
        return store.read_window(table, start, end)

    def put(df: DataFrame, table: str, expr: str, spread: bool = True) -> None:
        store.replace_window(df, table, expr, start, end, grain, spread)

    # The next two go row by row over a table of the same partitions: no row has to move.
    def clean_orders() -> None:
        raw = store.read_window(ORDERS, start, end, grain)
        keep = tuple(c for c in raw.columns if c == GRAINS[grain])
        put(cleaned.orders_cleaned(raw, keep=keep), ORDERS_CLEANED, "dt", spread=False)

    def copy_orders() -> None:
        rows = store.read_window(ORDERS_CLEANED, start, end, grain)
        put(cleaned.orders_aggregated(rows), ORDERS_AGGREGATED, "dt", spread=False)

    def clean_users() -> None:
        store.replace(cleaned.users_cleaned(store.read(USERS)), USERS_CLEANED)

    def clean_locations() -> None:
        store.replace(cleaned.locations_cleaned(store.read(LOCATIONS)), LOCATIONS_CLEANED)

    def join_orders() -> None:
        joined = augment.orders_augmented(
            dated(ORDERS_CLEANED), store.read(USERS_CLEANED), store.read(LOCATIONS_CLEANED)
        )
        put(profile.annotate(joined, "orders_augmented"), ORDERS_AUGMENTED, "order_date")

    def by_company() -> None:
        put(stats.company_stats(dated(ORDERS_AUGMENTED)), COMPANY_STATS, "order_date")
        perf = store.replace(stats.company_perf(store.read(COMPANY_STATS)), COMPANY_PERF)
        store.replace(stats.top_users(store.read(ORDERS_AUGMENTED), perf), TOP_USERS)
        store.replace(stats.avg_orders(perf), AVG_ORDERS)
        store.replace(stats.min_order(perf), MIN_ORDER)

    def by_sku() -> None:
        put(stats.sku_stats(dated(ORDERS_AUGMENTED)), SKU_STATS, "order_date")

    def by_day() -> None:
        put(stats.order_stats(dated(ORDERS_AUGMENTED)), ORDER_STATS, "order_date")
        put(stats.weekly_order_summary(dated(ORDER_STATS)), WEEKLY_SUMMARY, "order_date")

    side_by_side(store.spark, clean_orders, clean_users, clean_locations)
    side_by_side(store.spark, join_orders, copy_orders)
    side_by_side(store.spark, by_company, by_sku, by_day)


def publish_products(store: TableStore) -> DataFrame:
    """One folder per item for readers that take a single item."""
    return store.replace_by_key(store.read_window(SKU_STATS), DEEPDIVE, "sku")


def run_forecast(store: TableStore, capacity: float = 50) -> forecast.ForecastModel:
    summary = store.read_window(WEEKLY_SUMMARY)
    model = forecast.fit(summary, stored=True)
    store.replace(model.to_frame(store.spark), MODEL)
    predicted = store.replace(forecast.predicted_orders(summary, model), PREDICTED)
    store.replace(stats.big_orders(predicted, capacity), BIG_ORDERS)
    store.replace(stats.all_orders(predicted), ALL_ORDERS)
    months = forecast.observed_months(summary)
    store.replace(forecast.model_stats_by_month(summary, model, months), MODEL_STATS)
    return model


def run_country_chain(store: TableStore, cells: DataFrame) -> DataFrame:
    """The country table, its linear model and the continents with their coefficient, each stored."""
    rows = store.replace(regression.country_stats(cells), COUNTRY_STATS)
    model = store.replace(regression.change_model(rows), CHANGE_MODEL)
    return store.replace(regression.continent_stats(rows, model), CONTINENT_STATS)


def load_model(store: TableStore) -> forecast.ForecastModel:
    return forecast.ForecastModel.from_frame(store.read(MODEL))


def run_enrichment(store: TableStore, rows: DataFrame, provider: Callable[[int], str], **settings) -> DataFrame:
    return store.replace(enrich(rows, provider, **settings), ENRICHED)


def run_checks(store: TableStore) -> DataFrame:
    """One verdict row per check on the stored tables."""
    orders, joined = store.read(ORDERS_CLEANED), store.read(ORDERS_AUGMENTED)
    users = store.read(USERS_CLEANED)
    verdicts = [
        quality.failing_rows_verdict(quality.not_null(orders, "user_id"), "orders_cleaned.user_id not null", quality.ERROR),
        quality.failing_rows_verdict(quality.not_null(joined, "user_id"), "orders_augmented.user_id not null", quality.ERROR),
        quality.failing_rows_verdict(quality.greater_than_zero(orders, "order_total"), "order_total above zero"),
        quality.failing_rows_verdict(quality.order_total_not_positive(orders), "order totals not zero"),
        quality.failing_rows_verdict(quality.like_patterns(users, "company"), "company name pattern"),
        quality.check_users(store.read(USERS)),
        quality.check_avg_orders(store.read(AVG_ORDERS)),
    ]
    return reduce(DataFrame.unionByName, verdicts)
