"""Queries over the forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators import forecast, stats
from orderloom.plans.queries_models import summary
from orderloom.plans.registry import over, query, with_model
from orderloom.session import materialise, scratch_path
from orderloom.sources.tables import TableStore


def stored_summary(spark, folder):
    """Daily order counts, stored once because fit and forecast both read them."""
    return materialise(summary(spark, folder), "daily-orders")


@query("forecast_fit_loglinear", over("loglinear", then="""
    select round(a, 4) as a, round(b, 4) as b, n from loglinear"""))
def forecast_fit_loglinear(spark, folder):
    line = forecast.loglinear_frame(summary(spark, folder))
    return line.select(F.round("a", 4).alias("a"), F.round("b", 4).alias("b"), "n")


@query("forecast_fit", with_model(then="""
    select round(a, 4) as a, round(b, 4) as b,
           (select round(sum((y - model.a * exp(model.b * x)) * (y - model.a * exp(model.b * x))), 2)
            from points) as sse, (select count(*) from points) as n from model"""))
def forecast_fit(spark, folder):
    """The fitted model, stored as a table and read back."""
    store = TableStore(spark, scratch_path(spark, "models"))
    model = forecast.fit(stored_summary(spark, folder), stored=True)
    kept = store.replace(model.to_frame(spark), "forecasting.order_forecast_model")
    return kept.select(F.round("a", 4).alias("a"), F.round("b", 4).alias("b"), F.round("sse", 2).alias("sse"), "n")


_PREDICTED = """
    predicted as (
        select d as order_date, a * exp(b * (epoch_ns(d) / 1e18 - 1.6095)) as num_orders
        from model cross join (
            select unnest(generate_series(hi, hi + interval 30 days, interval 1 day)) as d
            from (select max(moment) as hi from points)))"""


def predicted(spark, folder):
    days = stored_summary(spark, folder)
    return forecast.predicted_orders(days, forecast.fit(days, stored=True))


@query("predicted_orders", with_model(extra=_PREDICTED, then="""
    select order_date, round(num_orders, 3) as num_orders from predicted"""))
def predicted_orders(spark, folder):
    return predicted(spark, folder).withColumn("num_orders", F.round("num_orders", 3))


@query("all_orders", with_model(extra=_PREDICTED, then="""
    select order_date, round(num_orders, 3) as num_orders from predicted"""))
def all_orders(spark, folder):
    return stats.all_orders(predicted(spark, folder)).withColumn("num_orders", F.round("num_orders", 3))


@query("big_orders", with_model(extra=_PREDICTED, then="""
    select order_date, round(num_orders, 3) as num_orders from predicted where num_orders >= 50"""))
def big_orders(spark, folder):
    return stats.big_orders(predicted(spark, folder)).withColumn("num_orders", F.round("num_orders", 3))


@query("big_orders_tight", with_model(extra=_PREDICTED, then="""
    select order_date, round(num_orders, 3) as num_orders from predicted
    where num_orders >= (select 0.65 * min(num_orders) + 0.35 * max(num_orders) from predicted)"""))
def big_orders_tight(spark, folder):
    """A capacity inside the range of the forecast, so that at every scale some days reach it and some do not."""
    days = predicted(spark, folder)
    low, high = days.agg(F.min("num_orders"), F.max("num_orders")).first()
    big = stats.big_orders(days, capacity=0.65 * low + 0.35 * high)
    return big.withColumn("num_orders", F.round("num_orders", 3))


_MONTHS = """
    months as (select unnest(generate_series(date_trunc('month', min(moment)), date_trunc('month', max(moment)),
                                             interval 1 month)) as month_start from points),
    forecast as (select month_start, sum(a * exp(b * (epoch_ns(d) / 1e18 - 1.6095))) as total
                 from (select month_start, unnest(generate_series(month_start, month_start + interval 30 days,
                                                                  interval 1 day)) as d from months)
                      cross join model
                 group by 1)"""


@query("model_stats_by_month", with_model(extra=_MONTHS, then="""
    select cast(f.month_start as timestamp) as month_start, round(coalesce(o.n, 0) - f.total, 2) as error
    from forecast f left join (select month(moment) as m, sum(y) as n from points group by m) o on month(f.month_start) = o.m"""))
def model_stats_by_month(spark, folder):
    days = stored_summary(spark, folder)
    out = forecast.model_stats_by_month(days, forecast.fit(days, stored=True), forecast.observed_months(days))
    return out.withColumn("error", F.round("error", 2))


@query("model_stats_by_year_month", with_model(extra=_MONTHS, then="""
    select cast(f.month_start as timestamp) as month_start, round(coalesce(o.n, 0) - f.total, 2) as error
    from forecast f left join (select date_trunc('month', moment) as m, sum(y) as n from points group by m) o on f.month_start = o.m"""))
def model_stats_by_year_month(spark, folder):
    days = stored_summary(spark, folder)
    months = forecast.observed_months(days)
    out = forecast.model_stats_by_month(days, forecast.fit(days, stored=True), months, match="year_month")
    return out.withColumn("error", F.round("error", 2))


_OVERLAY = """
    overlay as (
        select moment as order_date, x, unnest([y, a * exp(b * x)]) as num_orders,
               unnest(['observed', 'predicted']) as type
        from points cross join model)"""


def overlay(spark, folder):
    days = stored_summary(spark, folder)
    return forecast.fit_overlay(days, forecast.fit(days, stored=True))


@query("model_nb", with_model(extra=_OVERLAY, then="""
    select order_date, round(num_orders, 3) as num_orders, type from overlay"""))
def model_nb(spark, folder):
    return overlay(spark, folder).withColumn("num_orders", F.round("num_orders", 3))


@query("model_nb_lines", with_model(extra=_OVERLAY, then="""
    select type, round(regr_slope(num_orders, x), 3) as slope,
           round(regr_intercept(num_orders, x), 3) as intercept,
           count(*) as n from overlay group by 1"""))
def model_nb_lines(spark, folder):
    lines = forecast.straight_lines(overlay(spark, folder))
    return lines.select("type", F.round("slope", 3).alias("slope"), F.round("intercept", 3).alias("intercept"), "n")
