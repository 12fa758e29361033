import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import forecast
from orderloom.plans import queries_models

START = datetime(2023, 5, 25)


def curve(day, a, b):
    ns = (day - datetime(1970, 1, 1)) / timedelta(microseconds=1) * 1000
    return a * math.exp(b * (ns / 1e18 - 1.6095))


def summary(spark, values):
    data = [(START + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "order_date timestamp_ntz, num_orders double")


def test_exact_curves_are_found_from_the_default_start(spark):
    days = [START + timedelta(days=i) for i in range(40)]
    model = forecast.fit(summary(spark, [curve(d, 7.25, 3.5) for d in days]))
    assert model.a == pytest.approx(7.25, rel=1e-6) and model.b == pytest.approx(3.5, rel=1e-5)
    assert model.sse == pytest.approx(0, abs=1e-9) and model.n == 40


def test_fit_is_the_least_squares_optimum(spark):
    rng = np.random.default_rng(3)
    values = [max(curve(START + timedelta(days=i * 20), 6.0, 2.0) + rng.normal(0, 2), 0.0) for i in range(60)]
    data = [(START + timedelta(days=20 * i), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "order_date timestamp_ntz, num_orders double")
    model = forecast.fit(df)
    x = np.array([(d - datetime(1970, 1, 1)).total_seconds() * 1e9 / 1e18 - 1.6095 for d, _ in data])
    y = np.array(values)
    r = y - model.a * np.exp(model.b * x)
    e = np.exp(model.b * x)
    # At the optimum the residual is orthogonal to both derivatives.
    assert abs(r @ e) < 1e-5 * np.linalg.norm(e) * np.linalg.norm(r)
    assert abs(r @ (model.a * x * e)) < 1e-5 * np.linalg.norm(model.a * x * e) * np.linalg.norm(r)
    assert model.sse == pytest.approx(float(r @ r), rel=1e-9)


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_fit_agrees_with_extended_precision(spark, scale):
    """On the given orders the parameters are those of Newton steps in long double."""
    days = queries_models.summary(spark, f"/root/testdata/sf{scale}")
    model = forecast.fit(days)
    data = days.select("order_date", "num_orders").collect()
    ns = [np.longdouble((d - datetime(1970, 1, 1)) // timedelta(microseconds=1)) * 1000 for d, _ in data]
    x = np.array(ns) / np.longdouble(10) ** 18 - np.longdouble(16095) / 10000
    y = np.array([np.longdouble(int(n)) for _, n in data])
    a, b = np.longdouble(model.a), np.longdouble(model.b)
    for _ in range(30):
        e = np.exp(b * x)
        r, de, dr = y - a * e, e, a * x * e
        ll, lr, rr = de @ de, de @ dr, dr @ dr
        # Second derivatives make these steps Newton's, so they end at the optimum whatever its curvature.
        lr2, rr2 = lr - r @ (x * e), rr - r @ (a * x * x * e)
        det = ll * rr2 - lr2 * lr2
        a, b = a + (rr2 * (de @ r) - lr2 * (dr @ r)) / det, b + (ll * (dr @ r) - lr2 * (de @ r)) / det
    assert model.a == pytest.approx(float(a), rel=1e-11) and model.b == pytest.approx(float(b), rel=1e-11)


def test_fit_needs_two_points(spark):
    with pytest.raises(ValueError):
        forecast.fit(summary(spark, [1.0]))


def test_model_table_round_trip(spark, tmp_path):
    model = forecast.ForecastModel(5.0, -0.25, 1.5, 10)
    model.to_frame(spark).write.parquet(str(tmp_path / "m"))
    assert forecast.ForecastModel.from_frame(spark.read.parquet(str(tmp_path / "m"))) == model


def test_forecast_covers_the_last_day_and_thirty_more(spark):
    model = forecast.ForecastModel(5.0, 5.0, 0.0, 0)
    got = rows(forecast.predicted_orders(summary(spark, [1.0, 2.0, 3.0]), model))
    last = START + timedelta(days=2)
    assert [r[0] for r in got] == [last + timedelta(days=i) for i in range(31)]
    assert got[4][1] == pytest.approx(curve(last + timedelta(days=4), 5, 5), rel=1e-12)


def test_month_error_takes_every_year_or_one(spark):
    model = forecast.ForecastModel(2.0, 0.5, 0.0, 0)
    data = [(datetime(2022, 1, 5), 10), (datetime(2023, 1, 6), 20), (datetime(2023, 2, 1), 40)]
    df = spark.createDataFrame(data, "order_date timestamp_ntz, num_orders long")
    months = spark.createDataFrame([(datetime(2023, 1, 1),), (datetime(2023, 3, 1),)], "month_start timestamp_ntz")
    predicted = {m: sum(curve(m + timedelta(days=i), 2.0, 0.5) for i in range(31)) for m in (datetime(2023, 1, 1), datetime(2023, 3, 1))}
    every = dict(rows(forecast.model_stats_by_month(df, model, months)))
    single = dict(rows(forecast.model_stats_by_month(df, model, months, match="year_month")))
    assert every[datetime(2023, 1, 1)] == pytest.approx(30 - predicted[datetime(2023, 1, 1)])
    assert single[datetime(2023, 1, 1)] == pytest.approx(20 - predicted[datetime(2023, 1, 1)])
    assert every[datetime(2023, 3, 1)] == pytest.approx(-predicted[datetime(2023, 3, 1)])
    spread = forecast.observed_months(df)
    assert spread.count() == 14 and spread.agg(F.min("month_start")).first()[0] == datetime(2022, 1, 1)


def test_overlay_has_both_series(spark):
    model = forecast.ForecastModel(5.0, 1.0, 0.0, 0)
    overlay = forecast.fit_overlay(summary(spark, [1.0, 2.0, 3.0]), model)
    assert dict(overlay.groupBy("type").count().collect()) == {"observed": 3, "predicted": 3}
    lines = {r["type"]: r for r in forecast.straight_lines(overlay).collect()}
    assert lines["observed"]["slope"] == pytest.approx(1 / (86400e9 / 1e18), rel=1e-6)
