"""Order forecast: fit the growth curve, apply it, measure its error."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.curve import centred_time, growth_at
from orderloom.functions.timestamps import as_ntz, day_series, start_of_month
from orderloom.session import materialise

START = (5.0, 5.0)
HORIZON_DAYS = 30
# A squared error this small against the squared data is rounding, not misfit.
_ROUNDING = 1e-26
# Relative step from which on the full step is taken, growth of the squared error that is rounding,
# and the step below which one that does not shrink is rounding too.
_NEAR = 1e-4
_LEVEL = 1e-10
_ROUNDED_STEP = 1e-9


@dataclass(frozen=True)
class ForecastModel:
    """Parameters of the curve, its squared error and the number of points."""

    a: float
    b: float
    sse: float
    n: int

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The model as a one-row table."""
        return spark.range(1).select(
            F.lit(self.a).cast("double").alias("a"),
            F.lit(self.b).cast("double").alias("b"),
            F.lit(self.sse).cast("double").alias("sse"),
            F.lit(self.n).cast("bigint").alias("n"),
        )

    @classmethod
    def from_frame(cls, frame: DataFrame) -> ForecastModel:
        row = frame.select("a", "b", "sse", "n").first()
        return cls(row["a"], row["b"], row["sse"], row["n"])


def _points(summary: DataFrame) -> DataFrame:
    return summary.select(
        centred_time("order_date").alias("x"), F.col("num_orders").cast("double").alias("y")
    ).where(F.col("x").isNotNull() & F.col("y").isNotNull())


def loglinear_frame(summary: DataFrame) -> DataFrame:
    """Least squares of ``ln y`` on the centred time, as a one-row table."""
    points = _points(summary).where(F.col("y") > 0)
    return points.agg(
        F.exp(F.regr_intercept(F.ln("y"), F.col("x"))).alias("a"),
        F.regr_slope(F.ln("y"), F.col("x")).alias("b"),
        F.count(F.lit(1)).alias("n"),
    )


def _normal_sums(points: DataFrame, u: Column, candidates: Sequence[tuple[float, float]]) -> list[dict]:
    """Squared error and normal equations at each candidate, all in one aggregation.

    The candidates enter as one constant array, so every pass runs the same compiled code.
    """
    tried = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(level).alias("level"), F.lit(rate).alias("rate"))
            for i, (level, rate) in enumerate(candidates)
        ]
    )
    y, u_, level = F.col("y"), F.col("u"), F.col("level")
    d_level = F.exp(F.col("rate") * u_)
    d_rate, r = u_ * level * d_level, y - level * d_level
    terms = {
        "sse": r * r,
        "ll": d_level * d_level,
        "lr": d_level * d_rate,
        "rr": d_rate * d_rate,
        "le": d_level * r,
        "re": d_rate * r,
    }
    sums = (
        points.select("y", u.alias("u"), F.inline(tried))
        .groupBy("i")
        .agg(*[F.sum(term).alias(name) for name, term in terms.items()])
    )
    return [row.asDict() for row in sorted(sums.collect(), key=lambda row: row["i"])]


def _step(sums: dict, damping: float) -> tuple[float, float]:
    ll, rr, lr = sums["ll"] * (1 + damping), sums["rr"] * (1 + damping), sums["lr"]
    det = ll * rr - lr * lr
    if det == 0 or not math.isfinite(det):
        return math.nan, math.nan
    return (rr * sums["le"] - lr * sums["re"]) / det, (ll * sums["re"] - lr * sums["le"]) / det


def fit(
    summary: DataFrame,
    a_init: float = START[0],
    b_init: float = START[1],
    tolerance: float = 1e-12,
    max_passes: int = 100,
    stored: bool = False,
) -> ForecastModel:
    """Nonlinear least squares of the growth curve on ``(order_date, num_orders)``.

    Damped Gauss-Newton: each pass is one aggregation over the points that evaluates
    several damping values together and returns six sums for each. The points are
    written once, so no pass recomputes the summary; ``stored`` says that the summary
    is a stored table already. The search runs over the level of
    the curve at the mean time and its rate per standard deviation of time, which do
    not hide each other when the dates lie close together. The better of the given
    start and the log-linear line opens it.
    """
    points = _points(summary) if stored else materialise(_points(summary), "forecast-points")
    log_y = F.when(F.col("y") > 0, F.ln("y"))
    seen = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("y") * F.col("y")).alias("yy"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("sd"),
        F.regr_intercept(log_y, F.col("x")).alias("log_a"),
        F.regr_slope(log_y, F.col("x")).alias("log_b"),
    ).first()
    n, mean, sd = seen["n"], seen["mean"], seen["sd"]
    if n < 2 or not sd:
        raise ValueError("the curve has two parameters and needs points at two times at least")
    u = (F.col("x") - F.lit(mean)) / F.lit(sd)
    starts = [(float(a_init) * math.exp(b_init * mean), float(b_init) * sd)]
    if seen["log_a"] is not None and seen["log_b"] is not None:
        starts.append((math.exp(seen["log_a"] + seen["log_b"] * mean), seen["log_b"] * sd))

    def best(candidates):
        ok = [c for c in candidates if all(map(math.isfinite, c))]
        if not ok:
            return None
        scored = [(s["sse"], c, s) for c, s in zip(ok, _normal_sums(points, u, ok)) if math.isfinite(s["sse"])]
        return min(scored, key=lambda item: item[0]) if scored else None

    def relative(step, level: float, rate: float) -> float:
        size = max(abs(step[0]) / max(abs(level), 1e-300), abs(step[1]) / max(abs(rate), 1e-6))
        return size if math.isfinite(size) else math.inf

    def model(level: float, rate: float, sse: float) -> ForecastModel:
        b = rate / sd
        return ForecastModel(level * math.exp(-b * mean), b, sse, n)

    found = best(starts)
    if found is None:
        raise ValueError("the curve cannot be evaluated at the start values")
    sse, (level, rate), sums = found
    damping, before = 1e-3, 0.0
    for _ in range(max_passes):
        if sse <= _ROUNDING * seen["yy"]:
            return model(level, rate, sse)
        steps = [_step(sums, t) for t in (0.0, damping, damping * 1e2, damping * 1e4)]
        # Near the optimum the squared error is flat and cannot tell steps apart; the full step,
        # which follows from the gradient, is exact there and is taken while the error stays level.
        near = relative(steps[0], level, rate) <= _NEAR
        found = best([(level + dl, rate + dr) for dl, dr in (steps[:1] if near else steps)])
        if found is None or not found[0] < sse * (1 + _LEVEL if near else 1):
            if near or damping > 1e12:
                return model(level, rate, sse)
            damping *= 1e6
            continue
        move = relative((found[1][0] - level, found[1][1] - rate), level, rate)
        sse, (level, rate), sums = found
        damping = max(damping / 10, 1e-12)
        # Steps shrink by a steady factor near the optimum, which bounds what is left to go. Small
        # steps that no longer shrink are the rounding of the gradient.
        shrink = move / before if before else 1.0
        left = move * shrink / (1 - shrink) if 0 < shrink < 0.5 else move
        if left <= tolerance or (move <= _ROUNDED_STEP and shrink >= 0.5):
            return model(level, rate, sse)
        before = move
    raise RuntimeError(f"the curve did not settle in {max_passes} passes")


def predicted_orders(summary: DataFrame, model: ForecastModel) -> DataFrame:
    """The curve on the last observed day and the thirty days after it."""
    last = summary.agg(F.max(as_ntz("order_date")).alias("last_date"))
    days = last.select(F.explode(day_series(F.col("last_date"), HORIZON_DAYS)).alias("order_date"))
    return days.withColumn("num_orders", growth_at("order_date", model.a, model.b))


def observed_months(summary: DataFrame) -> DataFrame:
    """First days of the months from the first to the last observed day."""
    span = summary.agg(
        F.min(start_of_month("order_date")).alias("lo"), F.max(start_of_month("order_date")).alias("hi")
    )
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start"))


def model_stats_by_month(
    summary: DataFrame, model: ForecastModel, months: DataFrame, match: str = "month"
) -> DataFrame:
    """Observed minus predicted orders for each month start.

    The prediction covers the month start and the thirty days after it. By default the
    observed side takes that month of the year in every year; ``match='year_month'``
    takes that month only.
    """
    if match not in ("month", "year_month"):
        raise ValueError(f"match must be 'month' or 'year_month', not {match!r}")
    date = as_ntz("order_date")
    key = F.month(date) if match == "month" else start_of_month("order_date")
    observed = summary.groupBy(key.alias("_key")).agg(F.sum("num_orders").alias("_observed"))
    predicted = (
        months.select("month_start", F.explode(day_series(F.col("month_start"), HORIZON_DAYS)).alias("day"))
        .groupBy("month_start")
        .agg(F.sum(growth_at("day", model.a, model.b)).alias("_predicted"))
    )
    target = F.month("month_start") if match == "month" else F.col("month_start")
    return (
        predicted.withColumn("_key", target)
        .join(observed, "_key", "left")
        .select("month_start", (F.coalesce("_observed", F.lit(0)) - F.col("_predicted")).alias("error"))
    )


def fit_overlay(summary: DataFrame, model: ForecastModel) -> DataFrame:
    """Observed points and the curve at the same dates, tagged by ``type``."""
    observed = summary.select("order_date", F.col("num_orders").cast("double").alias("num_orders"))
    predicted = observed.withColumn("num_orders", growth_at("order_date", model.a, model.b))
    return observed.withColumn("type", F.lit("observed")).unionByName(
        predicted.withColumn("type", F.lit("predicted"))
    )


def straight_lines(overlay: DataFrame) -> DataFrame:
    """A straight line through each series of the overlay, over the centred time."""
    x = centred_time("order_date")
    return overlay.groupBy("type").agg(
        F.regr_slope("num_orders", x).alias("slope"),
        F.regr_intercept("num_orders", x).alias("intercept"),
        F.count(F.lit(1)).alias("n"),
    )
