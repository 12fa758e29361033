"""Freshness of data: age limits, deadlines and unusual gaps."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.timestamps import (
    as_ntz,
    epoch_micros,
    epoch_seconds,
    from_zone,
    ntz_literal,
    seconds,
    start_of_day,
    start_of_hour,
    to_zone,
)


@dataclass(frozen=True)
class AgeLimits:
    """Ages past which data is stale; without a warning age only failing counts."""

    fail: timedelta
    warn: timedelta | None = None


# The limits in use.
DAILY_LIMITS = AgeLimits(fail=timedelta(hours=24), warn=timedelta(hours=12))
WEEKLY_LIMITS = AgeLimits(fail=timedelta(days=7), warn=timedelta(days=2))
REGULAR_LIMITS = AgeLimits(fail=timedelta(days=7), warn=timedelta(days=3))
FAIL_ONLY_LIMITS = AgeLimits(fail=timedelta(hours=24))


def status(age_seconds: Column, limits: AgeLimits) -> Column:
    out = F.when(age_seconds.isNull(), "UNKNOWN").when(age_seconds > limits.fail.total_seconds(), "FAIL")
    if limits.warn is not None:
        out = out.when(age_seconds > limits.warn.total_seconds(), "WARN")
    return out.otherwise("PASS")


def freshness_status(
    df: DataFrame, ts: str, as_of: str, limits: dict[str, AgeLimits], key: str | None = None
) -> DataFrame:
    """Last time, its age at ``as_of`` and one status column per limit, per key or overall."""
    last = F.max(as_ntz(ts)).alias("last_ts")
    latest = df.groupBy(key).agg(last) if key else df.agg(last)
    age = epoch_seconds(ntz_literal(as_of)) - epoch_seconds("last_ts")
    aged = latest.withColumn("age_seconds", age.cast("double"))
    return aged.select("*", *[status(F.col("age_seconds"), l).alias(name) for name, l in limits.items()])


@dataclass(frozen=True)
class Deadline:
    """A recurring deadline in a time zone and how far before it data may land.

    ``every`` is ``hour``, ``day`` or ``week``; ``at`` is the offset into that period,
    where a week starts on Monday. UTC offsets of the zone are multiples of ``offset_step``.
    All times are whole seconds.
    """

    every: str
    at: timedelta
    lower_bound: timedelta
    zone: str = "UTC"
    offset_step: timedelta = timedelta(minutes=15)


# The deadlines in use.
EVENING_DEADLINE = Deadline("day", timedelta(hours=20, minutes=30), timedelta(hours=23), "America/Los_Angeles")
HOURLY_DEADLINE = Deadline("hour", timedelta(0), timedelta(hours=1), "America/Los_Angeles")
MONDAY_DEADLINE = Deadline("week", timedelta(hours=9), timedelta(seconds=1980))

_PERIODS = {"hour": timedelta(hours=1), "day": timedelta(days=1), "week": timedelta(days=7)}


def _period_start(local: Column, every: str) -> Column:
    if every == "hour":
        return start_of_hour(local)
    if every == "day":
        return start_of_day(local)
    return start_of_day(local) - F.make_dt_interval(days=F.weekday(local))


def _deadlines_between(low: Column, high: Column, rule: Deadline) -> Column:
    """UTC deadlines of the periods from the one before ``low`` to the one after ``high``."""
    step = _PERIODS[rule.every]
    first = _period_start(to_zone(low, rule.zone), rule.every) - seconds(step.total_seconds())
    last = _period_start(to_zone(high, rule.zone), rule.every) + seconds(step.total_seconds())
    starts = F.sequence(first, last, seconds(step.total_seconds()))
    return F.transform(starts, lambda s: from_zone(s + seconds(rule.at.total_seconds()), rule.zone))


def freshness_deadlines(df: DataFrame, ts: str, start: str, end: str, rules: Mapping[str, Deadline]) -> DataFrame:
    """For each rule and deadline in ``[start, end]``: rows landed in ``[deadline - lower bound, deadline]``.

    Rows are counted once, by the finest time slot that any rule needs, so what goes on
    grows with the calendar and not with the rows or rules. A slot names the few deadlines
    of each rule it can serve and meets them by equality; deadlines that nothing served
    stay with a count of zero.
    """
    low, high = ntz_literal(start), ntz_literal(end)
    calendar = df.sparkSession.range(1)

    def due_of(name: str, rule: Deadline) -> Column:
        found = F.array_distinct(_deadlines_between(low, high, rule))
        return F.transform(found, lambda d: F.struct(F.lit(name).alias("rule"), d.alias("deadline")))

    def served_by_slot(name: str, rule: Deadline) -> Column:
        back = seconds(rule.lower_bound.total_seconds())
        found = F.array_distinct(_deadlines_between(F.col("_slot"), F.col("_slot") + back, rule))
        return F.transform(
            found,
            lambda d: F.struct(
                F.lit(name).alias("rule"), d.alias("deadline"), (F.col("_slot") >= d - back).alias("_late_enough")
            ),
        )

    due = [due_of(name, rule) for name, rule in rules.items()]
    candidates = [served_by_slot(name, rule) for name, rule in rules.items()]
    wanted = calendar.select(F.inline(F.concat(*due))).where(F.col("deadline").between(low, high))
    longest = max(rule.lower_bound for rule in rules.values())
    spans = [t for rule in rules.values() for t in (rule.at, rule.lower_bound, rule.offset_step)]
    slot = math.gcd(*(int(t.total_seconds()) for t in spans))
    times = (
        df.where(as_ntz(ts).between(low - seconds(longest.total_seconds()), high))
        .select(as_ntz(ts).alias("_ts"), F.window(as_ntz(ts), f"{slot} seconds").alias("_w"))
        .groupBy(F.col("_w.start").alias("_slot"), (F.col("_ts") == F.col("_w.start")).alias("_exact"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Deadlines start a slot, so within that slot only a row at its very start is in time.
    in_time = (F.col("_slot") < F.col("deadline")) | ((F.col("_slot") == F.col("deadline")) & F.col("_exact"))
    served = (
        times.select("_slot", "_exact", "_n", F.inline(F.concat(*candidates)))
        .where(in_time & F.col("_late_enough"))
        .groupBy("rule", "deadline")
        .agg(F.sum("_n").alias("n_rows"))
    )
    return wanted.join(served, ["rule", "deadline"], "left").select(
        "rule",
        "deadline",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        (F.coalesce("n_rows", F.lit(0)) > 0).alias("on_time"),
    )


def freshness_deadline(df: DataFrame, ts: str, start: str, end: str, rule: Deadline) -> DataFrame:
    """``freshness_deadlines`` of a single rule."""
    return freshness_deadlines(df, ts, start, end, {"": rule}).drop("rule")



def arrival_gaps(df: DataFrame, key: str, ts: str, slice_width: timedelta = timedelta(days=1)) -> DataFrame:
    """Per key: number, mean, deviation and maximum of the seconds between neighbouring arrivals, and the last gap.

    Arrivals at the same time are counted first and give gaps of zero. Gaps are taken
    inside time slices of a key and summed per slice; a row per slice then adds the gap
    to the slice before. No task needs all arrivals of one key, and the table is read once.
    Keys with a single arrival have no gap and no row.
    """
    width = int(slice_width.total_seconds() * 1_000_000)
    inside = Window.partitionBy(key, "_slice").orderBy("_t")
    gap, repeats = F.col("_gap"), F.col("_c") - 1
    slices = (
        df.where(F.col(ts).isNotNull())
        .groupBy(key, epoch_micros(ts).alias("_t"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_slice", F.floor(F.col("_t") / width))
        .withColumn("_gap", F.col("_t") - F.lag("_t").over(inside))
        .groupBy(key, "_slice")
        .agg(
            F.sum(repeats + F.when(gap.isNull(), 0).otherwise(1)).alias("_n"),
            F.coalesce(F.sum("_gap"), F.lit(0)).alias("_s1"),
            F.coalesce(F.sum(gap.cast("double") * gap), F.lit(0.0)).alias("_s2"),
            F.max(F.coalesce(gap, F.when(repeats > 0, 0))).alias("_max"),
            # A repeated arrival at the last time makes the last gap zero.
            F.max_by(F.when(repeats > 0, 0).otherwise(gap), "_t").alias("_end"),
            F.min("_t").alias("_first"),
            F.max("_t").alias("_last"),
        )
    )
    before = F.lag("_last").over(Window.partitionBy(key).orderBy("_slice"))
    joined = slices.withColumn("_jump", F.col("_first") - before)
    jump = F.col("_jump")
    total = joined.groupBy(key).agg(
        F.sum(F.col("_n") + F.when(jump.isNull(), 0).otherwise(1)).alias("n_gaps"),
        F.sum(F.col("_s1") + F.coalesce(jump, F.lit(0))).alias("_s1"),
        F.sum(F.col("_s2") + F.coalesce(jump.cast("double") * jump, F.lit(0.0))).alias("_s2"),
        F.max(F.greatest("_max", "_jump")).alias("_max"),
        F.max_by(F.coalesce("_end", "_jump"), "_slice").alias("_end"),
    )
    mean = F.col("_s1") / F.col("n_gaps")
    spread = F.sqrt(F.greatest(F.col("_s2") / F.col("n_gaps") - mean * mean, F.lit(0.0)))
    second = F.lit(1e6)
    return total.where(F.col("n_gaps") > 0).select(
        key,
        "n_gaps",
        (mean / second).alias("mean_gap"),
        (spread / second).alias("sd_gap"),
        (F.col("_max") / second).alias("max_gap"),
        (F.col("_end") / second).alias("last_gap"),
    )


def freshness_anomaly(
    df: DataFrame, key: str, ts: str, sigmas: float = 3.0, slice_width: timedelta = timedelta(days=1)
) -> DataFrame:
    """Per key: is the last gap between arrivals longer than mean plus ``sigmas`` deviations?

    The rule is a choice of this library.
    """
    limit = F.col("mean_gap") + F.lit(float(sigmas)) * F.col("sd_gap")
    return arrival_gaps(df, key, ts, slice_width).withColumn("anomalous", F.col("last_gap") > limit)


# Size of the sketches of gaps: ranks are off by at most about 0.13 % of a key's gaps, and exact below so many.
SKETCH_SIZE = 4096


def gap_quantile(
    df: DataFrame, key: str, ts: str, quantile: float = 0.99, slice_width: timedelta = timedelta(days=1)
) -> DataFrame:
    """Per key: is the last gap between arrivals longer than the ``quantile`` of all its gaps?

    Arrivals at the same time are one. The gaps inside each time slice of a key go into a sketch; a
    key's sketches are merged, and the gaps between slices make one more. No task needs all arrivals
    of a key. The quantile of n gaps is the one of rank ``ceil(quantile * n)``. Keys with a single
    arrival time have no gap and no row.
    """
    width = int(slice_width.total_seconds() * 1_000_000)
    inside = Window.partitionBy(key, "_slice").orderBy("_t")
    sketch = lambda value: F.kll_sketch_agg_bigint(value, SKETCH_SIZE)
    slices = (
        df.where(F.col(ts).isNotNull())
        .select(key, epoch_micros(ts).alias("_t"))
        .distinct()
        .withColumn("_slice", F.floor(F.col("_t") / width))
        .withColumn("_gap", F.col("_t") - F.lag("_t").over(inside))
        .groupBy(key, "_slice")
        .agg(
            F.count("_gap").alias("_n"),
            sketch("_gap").alias("_sketch"),
            F.max_by("_gap", "_t").alias("_end"),
            F.min("_t").alias("_first"),
            F.max("_t").alias("_last"),
        )
    )
    before = F.lag("_last").over(Window.partitionBy(key).orderBy("_slice"))
    merged = F.kll_sketch_merge_bigint(F.kll_merge_agg_bigint("_sketch", SKETCH_SIZE), sketch("_jump"))
    total = (
        slices.withColumn("_jump", F.col("_first") - before)
        .groupBy(key)
        .agg(
            (F.sum("_n") + F.count("_jump")).alias("n_gaps"),
            merged.alias("_sketch"),
            F.max_by(F.coalesce("_end", "_jump"), "_slice").alias("_end"),
        )
        .where("n_gaps > 0")
    )
    limit = F.kll_sketch_get_quantile_bigint("_sketch", F.lit(float(quantile)))
    return total.select(
        key,
        "n_gaps",
        (limit / 1e6).alias("limit_gap"),
        (F.col("_end") / 1e6).alias("last_gap"),
        (F.col("_end") > limit).alias("anomalous"),
    )
