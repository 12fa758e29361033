import statistics
from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderloom.functions import timestamps as ts
from orderloom.operators import freshness, windows

ODD = datetime(2024, 3, 10, 2, 35, 7, 123456)  # falls into a clock change in New York


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_expressions_ignore_the_session_zone(spark, zone, name):
    zone(name)
    df = spark.sql("select timestamp_ntz'2024-03-10 02:35:07.123456' as t, 1710038107123L as ms")
    got = df.select(
        ts.start_of_day("t"),
        ts.start_of_hour("t"),
        ts.start_of_month("t"),
        ts.epoch_micros("t"),
        ts.epoch_nanos("t"),
        ts.from_epoch_millis("ms"),
        ts.to_epoch_millis("t"),
        ts.nearest_hour("t"),
        ts.wall_clock(ts.instant("t")),
    ).first()
    micros = int((ODD - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    assert list(got) == [
        datetime(2024, 3, 10),
        datetime(2024, 3, 10, 2),
        datetime(2024, 3, 1),
        micros,
        micros * 1000,
        ODD.replace(microsecond=123000),
        micros // 1000,
        datetime(2024, 3, 10, 3),
        ODD,
    ]


@pytest.mark.parametrize("clock,expected", [("00:30:00", 0), ("01:30:00", 2), ("01:30:00.000001", 2), ("00:30:00.5", 1), ("23:45:00", 24)])
def test_half_hours_round_to_even(spark, clock, expected):
    got = spark.sql(f"select timestamp_ntz'2024-01-01 {clock}' as t").select(ts.nearest_hour("t")).first()[0]
    assert got == datetime(2024, 1, 1) + timedelta(hours=expected)


def test_partitions_are_days(spark):
    got = rows(windows.daily_partitions(spark, "2023-05-25", "2023-05-28"))
    assert [r[0] for r in got] == [datetime(2023, 5, d) for d in (25, 26, 27)]
    assert got[0][1] == datetime(2023, 5, 26)
    assert windows.daily_partitions(spark, "2023-05-25", "2023-05-25").count() == 0


def test_weeks_start_on_sunday(spark):
    days = spark.sql(
        "select explode(sequence(timestamp_ntz'2024-01-06', timestamp_ntz'2024-01-14', interval 1 day)) as order_date, "
        "2L as n_orders, 1.5d as total_revenue"
    )
    assert rows(windows.weekly_rollup(days)) == [
        (datetime(2023, 12, 31), 2, 1.5, 1),
        (datetime(2024, 1, 7), 14, 10.5, 7),
        (datetime(2024, 1, 14), 2, 1.5, 1),
    ]


def test_age_limits_are_exclusive(spark):
    df = spark.createDataFrame(
        [("at warn", datetime(2024, 1, 1, 12)), ("warn", datetime(2024, 1, 1, 11, 59, 59)), ("fail", datetime(2023, 12, 31)), ("none", None)],
        "k string, t timestamp_ntz",
    )
    limits = {"daily": freshness.DAILY_LIMITS, "fail_only": freshness.FAIL_ONLY_LIMITS}
    got = freshness.freshness_status(df, "t", "2024-01-02 00:00:00", limits, "k").select("k", "daily", "fail_only")
    assert rows(got) == [
        ("at warn", "PASS", "PASS"),
        ("fail", "FAIL", "FAIL"),
        ("none", "UNKNOWN", "UNKNOWN"),
        ("warn", "WARN", "PASS"),
    ]


def brute_deadlines(times, start, end, rule):
    from zoneinfo import ZoneInfo

    zone, utc = ZoneInfo(rule.zone), ZoneInfo("UTC")
    out, day = {}, start - timedelta(days=8)
    while day <= end + timedelta(days=8):
        hours = range(24) if rule.every == "hour" else [0]
        for hour in hours:
            local = datetime(day.year, day.month, day.day, hour) + rule.at
            if rule.every == "week" and day.weekday() != 0:
                continue
            due = local.replace(tzinfo=zone).astimezone(utc).replace(tzinfo=None)
            if start <= due <= end:
                out[due] = sum(due - rule.lower_bound <= t <= due for t in times)
        day += timedelta(days=1)
    return sorted((d, n, n > 0) for d, n in out.items())


@pytest.mark.parametrize(
    "rule",
    [
        freshness.EVENING_DEADLINE,
        freshness.MONDAY_DEADLINE,
        freshness.Deadline("hour", timedelta(0), timedelta(hours=1)),
        freshness.Deadline("day", timedelta(hours=9), timedelta(hours=50), "America/Los_Angeles"),
    ],
)
def test_deadlines_match_brute_force_over_a_clock_change(spark, rule):
    start, end = datetime(2024, 3, 8), datetime(2024, 3, 13)
    times = [start + timedelta(minutes=37 * i, microseconds=i % 3) for i in range(180) if i % 40 < 25]
    times += [datetime(2024, 3, 9, 4, 30), datetime(2024, 3, 9, 5, 30), datetime(2024, 3, 11, 8, 27), datetime(2024, 3, 11, 9, 0, 0, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = rows(freshness.freshness_deadline(df, "t", str(start), str(end), rule))
    assert got == brute_deadlines(times, start, end, rule)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.integers(0, 400_000), st.integers(0, 5))), min_size=1, max_size=60))
def test_gaps_match_a_sorted_walk(spark, arrivals):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, start + timedelta(seconds=s)) for k, s in arrivals], "k string, t timestamp_ntz")
    got = rows(freshness.arrival_gaps(df, "k", "t", slice_width=timedelta(hours=7)))
    expected = []
    for key in "ab":
        walk = sorted(s for k, s in arrivals if k == key)
        gaps = [float(b - a) for a, b in zip(walk, walk[1:])]
        if gaps:
            expected.append((key, len(gaps), statistics.fmean(gaps), statistics.pstdev(gaps), max(gaps), gaps[-1]))
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    for found, wanted in zip(got, expected):
        assert found[2:] == pytest.approx(wanted[2:], rel=1e-9, abs=1e-2)


def test_a_long_last_gap_is_anomalous(spark):
    start = datetime(2024, 1, 1)
    steady = [("steady", start + timedelta(hours=i)) for i in range(30)]
    late = [("late", start + timedelta(hours=i)) for i in range(30)] + [("late", start + timedelta(hours=90))]
    once = [("once", start)]
    df = spark.createDataFrame(steady + late + once, "k string, t timestamp_ntz")
    got = freshness.freshness_anomaly(df, "k", "t").select("k", "last_gap", "anomalous")
    assert rows(got) == [("late", 61 * 3600.0, True), ("steady", 3600.0, False)]
