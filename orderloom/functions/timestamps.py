"""Time expressions on zone-free timestamps.

``date_trunc`` and ``unix_micros`` go through the session time zone; the
expressions here do not, so results are the same under any session setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_SQL = "timestamp_ntz'1970-01-01 00:00:00'"


def as_ntz(ts) -> Column:
    return F.col(ts).cast("timestamp_ntz") if isinstance(ts, str) else ts.cast("timestamp_ntz")


def ntz_literal(text: str) -> Column:
    return F.lit(str(text)).cast("timestamp_ntz")


def seconds(n) -> Column:
    """An interval of ``n`` seconds."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(secs=n.cast("decimal(18,6)"))


def start_of_day(ts) -> Column:
    return as_ntz(ts).cast("date").cast("timestamp_ntz")


def start_of_month(ts) -> Column:
    return F.trunc(as_ntz(ts).cast("date"), "month").cast("timestamp_ntz")


def start_of_hour(ts) -> Column:
    ts = as_ntz(ts)
    return ts - F.make_dt_interval(mins=F.minute(ts), secs=F.extract(F.lit("second"), ts))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 as an exact decimal with six places."""
    since = as_ntz(ts) - F.expr(_EPOCH_SQL)
    return since.cast("interval second").cast("decimal(20,6)")


def epoch_micros(ts) -> Column:
    return (epoch_seconds(ts) * F.lit(1_000_000)).cast("bigint")


def epoch_nanos(ts) -> Column:
    return epoch_micros(ts) * F.lit(1000)


def from_epoch_millis(ms) -> Column:
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.expr(_EPOCH_SQL) + seconds(ms.cast("decimal(18,0)") * F.lit(0.001).cast("decimal(4,3)"))


def to_epoch_millis(ts) -> Column:
    return (epoch_seconds(ts) * F.lit(1000)).cast("bigint")


def nearest_hour(ts) -> Column:
    """Round to the hour; an exact half goes to the even hour."""
    hour = start_of_hour(ts)
    past = F.minute(as_ntz(ts)) * 60 + F.extract(F.lit("second"), as_ntz(ts))
    up = (past > 1800) | ((past == 1800) & (F.hour(hour) % 2 == 1))
    return F.when(up, hour + F.expr("interval 1 hour")).otherwise(hour)


def day_series(first: Column, days: int) -> Column:
    """``first`` and the ``days`` days after it: ``days + 1`` timestamps."""
    return F.sequence(first, first + F.make_dt_interval(days=F.lit(days)), F.expr("interval 1 day"))


def to_zone(ts, zone: str) -> Column:
    """UTC wall clock to the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_ntz(ts))


def from_zone(ts, zone: str) -> Column:
    """Wall clock of ``zone`` to the UTC wall clock."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), as_ntz(ts))


def instant(ts) -> Column:
    """A zone-free UTC time as an instant, which event-time watermarks ask for."""
    return F.timestamp_micros(epoch_micros(ts))


def wall_clock(moment) -> Column:
    """An instant as zone-free UTC time."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    micros = F.unix_micros(moment)
    return F.expr(_EPOCH_SQL) + seconds(micros.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(7,6)"))
