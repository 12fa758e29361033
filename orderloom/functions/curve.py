"""The order growth curve as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.timestamps import epoch_nanos

# Fixed values of the curve a * exp(b * (ns / 1e18 - 1.6095)).
NANOS_SCALE = 1e18
CENTRE = 1.6095


def centred_time(ts) -> Column:
    return epoch_nanos(ts).cast("double") / F.lit(NANOS_SCALE) - F.lit(CENTRE)


def growth(x: Column, a: float, b: float) -> Column:
    return F.lit(float(a)) * F.exp(F.lit(float(b)) * x)


def growth_at(ts, a: float, b: float) -> Column:
    return growth(centred_time(ts), a, b)
