"""Size checks that decide between a broadcast and a shuffled join."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes of values to a byte of a compressed file, generously.
_UNPACKED = 10


def _row_bytes(df: DataFrame) -> Column:
    widths = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + F.lit(8))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            widths.append(F.octet_length(F.coalesce(F.to_json(F.struct(f"`{field.name}`")), F.lit(""))))
    return reduce(add, widths, F.lit(16 + 8 * len(df.columns))).cast("bigint")


def measured_bytes(*frames: DataFrame) -> int:
    """Bytes of all values of the frames, counted by one job that returns one number."""
    widths = [df.select(_row_bytes(df).alias("w")) for df in frames]
    return reduce(DataFrame.unionAll, widths).agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]


def planned_bytes(df: DataFrame) -> int | None:
    """A bound from the files of a frame that only filters and projects stored tables; no job runs.

    None for other frames, whose size only shows when they are worked out.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes = re.findall(r"^[\s:+-]*(\w+)", plan.toString(), re.MULTILINE)
    if not set(nodes) <= {"Project", "Filter", "Relation"}:
        return None
    return int(str(plan.stats().sizeInBytes())) * _UNPACKED


def small(limit: int, *frames: DataFrame) -> bool:
    """Whether the frames together fit the limit: by their files where these tell, else measured."""
    known = [planned_bytes(df) for df in frames]
    left = limit - sum(n for n in known if n is not None)
    unknown = [df for df, n in zip(frames, known) if n is None]
    if left < 0:
        # Files say too much for a filtered table, so count what is left of it.
        return measured_bytes(*frames) <= limit
    return not unknown or measured_bytes(*unknown) <= left


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the size allows it; else leave the plan to a shuffled join."""
    return F.broadcast(df) if small(limit, df) else df
