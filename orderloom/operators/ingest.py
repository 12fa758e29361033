"""Load payload pages for a range of day partitions in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderloom.operators.windows import in_window
from orderloom.sources.payloads import decode


def load_partitions(
    payloads: DataFrame, schema: T.StructType, start: str, end: str, partition: str = "part_start"
) -> DataFrame:
    """All rows of the pages of ``[start, end)``, one after another and without removing repeats."""
    return decode(in_window(payloads, partition, start, end, closed="left"), schema).select(*schema.names)
