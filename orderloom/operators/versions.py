"""Content hashes and the rows whose content changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_hashes(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """SHA-1 of the joined text of ``columns`` per key."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return df.select(key, F.sha1(text).alias("content_hash"))


def changed_by_hash(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Keys known to both sides whose hash differs; keys never seen before are left out.

    Only keys and hashes are compared, so texts are never shuffled.
    """
    before = previous.select(key, F.col("content_hash").alias("previous_hash"))
    return current.join(before, key).where(F.col("content_hash") != F.col("previous_hash"))
