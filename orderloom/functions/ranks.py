"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.joins import broadcast_if_small
from orderloom.session import materialise

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def number_rows(
    df: DataFrame, order: Sequence[str], within: Sequence[str] = (), column: str = "row_no"
) -> DataFrame:
    """Add the zero-based position of each row in the order of ``within`` then ``order``.

    With ``within`` the count restarts for each group. One range shuffle sorts the
    table, so a group holding a large share of the rows is spread over many tasks;
    the last order column should be unique. The sorted copy is written once so that
    counts and positions come from the same placement. Only one row per shuffle
    partition takes part in the running total.
    """
    keys = [*within, *order]
    tagged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_tag", F.monotonically_increasing_id())
    )
    tagged = materialise(tagged, "positions")
    part = F.shiftright("_tag", _PARTITION_BIT)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    numbered = (
        tagged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(column, F.col("_start") + F.col("_tag").bitwiseAND((1 << _PARTITION_BIT) - 1))
        .drop("_part", "_start", "_tag")
    )
    if not within:
        return numbered
    firsts = numbered.groupBy(*within).agg(F.min(column).alias("_first"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in within]
    return (
        numbered.alias("r")
        .join(broadcast_if_small(firsts).alias("f"), same)
        .select("r.*", "f._first")
        .withColumn(column, F.col(column) - F.col("_first"))
        .drop("_first")
    )
