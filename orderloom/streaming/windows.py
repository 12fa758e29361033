"""Event-time counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.timestamps import instant, wall_clock


def window_counts(events: DataFrame, ts: str, key: str, width: str, lateness: str) -> DataFrame:
    """Rows and summed value per time window and key; works on streams and on tables.

    On a stream, a window is final once the watermark has passed its end, so state
    holds open windows only.
    """
    timed = events.withColumn("_at", instant(ts)).withWatermark("_at", lateness)
    return (
        timed.groupBy(F.window("_at", width).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(wall_clock("w.start").alias("window_start"), key, "n", "total")
    )


def run_window_counts(
    spark: SparkSession, events: DataFrame, target: str, checkpoint: str, **settings
) -> None:
    """Append the finished windows of what has arrived to ``target``."""
    query = (
        window_counts(events, **settings)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
