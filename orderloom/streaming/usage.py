"""Usage per model and hour from a stream of query records that come late or twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.timestamps import instant, start_of_hour
from orderloom.operators.usage import QUERY_COMMENT

DELTAS = "model string, hour timestamp_ntz, n_queries bigint, credits double, batch bigint"


def run_usage(
    spark: SparkSession, history: DataFrame, target: str, checkpoint: str, query_id: str, lateness: str = "3 hours"
) -> None:
    """Add what has arrived to the hours it belongs to, earlier hours included.

    A query id counts once while its start is no older than ``lateness`` before the newest start seen;
    Spark keeps the ids of that span in its state. Records older than that when they arrive are left
    out, as the watermark says. Each batch stores what it adds to each hour under its own number, so a
    batch that runs again replaces itself and an hour is the sum of its batches.
    """
    once = (
        history.withColumn("_at", instant("start_time"))
        .withWatermark("_at", lateness)
        .dropDuplicatesWithinWatermark([query_id])
        .select(F.regexp_extract("query_text", QUERY_COMMENT, 1).alias("model"), start_of_hour("start_time").alias("hour"), "credits")
        .where("model != ''")
    )

    def on_batch(batch: DataFrame, number: int) -> None:
        added = batch.groupBy("model", "hour").agg(F.count(F.lit(1)).alias("n_queries"), F.sum("credits").alias("credits"))
        stored = added.withColumn("batch", F.lit(number)).write.mode("overwrite")
        stored.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    query = (
        once.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def usage_so_far(spark: SparkSession, target: str) -> DataFrame:
    """Queries and credits per model and hour, and how many batches the hour was made of."""
    added = spark.read.schema(DELTAS).parquet(target)
    return added.groupBy("model", "hour").agg(
        F.sum("n_queries").alias("n_queries"), F.sum("credits").alias("credits"), F.count(F.lit(1)).alias("n_batches")
    )
