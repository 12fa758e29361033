"""Usage per model and hour from commented queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.timestamps import ntz_literal, seconds, start_of_hour

# Fixed value: the comment a query carries, with the model and the run that issued it.
QUERY_COMMENT = r"opaque_id\[\[\[(.+?):(.+?)\]\]\]"
LATENCY = timedelta(minutes=45)


def usage_hourly(history: DataFrame, as_of: str, latency: timedelta = LATENCY) -> DataFrame:
    """Queries and credits per model and hour; the most recent minutes are still incomplete and left out."""
    cut = ntz_literal(as_of) - seconds(latency.total_seconds())
    return (
        history.where(F.col("start_time") < cut)
        .select(
            F.regexp_extract("query_text", QUERY_COMMENT, 1).alias("model"),
            start_of_hour("start_time").alias("hour"),
            "credits",
        )
        .where(F.col("model") != "")
        .groupBy("model", "hour")
        .agg(F.count(F.lit(1)).alias("n_queries"), F.sum("credits").alias("credits"))
    )
