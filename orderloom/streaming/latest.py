"""Keep the latest partition of a table current while its input grows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.windows import in_window
from orderloom.sources.tables import TableStore, part_value


def land_by_day(rows: DataFrame, landing: str, ts: str) -> None:
    """Add rows to a landing folder with a folder per day."""
    dated = rows.withColumn("part_day", part_value(ts))
    dated.write.mode("append").partitionBy("part_day").parquet(landing)


def refresh_latest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    store: TableStore,
    table: str,
    build: Callable[[DataFrame], DataFrame],
    ts: str,
    checkpoint: str,
    days: str = "latest",
) -> None:
    """Rebuild days of ``table`` whenever files arrive in a landing folder by day.

    With ``days="latest"`` only the latest day: days before it keep what they have, even
    if late rows arrived for them. With ``days="touched"`` every day the arrival has rows
    for. ``build`` gets the rows of whole days, read from their folders alone, and keeps
    the column ``ts``. Days are replaced as a whole, so a batch that runs twice changes
    nothing.
    """
    if days not in ("latest", "touched"):
        raise ValueError(f"days is latest or touched, not {days}")
    landed = T.StructType([*schema.fields, T.StructField("part_day", T.DateType())])

    def rebuild(first, last) -> None:
        start, end = str(first), str(last + timedelta(days=1))
        held = spark.read.schema(landed).parquet(landing)
        part = F.col("part_day")
        held = held.where((part >= F.lit(first)) & (part <= F.lit(last))).drop("part_day")
        store.replace_window(build(in_window(held, ts, start, end, closed="left")), table, ts, start, end)

    def on_batch(batch: DataFrame, _: int) -> None:
        if days == "touched":
            # One value per calendar day; runs of days are rebuilt together.
            touched = sorted(r[0] for r in batch.select("part_day").distinct().collect() if r[0] is not None)
            while touched:
                run = 1
                while run < len(touched) and touched[run] == touched[run - 1] + timedelta(days=1):
                    run += 1
                rebuild(touched[0], touched[run - 1])
                touched = touched[run:]
            return
        newest = batch.agg(F.max("part_day")).first()[0]
        if newest is None:
            return
        held = store.newest_part(table, "part_day")
        newest = max(newest, date.fromisoformat(held)) if held else newest
        rebuild(newest, newest)

    query = (
        spark.readStream.schema(landed)
        .parquet(landing)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
