"""Row counts, column metadata and column tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import COLUMN_NOTES


def annotate(df: DataFrame, table: str) -> DataFrame:
    """Attach the documented tags and descriptions to the columns of ``table``."""
    for column, note in COLUMN_NOTES.get(table, {}).items():
        if column in df.columns:
            df = df.withMetadata(column, note)
    return df


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """One row: table, row count, column count and ``name:type`` list."""
    columns = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(columns).alias("columns"),
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_profile(df, name) for name, df in tables.items()])


def column_catalog(df: DataFrame, table: str) -> DataFrame:
    """One row per column with type, tags, description, rows and nulls; one scan of the table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(",".join(f.metadata.get("tags", []))).alias("tags"),
            F.lit(f.metadata.get("comment", "")).alias("description"),
            F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"_{i}")).alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*entries)))


def tag_columns(columns: DataFrame, tagged: dict[str, str]) -> DataFrame:
    """Tag rows of a ``(column_name, data_type)`` listing by exact column name."""
    tag = F.lit(None).cast("string")
    for name, value in tagged.items():
        tag = F.when(F.col("column_name") == name, F.lit(value)).otherwise(tag)
    return columns.withColumn("tag", tag)
