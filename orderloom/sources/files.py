"""CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.profile import table_profile
from orderloom.schemas import LOAD_STAMP
from orderloom.sources.tables import TableStore


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan CSV with a header, types taken from the data."""
    return spark.read.csv(path, header=True, inferSchema=True)


def stamped_csv(spark: SparkSession, path: str, schema: T.StructType, load_epoch: int) -> DataFrame:
    """CSV with a fixed schema and the load time as epoch seconds."""
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.withColumn(LOAD_STAMP, F.lit(load_epoch).cast("int"))


def full_refresh(
    store: TableStore, path: str, schema: T.StructType, table: str, load_epoch: int
) -> tuple[DataFrame, DataFrame]:
    """Replace ``table`` with the content of ``path``; returns the table and its load report."""
    stored = store.replace(stamped_csv(store.spark, path, schema, load_epoch), table)
    return stored, table_profile(stored, table)
