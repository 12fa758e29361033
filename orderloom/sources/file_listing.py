"""Files and partitions known from the listing alone; no data file is opened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LISTED = "path string, modified bigint, size bigint"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modified`` (milliseconds) and ``size`` of every file below ``path``; none if it does not exist.

    Only the metadata columns of the scan are asked for, so no content is read.
    """
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], LISTED)
        raise
    return found.select(
        F.col("_metadata.file_path").alias("path"),
        F.unix_millis("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"),
    )


def partition_versions(spark: SparkSession, path: str, part: str) -> DataFrame:
    """``part, version`` of each partition folder ``part=value`` below ``path``.

    A version tells files, their times and sizes, in no order; rewritten partitions have new files.
    """
    value = F.regexp_extract("path", f"/{part}=([^/]+)/", 1)
    digest = F.bit_xor(F.xxhash64("path", "modified", "size"))
    listed = list_files(spark, path).select(value.alias("part"), "path", "modified", "size").where("part != ''")
    return listed.groupBy("part").agg(
        F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.hex(digest)).alias("version")
    )
