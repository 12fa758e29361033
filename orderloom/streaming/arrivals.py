"""Files that arrive in a folder."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from orderloom.sources.file_listing import list_files


def append_arrivals(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    file_format: str = "parquet",
    files_per_batch: int = 10_000,
) -> bool:
    """Append the rows of files not seen before to ``target``; the checkpoint is the cursor.

    A run takes what is there, in batches of bounded size, and ends. A landing folder that does not exist yet is
    skipped: the run returns False.
    """
    try:
        arrived = (
            spark.readStream.schema(schema)
            .format(file_format)
            .option("maxFilesPerTrigger", files_per_batch)
            .load(landing)
        )
        rows = transform(arrived) if transform else arrived
        query = (
            rows.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    query.awaitTermination()
    return True


class FileCursor(int):
    """The time of the newest file seen, in milliseconds, and the files seen that have this very time."""

    def __new__(cls, millis: int, names: Iterable[str] = ()):
        cursor = super().__new__(cls, millis)
        cursor.names = frozenset(names)
        return cursor

    def to_json(self) -> str:
        return json.dumps({"millis": int(self), "names": sorted(self.names)})

    @classmethod
    def from_json(cls, text: str) -> FileCursor:
        held = json.loads(text)
        return cls(held["millis"], held["names"])


def files_since(
    spark: SparkSession, path: str, schema: T.StructType, cursor: int | FileCursor, file_format: str = "parquet"
) -> tuple[DataFrame, FileCursor]:
    """Rows of files not seen at the cursor, and the cursor to keep.

    Unlike a stream, which knows files by name, this sees a file again when it was replaced under its
    name. The new cursor comes from the listing of files; no row is read for it. A file that comes
    later with the cursor's own time is known by its name, so it is read next time. The rows are those
    of the listed files only, whatever else arrives meanwhile. A missing path gives no rows and leaves
    the cursor.
    """
    before = cursor if isinstance(cursor, FileCursor) else FileCursor(cursor)
    listed = list_files(spark, path).select("path", "modified")
    newest = listed.agg(F.max("modified")).first()[0]
    if newest is None or newest < before:
        return spark.createDataFrame([], schema), before
    # The files of one millisecond.
    names = [r.path for r in listed.where(F.col("modified") == newest).select("path").collect()]
    modified, name = F.unix_millis("_metadata.file_modification_time"), F.col("_metadata.file_path")
    seen = (modified < int(before)) | ((modified == int(before)) & name.isin(*before.names))
    known = (modified < newest) | ((modified == newest) & name.isin(*names))
    rows = spark.read.schema(schema).format(file_format).load(path).where(~seen & known)
    return rows, FileCursor(newest, names)
