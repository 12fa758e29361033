"""Stored tables: full replace, window replace and one folder per key."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from orderloom.functions.timestamps import as_ntz, ntz_literal
from orderloom.operators.windows import in_window

GRAINS = {"day": "part_day", "month": "part_month", "year": "part_year"}
KEY_PART = "part_key"
# Names beside the data of a table: pointers are hidden from readers of the folder.
POINTERS, DATA = "_published", "data"


def part_value(ts, grain: str = "day") -> Column:
    day = as_ntz(ts).cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def check_boundary(moment: str, grain: str) -> None:
    """Raise unless the moment is the beginning of a partition."""
    at = datetime.fromisoformat(str(moment))
    floor = at.replace(hour=0, minute=0, second=0, microsecond=0)
    if grain != "day":
        floor = floor.replace(day=1)
    if grain == "year":
        floor = floor.replace(month=1)
    if at != floor:
        raise ValueError(f"{moment} is not the beginning of a {grain}")


def key_value(key) -> Column:
    """The folder value of a key; the text in front keeps it from being read as a number."""
    return F.concat(F.lit("key-"), key.cast("string"))


class TableStore:
    """Parquet tables under ``root/schema/name``; the root is chosen per environment.

    A table that is replaced as a whole is written to a folder of its own beside the one that is
    read, and becomes current by one step: the next pointer file, whose name is its number and whose
    text is the folder. A job that fails before that step leaves the table as it was, readers go on
    with the files they began with, and a frame that reads the table can replace it. The last
    ``keep`` folders stay. Two writers cannot take one number: the later one fails.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    @classmethod
    def for_environment(cls, spark: SparkSession, environment: str, roots: dict[str, str]) -> TableStore:
        return cls(spark, roots[environment])

    def base(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def path(self, table: str) -> str:
        """The folder whose files are the table now."""
        published = self._published(table)
        return f"{self.base(table)}/{published[max(published)]}" if published else self.base(table)

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _pointers(self, table: str) -> list[str]:
        system, folder = self._hadoop(f"{self.base(table)}/{POINTERS}")
        return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []

    def _published(self, table: str) -> dict[int, str]:
        """Folder by number of the pointers; one without text was not written to its end and does not count."""
        found = {}
        for name in reversed(self._pointers(table)):
            if name.isdigit() and (text := self._text(f"{self.base(table)}/{POINTERS}/{name}")):
                found[int(name)] = text
                if len(found) > self.keep:
                    break
        return found

    def _text(self, path: str) -> str:
        system, where = self._hadoop(path)
        stream = system.open(where)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def publish(self, table: str, write: Callable[[str], None], tag: str = "") -> None:
        """Let ``write`` fill a new folder, then make it the table; older folders beyond ``keep`` go."""
        numbers = [int(name) for name in self._pointers(table) if name.isdigit()]
        number = max(numbers, default=0) + 1
        folder = f"{DATA}-{number:010d}-{uuid.uuid4().hex}{tag}"
        try:
            write(f"{self.base(table)}/{folder}")
        except Exception:
            system, left = self._hadoop(f"{self.base(table)}/{folder}")
            system.delete(left, True)
            raise
        system, pointer = self._hadoop(f"{self.base(table)}/{POINTERS}/{number:010d}")
        stream = system.create(pointer, False)
        stream.write(folder.encode())
        stream.close()
        old = sorted(self._published(table).items())[: -self.keep]
        for past, data in old:
            for path in (f"{POINTERS}/{past:010d}", data):
                gone = self._hadoop(f"{self.base(table)}/{path}")[1]
                system.delete(gone, True)
        if number > self.keep:
            # Files written in place before the table was first replaced.
            for entry in system.listStatus(self._hadoop(self.base(table))[1]):
                if not entry.getPath().getName().startswith((POINTERS, f"{DATA}-")):
                    system.delete(entry.getPath(), True)

    def exists(self, table: str) -> bool:
        try:
            self.spark.read.parquet(self.path(table))
        except AnalysisException:
            return False
        return True

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(table))

    def read_window(
        self, table: str, start: str | None = None, end: str | None = None, grain: str | None = None
    ) -> DataFrame:
        """Rows without their partition column; with ends, of the partitions in ``[start, end)`` only.

        With ``grain`` the column stays if the table is stored by it.
        """
        rows = self.read(table)
        part = next((p for p in GRAINS.values() if p in rows.columns), None)
        if part is None:
            return rows
        if start is not None:
            rows = rows.where((F.col(part) >= ntz_literal(start)) & (F.col(part) < ntz_literal(end)))
        return rows if grain is not None and part == GRAINS[grain] else rows.drop(part)

    def replace(self, df: DataFrame, table: str) -> DataFrame:
        """Replace the whole table in one step; ``df`` may read the table itself."""
        self.publish(table, df.write.parquet)
        return self.read(table)

    def replace_window(
        self,
        df: DataFrame,
        table: str,
        expr: str,
        start: str | None = None,
        end: str | None = None,
        grain: str = "day",
        spread: bool = True,
    ) -> DataFrame:
        """Replace the partitions of the half-open window ``[start, end)`` and no others.

        Rows outside the window are not written. A partition of the window that gets
        no new row ends up empty. Without a window the whole table is replaced in one step.
        ``rebalance`` lets adaptive execution split a partition value that holds many
        rows and merge small ones, so file sizes follow the data. ``spread=False`` leaves
        this shuffle out and takes the partition column as it is where there is one; it is
        for rows that come straight from a table stored in the same partitions, whose files
        give each task a few values. Window ends that are no partition boundaries are an
        error. What was rewritten is told from the names of files; no row is read for it.
        """
        part, windowed = GRAINS[grain], start is not None
        if windowed:
            check_boundary(start, grain)
            check_boundary(end, grain)
        rows = in_window(df, expr, start, end, closed="left") if windowed else df
        placed = not spread and part in df.columns
        rows = rows.withColumn(part, F.col(part).cast("date") if placed else part_value(expr, grain))
        before = self._window_files(table, part, start, end) if windowed else {}
        writer = (rows.hint("rebalance", part) if spread else rows).write.partitionBy(part)
        if windowed:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(table))
        else:
            self.publish(table, writer.parquet)
        after = self._window_files(table, part, start, end) if windowed else {}
        emptied = [value for value, files in before.items() if after.get(value) == files]
        if not self._folders(table):
            # No row at all: an empty first partition still gives the new table its columns.
            emptied = [str(start)[:10]] if windowed else ["1970-01-01"]
        for value in emptied:
            empty = rows.drop(part).limit(0)
            empty.write.mode("overwrite").parquet(f"{self.path(table)}/{part}={value}")
        return self.read(table, rows.schema)

    def _folders(self, table: str, folder: str = "", files: bool = False) -> list[str]:
        """Names of the partition folders of a table, or of the files in one of them."""
        system, path = self._hadoop(f"{self.path(table)}/{folder}".rstrip("/"))
        if not system.exists(path):
            return []
        found = [(s.getPath().getName(), s.isDirectory()) for s in system.listStatus(path)]
        return [name for name, is_folder in found if is_folder != files and not name.startswith(("_", "."))]

    def newest_part(self, table: str, part: str) -> str | None:
        """The highest value among the partition folders; no file is opened."""
        values = [f.partition("=")[2] for f in self._folders(table) if f.startswith(f"{part}=")]
        return max((v for v in values if not v.startswith("__")), default=None)

    def _window_files(self, table: str, part: str, start: str, end: str) -> dict[str, list[str]]:
        """The file names of each partition in the window: one entry per calendar partition.

        A replaced partition holds files of new names, so an unchanged entry marks one
        that the write did not touch.
        """
        first, last = str(start)[:10], str(end)[:10]
        values = [f.partition("=")[2] for f in self._folders(table) if f.startswith(f"{part}=")]
        held = [v for v in values if first <= v < last]
        return {v: sorted(self._folders(table, f"{part}={v}", files=True)) for v in held}

    def replace_by_key(self, df: DataFrame, table: str, key: str) -> DataFrame:
        """One folder per key value; only the keys present in ``df`` are replaced.

        The key itself stays in the files, so it keeps its type and spelling.
        """
        (
            df.withColumn(KEY_PART, key_value(F.col(key)))
            .hint("rebalance", KEY_PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(KEY_PART)
            .parquet(self.path(table))
        )
        return self.read(table).drop(KEY_PART)

    def read_key(self, table: str, key: str, value) -> DataFrame:
        """The rows of one key; only its folder is read."""
        wanted = F.lit(value)
        rows = self.read(table).where((F.col(KEY_PART) == key_value(wanted)) & (F.col(key) == wanted))
        return rows.drop(KEY_PART)
