"""The version each key was last built from, kept between runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.tables import TableStore


class VersionLedger:
    """``key, content_hash`` of all keys ever built: stored in buckets of the key, sorted in each.

    Runs join their own hashes with it bucket by bucket, so only the run's side is shuffled, however
    long the ledger grows; the upsert keeps the buckets. A new state takes the place of the old one
    in one step. The number of buckets is part of the stored name, so it may differ between ledgers
    but stays that of a ledger once it was begun.
    """

    def __init__(self, store: TableStore, name: str, key: str, buckets: int = 64):
        self.store, self.name, self.key = store, name, key
        self.begun = store.exists(name)
        self.buckets = int(store.path(name).rpartition("-b")[2]) if self.begun else buckets
        self._entries: list[str] = []

    def read(self) -> DataFrame:
        """The ledger as a bucketed table; its catalog entry lasts until ``close``."""
        spark, folder = self.store.spark, self.store.path(self.name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
        entry = f"ledger_{uuid.uuid4().hex}"
        self._entries.append(entry)
        spark.sql(
            f"create table {entry} ({columns}) using parquet "
            f"clustered by (`{self.key}`) sorted by (`{self.key}`) into {self.buckets} buckets location '{folder}'"
        )
        return spark.table(entry)

    def due(self, current: DataFrame) -> DataFrame:
        """``key, content_hash, previous_hash`` of the known keys whose hash in ``current`` is another.

        Keys that were never built are left out.
        """
        if not self.begun:
            empty = current.limit(0)
            return empty.select(self.key, "content_hash", F.col("content_hash").alias("previous_hash"))
        held = self.read().withColumnRenamed("content_hash", "previous_hash")
        both = held.join(current.select(self.key, "content_hash"), self.key)
        return both.where("content_hash != previous_hash").select(self.key, "content_hash", "previous_hash")

    def record(self, built: DataFrame) -> None:
        """Move the versions of the keys in ``built`` on; all others stay. Null keys are left out.

        Of several hashes of one key the greatest counts.
        """
        new = built.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max("content_hash").alias("content_hash"))
        if self.begun:
            held = self.read().withColumnRenamed("content_hash", "_before")
            new = held.join(new, self.key, "full").select(self.key, F.coalesce("content_hash", "_before").alias("content_hash"))
        else:
            new = new.repartition(self.buckets, self.key)
        entry = f"ledger_{uuid.uuid4().hex}"

        def write(folder: str) -> None:
            bucketed = new.write.bucketBy(self.buckets, self.key).sortBy(self.key)
            bucketed.option("path", folder).format("parquet").saveAsTable(entry)
            self._entries.append(entry)

        self.store.publish(self.name, write, f"-b{self.buckets}")
        self.begun = True

    def close(self) -> None:
        """Drop the catalog entries made here; the files stay, and frames that were read before end with them."""
        for entry in self._entries:
            self.store.spark.sql(f"drop table if exists {entry}")
        self._entries.clear()
