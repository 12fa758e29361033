"""Rebuild the latest window of a table when any of its parents has changed there."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.file_listing import partition_versions
from orderloom.sources.tables import GRAINS, TableStore

BUILT = "parent string, part string, version string"


class ParentWatch:
    """A child table and the parent partitions that its latest window was built from.

    The latest window is the newest partition value of any parent. The child is due there if it was
    never built for it or if a parent's partition differs from the one it was built from. A parent
    that lacks the partition, or whose other partitions have changed, holds nothing up. What is
    there now is told from file listings; what was built from is a stored table, replaced in one
    step after the child, so that a run that fails in between is done again.
    """

    def __init__(self, store: TableStore, child: str, parents: Sequence[str], grain: str = "day"):
        self.store, self.child, self.parents, self.grain = store, child, list(parents), grain
        self.ledger = f"{child}__built_from"

    def versions(self) -> DataFrame:
        """``parent, part, version`` of every partition of every parent."""
        part = GRAINS[self.grain]
        found = [
            partition_versions(self.store.spark, self.store.path(name), part).withColumn("parent", F.lit(name))
            for name in self.parents
        ]
        return reduce(DataFrame.unionByName, found).select("parent", "part", "version")

    def built(self) -> DataFrame:
        if self.store.exists(self.ledger):
            return self.store.read(self.ledger)
        return self.store.spark.createDataFrame([], BUILT)

    def states(self) -> DataFrame:
        """``part, parent, state, version`` of each parent in the latest window; no row before any parent has data.

        ``updated``: differs from what the child was built from. ``current``: the same. ``missing``:
        has no such partition; ``gone``: had one when the child was built.
        """
        versions, built = self.versions(), self.built()
        # One value.
        latest = versions.agg(F.max("part")).first()[0]
        wanted = self.store.spark.createDataFrame([(latest, name) for name in self.parents if latest], "part string, parent string")
        before = built.withColumnRenamed("version", "built_version")
        joined = wanted.join(versions, ["part", "parent"], "left").join(before, ["part", "parent"], "left")
        there, known = F.col("version").isNotNull(), F.col("built_version").isNotNull()
        state = (
            F.when(there & known & (F.col("version") == F.col("built_version")), "current")
            .when(there, "updated")
            .when(known, "gone")
            .otherwise("missing")
        )
        return joined.select("part", "parent", state.alias("state"), "version")

    def refresh(self, build: Callable[[str, list[str]], DataFrame], ts: str) -> tuple[list, bool]:
        """Rebuild the child's latest window if it is due; the states found, and whether it was.

        ``build`` gets the partition value and the parents that have it, and keeps the column ``ts``.
        """
        # One row per parent.
        states = self.states().collect()
        if not any(s.state == "updated" for s in states):
            return states, False
        part = states[0].part
        rows = build(part, [s.parent for s in states if s.version is not None])
        step = {"day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}[self.grain]
        end = self.store.spark.sql(f"select cast(date'{part}' + {step} as date)").first()[0]
        self.store.replace_window(rows, self.child, ts, part, str(end), self.grain)
        used = [(s.parent, s.part, s.version) for s in states if s.version is not None]
        fresh = self.store.spark.createDataFrame(used, BUILT)
        self.store.replace(self.built().where(F.col("part") != part).unionByName(fresh).coalesce(1), self.ledger)
        return states, True
