"""Session settings, shared scratch storage and lineage cuts."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "orderloom", cores: int | str | None = None, **settings) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(name)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Many small queries in one session would otherwise compile their code again and again.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application for intermediate tables.

    It lies in the shared folder that ``spark.checkpoint.dir`` names or, where none is
    named, in the warehouse, which all executors reach as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/orderloom/{spark.sparkContext.applicationId}"


_scope: ContextVar[str] = ContextVar("scratch_scope", default="")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the application's folder for intermediate tables."""
    return f"{scratch_root(spark)}{_scope.get()}/{tag}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application.

    They outlive the frames that read them, since nothing tells when the last one is done;
    a job calls this at its end.
    """
    remove(spark, scratch_root(spark))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end; what is to last is written elsewhere before that."""
    outer = _scope.get()
    mark = _scope.set(f"{outer}/scope-{uuid.uuid4().hex}")
    folder = f"{scratch_root(spark)}{_scope.get()}"
    try:
        yield
    finally:
        _scope.reset(mark)
        remove(spark, folder)


def materialise(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to shared scratch storage once and read it back.

    The copy cuts the lineage and outlives any executor, so later passes neither
    recompute the input nor see a different row placement.
    """
    path = path or scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run steps that do not need each other at once; returns when all have ended, and raises the first error."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()
