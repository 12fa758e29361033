"""URL filters: a sort-merge range join of pages with nested host and path rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, _UPPER, _LOWER), empty), F.coalesce(path, empty)


def split_rule(rule: str) -> tuple[str, str]:
    """Reversed host and path prefix: ``example.org/es/`` is ``org.example`` and ``/es/``."""
    host, slash, path = rule.partition("/")
    if not host:
        raise ValueError(f"rule {rule!r} has no host")
    return ".".join(reversed(host.translate(str.maketrans(_UPPER, _LOWER)).split("."))), slash + path


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Go through rules and pages in order, with a stack of the rules whose interval is open.

    A rule's interval is all paths that begin with its own. Of two intervals one holds the other or
    they are apart, so those open at a page are nested and the last one opened is the longest.
    """
    at, stack = None, []
    for batch in batches:
        out: list[tuple] = []
        for host_key, salt, path, rule, verdict, host in zip(*(c.to_pylist() for c in batch.columns)):
            if at != (host_key, salt):
                at, stack = (host_key, salt), []
            while stack and not path.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((path, rule, verdict))
            elif stack:
                out.append((host, path, *stack[-1][1:]))
        columns = list(zip(*out)) or [()] * 4
        names = ["host", "path", "rule", "verdict"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names)


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` of the longest rule that fits.

    ``rules`` are (rule, verdict) pairs such as ``("example.org/es/", "block")``. One fits its host
    and all subdomains if the path starts with the rule's path; without one the rule is null and the
    verdict ``default``. Of equal rules the verdict that sorts last counts.

    Hosts are reversed by label; a page stands at the key of each parent domain that is not deeper
    than the rules are, and there the rules are intervals of paths. Rules and distinct (host, path)
    pairs are sorted by key and path and swept in one pass. Pages of a key are dealt over as many
    salts as there are shuffle partitions, so a top-level domain with most pages is no single task;
    a rule is sent once for each salt, as in a broadcast, but no task holds more than the stack.

    All rows and columns stay; existing columns of the added names are replaced, repeated and null
    rows are judged one by one, and an empty table gives an empty table.
    """
    spark = pages.sparkSession
    added = ("host", "path", "rule", "verdict")
    own = [c for c in pages.columns if c not in added or c == url]
    host, path = url_parts(F.col(url))
    parted = pages.select(*own, host.alias("_host"), path.alias("_path"))
    keyed = sorted({(*split_rule(rule), rule, verdict) for rule, verdict in rules})
    if not keyed:
        keyed = [("", "", None, None)]
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    deepest = max(key.count(".") + 1 for key, *_ in keyed)
    table = spark.createDataFrame(keyed, "key string, path string, rule string, verdict string").where("rule is not null")
    table = table.select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "path", "rule", "verdict", F.lit(None).cast("string").alias("host")
    )
    # Only as many labels as the deepest rule has can matter.
    labels = F.reverse(F.split("host", r"\."))
    depth = F.least(F.size(labels), F.lit(deepest))
    parents = F.transform(F.sequence(F.lit(1), depth), lambda n: F.array_join(F.slice(labels, 1, n), "."))
    places = parted.select(F.col("_host").alias("host"), F.col("_path").alias("path")).distinct()
    places = places.select(
        F.explode(parents).alias("key"),
        F.pmod(F.xxhash64("path", "host"), F.lit(salts)).cast("int").alias("salt"),
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
        "host",
    )
    both = table.unionByName(places).repartition("key", "salt")
    in_order = both.sortWithinPartitions("key", "salt", "path", F.col("rule").isNull(), "verdict")
    fitting = in_order.mapInArrow(_sweep, "host string, path string, rule string, verdict string")
    longest = fitting.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    )
    longest = longest.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "best.rule", "best.verdict")
    judged = parted.join(longest, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")), "left")
    kept = [c for c in own if c not in added]
    return judged.select(
        *kept,
        *([] if url in kept else [F.col(url)]),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        longest["rule"],
        F.coalesce(longest["verdict"], F.lit(default)).alias("verdict"),
    )
