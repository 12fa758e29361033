"""Listings of changed tables: filter by reason, group by code location, render.

A listing row is ``asset_path array<string>, changed_reasons array<string>,
location string, repository string``. ``from_documents`` makes such rows from nested
JSON documents. A rendering is one row per key with its position, so a group of any size
has the same form; the document or command is the ordered concatenation of its rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.ranks import number_rows

# Every reason a listing can give, and those looked for by default.
CHANGE_REASONS = [
    "NEW",
    "CODE_VERSION",
    "DEPENDENCIES",
    "PARTITIONS_DEFINITION",
    "TAGS",
    "METADATA",
    "REMOVED",
]
DEFAULT_REASONS = "NEW,CODE_VERSION"
WHOLE_LOCATION = "__repository__"


def parse_reasons(text: str) -> list[str]:
    """A comma-separated list, any case and spacing, checked against the known reasons."""
    reasons = [part.strip().upper() for part in text.split(",")]
    unknown = sorted(set(reasons) - set(CHANGE_REASONS))
    if unknown:
        raise ValueError(f"unknown change reasons: {', '.join(unknown)}")
    return sorted(set(reasons))


def changed_assets(listing: DataFrame, reasons: str | Iterable[str] = DEFAULT_REASONS) -> DataFrame:
    """One row per asset with a wanted reason: location, repository and joined key."""
    wanted = parse_reasons(reasons if isinstance(reasons, str) else ",".join(reasons))
    given = F.coalesce("changed_reasons", F.array().cast("array<string>"))
    return listing.where(F.arrays_overlap(given, F.array(*map(F.lit, wanted)))).select(
        "location", "repository", F.concat_ws("/", "asset_path").alias("asset_key")
    )


def changed_counts(changed: DataFrame) -> DataFrame:
    """Changed assets per location and repository."""
    return changed.groupBy("location", "repository").agg(F.count(F.lit(1)).alias("n_changed"))


def changed_totals(listing: DataFrame, reasons: str | Iterable[str] = DEFAULT_REASONS) -> DataFrame:
    """One row: assets listed, assets with a wanted reason, and groups that have such assets."""
    counts = changed_counts(changed_assets(listing, reasons))
    listed = listing.agg(F.count(F.lit(1)).alias("n_listed"))
    found = counts.agg(
        F.coalesce(F.sum("n_changed"), F.lit(0)).alias("n_changed"), F.count(F.lit(1)).alias("n_groups")
    )
    return listed.join(found)


# The form of the documents: fixed values.
NODES = (
    "array<struct<assetKey:struct<path:array<string>>,changedReasons:array<string>,"
    "repository:struct<name:string,location:struct<name:string>>>>"
)


def _nodes(column: str) -> Column:
    """The nodes of a document; NULL where it is no array or an element is no object."""
    parsed = F.when(F.ltrim(F.col(column)).startswith("["), F.from_json(column, NODES))
    return F.when(F.forall(parsed, lambda node: node.isNotNull()), parsed)


def from_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """Listing rows of JSON documents, each an array of nested asset nodes.

    A document that is no such array gives no row here and one in ``rejected_documents``; an absent
    part of a node is NULL.
    """
    node = F.col("node")
    return documents.select(F.explode(_nodes(column)).alias("node")).select(
        node["assetKey"]["path"].alias("asset_path"),
        node["changedReasons"].alias("changed_reasons"),
        node["repository"]["location"]["name"].alias("location"),
        node["repository"]["name"].alias("repository"),
    )


def rejected_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """The documents, with all their columns, that are no JSON array of nodes; NULL is one of them.

    An element that is no object rejects its whole document.
    """
    return documents.where(_nodes(column).isNull())


def numbered_keys(changed: DataFrame) -> DataFrame:
    """The keys of each group with their position in order, from 0."""
    return number_rows(changed, ["asset_key"], within=["location", "repository"], column="position")


def display_name() -> Column:
    """``location/repository``, or the location alone for its unnamed repository."""
    whole = F.col("repository") == WHOLE_LOCATION
    return F.when(whole, F.col("location")).otherwise(F.concat_ws("/", "location", "repository"))


def render_json(changed: DataFrame) -> DataFrame:
    """The elements of the JSON list of each display name, one row per key: position and text.

    Of two groups with the same name the later one, by location and repository, stands.
    """
    groups = changed_counts(changed).withColumn("name", display_name())
    kept = (
        groups.groupBy("name")
        .agg(F.max(F.struct("location", "repository")).alias("g"))
        .select("name", "g.location", "g.repository")
    )
    # A list of one, without its brackets, is the element as JSON text.
    element = F.regexp_replace(F.to_json(F.array("asset_key")), r"^\[|\]$", "").alias("element")
    keys = numbered_keys(changed).join(kept, ["location", "repository"])
    return keys.select("name", "position", element)


def json_document_lines(changed: DataFrame) -> DataFrame:
    """``line_no, line`` of one JSON object: display names with the lists of their keys, indented by two.

    The rows in order of ``line_no`` are the document. Whether a key opens or closes its group, or the
    whole object, is told by comparing its position with those of its neighbours in one range shuffle,
    so a group may be larger than any partition. Of two groups of one name the later one stands, at
    the place of the first. Without any key the document is ``{}``.
    """
    groups = changed_counts(changed).withColumn("name", display_name())
    places = groups.groupBy("name").agg(
        F.min(F.struct("location", "repository")).alias("place"), F.max(F.struct("location", "repository")).alias("g")
    )
    kept = changed.join(places.select("name", "place", "g.location", "g.repository"), ["location", "repository"])
    ordered = number_rows(kept.select("place", "name", "asset_key"), ["place", "asset_key"], column="at")
    ordered = ordered.select("at", "name", "asset_key")
    # Each row beside the names before and after it.
    neighbours = (
        ordered.select((F.col("at") + 1).alias("at"), F.col("name").alias("before"), F.lit(None).cast("string").alias("after"))
        .unionByName(ordered.select((F.col("at") - 1).alias("at"), F.lit(None).cast("string").alias("before"), F.col("name").alias("after")))
        .groupBy("at")
        .agg(F.max("before").alias("before"), F.max("after").alias("after"))
    )
    near = ordered.join(neighbours, "at", "left")
    text = lambda value: F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")
    opens, closes = ~F.col("before").eqNullSafe(F.col("name")), ~F.col("after").eqNullSafe(F.col("name"))
    none, last = F.lit(None).cast("string"), F.col("after").isNull()
    lines = F.array_compact(
        F.array(
            F.when(F.col("before").isNull(), F.lit("{")),
            F.when(opens, F.concat(F.lit("  "), text(F.col("name")), F.lit(": ["))),
            F.concat(F.lit("    "), text(F.col("asset_key")), F.when(closes, "").otherwise(",")),
            F.when(closes, F.when(last, "  ]").otherwise("  ],")).otherwise(none),
            F.when(last, F.lit("}")),
        )
    )
    return near.select("at", F.posexplode(lines).alias("part", "line")).select(
        (F.col("at") * 5 + F.col("part")).alias("line_no"), "line"
    )


def write_json_document(changed: DataFrame, path: str) -> None:
    """Write ``json_document_lines`` as text files whose contents, in order of their names, are the document."""
    lines = json_document_lines(changed)
    if lines.isEmpty():
        lines = changed.sparkSession.createDataFrame([(0, "{}")], "line_no bigint, line string")
    in_order = lines.repartitionByRange("line_no").sortWithinPartitions("line_no")
    in_order.select("line").write.text(path)


def render_lines(changed: DataFrame) -> DataFrame:
    """Tab-separated lines in order."""
    line = F.concat_ws("\t", "location", "repository", "asset_key")
    return changed.orderBy("location", "repository", "asset_key").select(line.alias("line"))


def render_commands(changed: DataFrame, job: str, launcher: str = "launch") -> DataFrame:
    """The parts of the launch command of each group, one row per key, to be joined by spaces.

    The part at position 0 opens with the launcher, the location and the job.
    """
    option = F.format_string("--asset-key 'key:\"%s\"'", "asset_key")
    opening = F.concat_ws(" ", F.lit(launcher), F.lit("--location"), "location", F.lit("--job"), F.lit(job), option)
    part = F.when(F.col("position") == 0, opening).otherwise(option)
    return numbered_keys(changed).select("location", "repository", "position", part.alias("part"))


def table_key(path: str, name: str, overrides: dict[str, str] | None = None) -> Column:
    """Two-part key of a model: first folder of its path, unless the whole path is overridden."""
    prefix = F.split(F.col(path), "/")[0]
    for whole, replacement in (overrides or {}).items():
        prefix = F.when(F.col(path) == whole, F.lit(replacement)).otherwise(prefix)
    return F.array(prefix, F.col(name))


def upstream_key(parts: str) -> Column:
    """Second and third part of a key, the second in upper case."""
    return F.array(F.upper(F.get(parts, F.lit(1))), F.get(parts, F.lit(2)))


def storage_kind(target: Column, family: str = "SNOWFLAKE") -> Column:
    """Targets that start with the family name are called by it; an absent one is DUCKDB."""
    target = F.coalesce(target, F.lit("DUCKDB"))
    return F.when(target.startswith(family), F.lit(family)).otherwise(target)
