"""Data-quality checks. Row checks return the offending rows, verdict checks one row."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WARN, ERROR = "WARN", "ERROR"

# Fixed values of the company checks.
COMPANY_PATTERNS = ["%Sport%", "%Co%", "%Ltd%", "%Shop%"]
EXPECTED_COMPANIES = ["ShopMart", "SportTime", "FamilyLtd", "DiscountStore"]
AVG_ORDER_THRESHOLD = 50


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(column).isNull())


def greater_than_zero(df: DataFrame, column: str) -> DataFrame:
    """Rows at or below zero; NULL passes."""
    return df.where(F.col(column) <= 0)


def order_total_not_positive(orders: DataFrame) -> DataFrame:
    return greater_than_zero(orders, "order_total").select("user_id", "dt", "order_total")


def matches_patterns(column: str, patterns: Sequence[str], match_on: str = "any") -> Column:
    found = [F.col(column).like(p) for p in patterns]
    out = found[0]
    for one in found[1:]:
        out = (out | one) if match_on == "any" else (out & one)
    return out


def like_patterns(
    df: DataFrame, column: str, patterns: Sequence[str] = tuple(COMPANY_PATTERNS), match_on: str = "any"
) -> DataFrame:
    """Rows whose value matches no pattern (or, with ``all``, misses one); NULL passes."""
    if match_on not in ("any", "all"):
        raise ValueError(f"match_on must be 'any' or 'all', not {match_on!r}")
    return df.where(~matches_patterns(column, patterns, match_on))


def verdict(
    summary: DataFrame, check: str, passed: Column, severity: str, metadata: dict[str, Column]
) -> DataFrame:
    """A one-row summary as ``check, passed, severity, metadata``."""
    entries = [part for key, value in metadata.items() for part in (F.lit(key), value.cast("string"))]
    return summary.select(
        F.lit(check).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(severity).alias("severity"),
        F.create_map(*entries).alias("metadata"),
    )


def failing_rows_verdict(offending: DataFrame, check: str, severity: str = WARN) -> DataFrame:
    """Pass when a row check finds nothing."""
    summary = offending.agg(F.count(F.lit(1)).alias("n_failing"))
    return verdict(summary, check, F.col("n_failing") == 0, severity, {"n_failing": F.col("n_failing")})


def check_avg_orders(averages: DataFrame, threshold: float = AVG_ORDER_THRESHOLD) -> DataFrame:
    """The first average order, by company, lies under the threshold; without any the check fails.

    A company that is not named comes first.
    """
    rank = F.struct(F.col("company").isNotNull(), "company")
    first = averages.agg(F.min_by("avg_order", rank).alias("avg_order"))
    return verdict(
        first,
        "check_avg_orders",
        F.col("avg_order") < threshold,
        ERROR,
        {"actual average": F.round("avg_order", 2), "threshold": F.lit(threshold)},
    )


def set_difference(df: DataFrame, column: str, expected: Sequence) -> DataFrame:
    """Distinct values on one side only, tagged ``unexpected`` or ``missing``."""
    observed = df.groupBy(F.col(column).alias("value")).agg(F.lit(True).alias("_seen"))
    wanted = (
        df.sparkSession.range(1)
        .select(F.explode(F.array(*[F.lit(v).cast(df.schema[column].dataType) for v in expected])).alias("value"))
        .distinct()
        .withColumn("_wanted", F.lit(True))
    )
    both = observed.alias("o").join(wanted.alias("w"), F.col("o.value").eqNullSafe(F.col("w.value")), "full")
    side = F.when(F.col("_wanted").isNull(), "unexpected").when(F.col("_seen").isNull(), "missing")
    return both.select(F.coalesce("o.value", "w.value").alias("value"), side.alias("side")).where(
        F.col("side").isNotNull()
    )


def check_users(users: DataFrame, expected: Sequence[str] = tuple(EXPECTED_COMPANIES)) -> DataFrame:
    """The companies of all users equal the expected set.

    The verdict counts the values that differ; ``set_difference`` lists them.
    """
    sides = set_difference(users, "company", expected).agg(
        F.count_if(F.col("side") == "unexpected").alias("unexpected"),
        F.count_if(F.col("side") == "missing").alias("missing"),
    )
    same = (F.col("unexpected") == 0) & (F.col("missing") == 0)
    counts = {"unexpected": F.col("unexpected"), "missing": F.col("missing")}
    return verdict(sides, "check_users", same, WARN, counts)


def check_not_empty(df: DataFrame, check: str) -> DataFrame:
    summary = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return verdict(summary, check, F.col("n") > 0, ERROR, {"rows seen": F.col("n")})


def schema_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per column that was added, removed or retyped between two builds.

    Each row carries the number of values the column holds in either build. Only such
    columns are read, and nothing at all where the builds agree.
    """
    types = [{f.name: f.dataType.simpleString() for f in df.schema.fields} for df in (old, new)]
    changed = {c for c in types[0] | types[1] if types[0].get(c) != types[1].get(c)}
    before, after = _typed_columns(old, "old", changed), _typed_columns(new, "new", changed)
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return (
        before.join(after, "column_name", "full")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(
            "column_name",
            "change",
            "old_type",
            "new_type",
            F.coalesce("old_values", F.lit(0)).alias("old_values"),
            F.coalesce("new_values", F.lit(0)).alias("new_values"),
        )
    )


def _typed_columns(df: DataFrame, side: str, names: Collection[str]) -> DataFrame:
    fields = [f for f in df.schema.fields if f.name in names]
    if not fields:
        return df.sparkSession.createDataFrame([], f"column_name string, {side}_type string, {side}_values bigint")
    counted = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(fields)])
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias(f"{side}_type"),
            F.col(f"_{i}").alias(f"{side}_values"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*entries)))


def column_paths(schema: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """Path and type of every column, and of every field, element, key and value inside it."""
    if isinstance(schema, T.StructType):
        parts = [(f"{path}.{f.name}" if path else f.name, f.dataType) for f in schema.fields]
    elif isinstance(schema, T.ArrayType):
        parts = [(f"{path}.element", schema.elementType)]
    elif isinstance(schema, T.MapType):
        parts = [(f"{path}.key", schema.keyType), (f"{path}.value", schema.valueType)]
    else:
        return []
    found = []
    for name, inner in parts:
        nested = isinstance(inner, (T.StructType, T.ArrayType, T.MapType))
        found.append((name, inner.typeName() if nested else inner.simpleString()))
        found += column_paths(inner, name)
    return found


def schema_rows(df: DataFrame, build: int) -> DataFrame:
    """``build, column_path, type`` of one build, to be kept with those of the others."""
    rows = [(build, path, kind) for path, kind in column_paths(df.schema)]
    return df.sparkSession.createDataFrame(rows, "build int, column_path string, type string")


def schema_history(builds: DataFrame) -> DataFrame:
    """``column_path, type, valid_from, valid_to`` over the builds of ``schema_rows``.

    A path has a row for each run of builds in a row that hold it with one type; ``valid_to`` is the
    first build after the run, NULL while it lasts. Builds are numbered without gaps by what is there.
    """
    # One number per build, however wide the tables are.
    ordered = sorted(r.build for r in builds.select("build").distinct().collect())
    following = dict(zip(ordered, ordered[1:]))
    place = {build: k for k, build in enumerate(ordered)}
    if not place:
        return builds.select("column_path", "type", F.col("build").alias("valid_from"), F.col("build").alias("valid_to"))
    at = F.create_map(*[F.lit(v) for pair in place.items() for v in pair])[F.col("build")]
    after = F.create_map(*[F.lit(v) for b in ordered for v in (b, following.get(b))])[F.col("build")]
    numbered = builds.distinct().withColumn("_at", at).withColumn("_next", after)
    in_run = Window.partitionBy("column_path", "type").orderBy("_at")
    runs = numbered.withColumn("_run", F.col("_at") - F.row_number().over(in_run))
    return runs.groupBy("column_path", "type", "_run").agg(
        F.min("build").alias("valid_from"), F.max_by("_next", "_at").alias("valid_to")
    ).drop("_run")
