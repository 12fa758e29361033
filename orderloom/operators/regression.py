"""Country table, one-hot columns and the group regression."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.joins import broadcast_if_small
from orderloom.functions.ranks import number_rows

# The columns of the country table by position; the fourth of the page is not kept.
COUNTRY_COLUMNS = ["country", "pop_2022", "pop_2023", "change", "continent", "region"]


def to_number(column: str):
    """Text to double; thousands separators are dropped and bad text is NULL."""
    return F.regexp_replace(F.trim(column), ",", "").try_cast("double")


def country_stats(cells: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Six text columns by position to the country table with its growth in percent.

    Columns after the six are carried along when ``keep`` names them.
    """
    named = cells.toDF(*COUNTRY_COLUMNS, *keep).drop("change")
    return (
        named.withColumn("pop_2022", to_number("pop_2022"))
        .withColumn("pop_2023", to_number("pop_2023"))
        .withColumn("pop_change", (F.try_divide("pop_2023", "pop_2022") - 1) * 100)
    )


def bad_numbers(cells: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per cell with text that is no number: ``keep``, the column, its text."""
    named = cells.toDF(*COUNTRY_COLUMNS, *keep)
    tried = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("text"), to_number(c).alias("number"))
            for c in ("pop_2022", "pop_2023")
        ]
    )
    return named.select(*keep, F.inline(tried)).where("text is not null and number is null").drop("number")


def one_hot(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Replace ``column`` by one 0/1 column for each stated level; NULL and other levels are all zeros."""
    flags = [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values]
    return df.select(*[c for c in df.columns if c != column], *flags)


def one_hot_rows(df: DataFrame, column: str) -> DataFrame:
    """The ones of a one-hot coding as rows, for any number of levels; NULL has none."""
    feature = F.concat(F.lit(f"{column}_"), F.col(column).cast("string")).alias("feature")
    others = [c for c in df.columns if c != column]
    return df.where(F.col(column).isNotNull()).select(*others, feature, F.lit(1).alias("value"))


def change_model(stats: DataFrame, group: str = "continent", target: str = "pop_change") -> DataFrame:
    """Least squares of ``target`` on the one-hot levels of ``group``, one row per level.

    With every level present and an intercept, the solution of least norm has a closed
    form: the intercept is the plain mean of the level means and a coefficient is the
    distance of its level from it. Rows without a level, if any, sit at the intercept,
    which then is their mean. Rows without a target are left out. The input is read
    several times, for the means and for the errors against them, so it is best a stored
    table; the means are a row per level and are not stored.
    """
    data = stats.dropna(subset=[target]).select(group, target)
    means = data.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(target).alias("mean"),
        (F.var_pop(target) * F.count(F.lit(1))).alias("within"),
    )
    known = F.when(F.col(group).isNotNull(), F.col("mean"))
    scores = means.agg(
        F.sum("n").alias("n"),
        F.coalesce(F.max(F.when(F.col(group).isNull(), F.col("mean"))), F.avg(known)).alias("base"),
        F.sum("within").alias("sse"),
    ).first()
    if not scores["n"]:
        raise ValueError(f"no row has a {target}")
    fitted = data.alias("d").join(
        broadcast_if_small(means.select(group, "mean")).alias("m"),
        F.col(f"d.{group}").eqNullSafe(F.col(f"m.{group}")),
    )
    spread = fitted.agg(
        F.avg(F.abs(F.col(f"d.{target}") - F.col("m.mean"))).alias("mae"),
        F.var_pop(f"d.{target}").alias("variance"),
    ).first()
    total = spread["variance"] * scores["n"]
    r2 = 1 - scores["sse"] / total if total else 1.0
    constants = {
        "intercept": round(scores["base"], 4),
        "n_samples": scores["n"],
        "r2": round(r2, 4),
        "rmse": round(math.sqrt(scores["sse"] / scores["n"]), 4),
        "mae": round(spread["mae"], 4),
    }
    return means.where(F.col(group).isNotNull()).select(
        F.concat(F.lit(f"{group}_"), F.col(group)).alias("feature"),
        F.col(group),
        (F.col("mean") - F.lit(scores["base"])).alias("coefficient"),
        *[F.lit(v).alias(k) for k, v in constants.items()],
    )


def group_sums(df: DataFrame, key: str) -> DataFrame:
    """Sum of every numeric column per key; NULL keys are dropped and a sum of NULLs is 0."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != key]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.coalesce(F.sum(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) for c in numeric])
    )


def text_parts(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """The texts of a key as rows: ``key, column_name, position, part``.

    The joined text of a column is its parts in order, whatever its size: in the order of the columns
    ``order``, which are no texts themselves, or of the texts where none are given. NULL keys and texts
    are dropped.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (key, *order)]
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("part")) for c in texts])
    rows = df.where(F.col(key).isNotNull()).select(key, *order, F.inline(each)).where(F.col("part").isNotNull())
    return number_rows(rows, [*order, "part"], within=[key, "column_name"], column="position").drop(*order)


def text_parts_in_row_order(stored: DataFrame, key: str) -> DataFrame:
    """``text_parts`` of a table read from Parquet files, in the order of its rows: by file name, then place in the file."""
    placed = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return text_parts(placed, key, ["_file", "_row"])


def continent_stats(stats: DataFrame, model: DataFrame) -> DataFrame:
    """Sums of all numbers per continent with the coefficient of the continent, matched by key."""
    factor = model.select("continent", F.col("coefficient").alias("pop_change_factor"))
    return group_sums(stats, "continent").join(factor, "continent", "left")
