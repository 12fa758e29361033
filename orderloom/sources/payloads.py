"""Column-oriented JSON payloads: ``{"col": {"0": v, "1": v}, ...}``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.timestamps import from_epoch_millis, to_epoch_millis


def _parsed(payloads: DataFrame, schema: T.StructType, payload: str) -> DataFrame:
    """Add ``_doc``: one map of texts per column; NULL if the payload is not one such document.

    As the only element of an array the document cannot be followed by more text.
    """
    maps = ",".join(f"`{name}`:map<string,string>" for name in schema.names)
    wrapped = F.concat(F.lit("["), F.col(payload), F.lit("]"))
    found = F.from_json(wrapped, f"array<struct<{maps}>>")
    return payloads.withColumn("_doc", F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def _row_keys(schema: T.StructType):
    keys = [F.coalesce(F.map_keys(f"_doc.{f.name}"), F.array().cast("array<string>")) for f in schema.fields]
    return F.array_distinct(F.concat(*keys))


def _text_rows(payloads: DataFrame, schema: T.StructType, payload: str) -> DataFrame:
    """One row per index key of any column, with the text of each value."""
    rest = [c for c in payloads.columns if c != payload]
    names = schema.names
    docs = _parsed(payloads, schema, payload).select(
        *rest,
        _row_keys(schema).alias("_key"),
        *[F.col(f"_doc.{n}").alias(f"_map_{n}") for n in names],
        *[F.map_values(f"_doc.{n}").alias(n) for n in names],
    )
    # Columns that list the same keys in the same order, the usual case, are zipped;
    # others are looked up key by key.
    same = reduce(and_, [F.map_keys(f"_map_{n}") == F.col("_key") for n in names])
    looked_up = F.transform(
        "_key", lambda k: F.struct(k.alias("_key"), *[F.try_element_at(f"_map_{n}", k).alias(n) for n in names])
    )
    rows = F.when(same, F.arrays_zip("_key", *names)).otherwise(looked_up)
    index = F.col("_key").try_cast("int").alias("row_index")
    return docs.select(*rest, F.inline(rows)).select(*rest, index, *names)


def _whole_number(text: Column) -> Column:
    """A bigint, also one written with a fraction of zeros."""
    exact = text.try_cast("decimal(38,10)")
    return F.coalesce(text.try_cast("bigint"), F.when(exact == F.floor(exact), exact.try_cast("bigint")))


def _value(name: str, dtype: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return from_epoch_millis(_whole_number(text)).cast(dtype)
    if isinstance(dtype, T.IntegralType):
        return _whole_number(text).try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.when(text.isin("true", "false"), text == "true")
    return text if isinstance(dtype, T.StringType) else text.try_cast(dtype)


def decode(payloads: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """One row per index key of any column; timestamps arrive as epoch milliseconds.

    A key missing in one column gives NULL there, and so does a value that is not of the
    column's type; ``bad_values`` names those. Payloads that do not parse give no row;
    ``rejected`` returns them. An index that is no number is NULL.
    """
    rest = [c for c in payloads.columns if c != payload]
    values = [_value(f.name, f.dataType).alias(f.name) for f in schema.fields]
    return _text_rows(payloads, schema, payload).select(*rest, "row_index", *values)


def bad_values(payloads: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """One row per value that is not of its column's type: page columns, row, column, text."""
    rest = [c for c in payloads.columns if c != payload]
    tried = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f.name).alias("text"),
                _value(f.name, f.dataType).isNull().alias("bad"),
            )
            for f in schema.fields
        ]
    )
    rows = _text_rows(payloads, schema, payload).select(*rest, "row_index", F.inline(tried))
    return rows.where(F.col("bad") & F.col("text").isNotNull()).drop("bad")


def rejected(payloads: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    """Payloads that are not one such document or hold no row."""
    parsed = _parsed(payloads, schema, payload)
    return parsed.where(F.col("_doc").isNull() | (F.size(_row_keys(schema)) == 0)).drop("_doc")


def encode(df: DataFrame, page: Sequence[str], index: str, columns: Sequence[str]) -> DataFrame:
    """Pack the rows of each page into one payload.

    The caller numbers the rows of a page in ``index``; pages must be of bounded size,
    as those of a paged interface are.
    """
    packed = []
    for name in columns:
        dtype = df.schema[name].dataType
        value = F.col(name)
        if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
            value = to_epoch_millis(name)
        entry = F.struct(F.col(index).cast("string").alias("key"), value.alias("value"))
        packed.append(F.map_from_entries(F.collect_list(entry)).alias(name))
    return df.groupBy(*page).agg(F.to_json(F.struct(*packed)).alias("payload"))
