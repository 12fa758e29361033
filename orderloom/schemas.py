"""Fixed table schemas. Personal columns carry a ``tags`` entry in their metadata."""

from __future__ import annotations

from pyspark.sql import types as T

PII = {"tags": ["PII"]}


def _described(text: str, **extra) -> dict:
    return {"comment": text, **extra}


RAW_ORDERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("purchase_price", T.DoubleType()),
        T.StructField("sku", T.StringType()),
        T.StructField("dt", T.TimestampNTZType()),
    ]
)

RAW_USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("company", T.StringType()),
        T.StructField("is_test_user", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# The stamp column is added by the loader, so the file schema leaves it out.
LOAD_STAMP = "_sling_loaded_at"

LOCATIONS_FILE = T.StructType(
    [
        T.StructField("l_user_id", T.LongType()),
        T.StructField("l_street_address", T.StringType()),
        T.StructField("l_state", T.StringType()),
        T.StructField("l_country", T.StringType()),
        T.StructField("l_zip_code", T.StringType()),
    ]
)

RAW_LOCATIONS = T.StructType([*LOCATIONS_FILE.fields, T.StructField(LOAD_STAMP, T.IntegerType())])

COLUMN_NOTES: dict[str, dict[str, dict]] = {
    "orders_cleaned": {
        "user_id": _described("Platform id of the user who placed the order.", **PII),
        "quantity": _described("Items bought in the order."),
        "purchase_price": _described("Price of one item when the order was placed."),
        "sku": _described("Identifier of the item."),
        "dt": _described("UTC time of the order."),
        "order_total": _described("Quantity times price."),
    },
    "users_cleaned": {
        "user_id": _described("Platform id of the user.", **PII),
        "company": _described("Company the user belongs to."),
        "created_at": _described("When the account was created."),
    },
    "locations_cleaned": {
        "user_id": _described("Platform id of the user.", **PII),
        "street_address": _described("Street address of the user."),
        "state": _described("State of the address."),
        "country": _described("Country of the address."),
        "zip_code": _described("Postal code of the address."),
        LOAD_STAMP: _described("Epoch second of the load."),
    },
    "orders_augmented": {
        "user_id": _described("Platform id of the user who placed the order.", **PII),
    },
}

# Columns of the star-schema tables. With them a read needs no footer scan to learn its columns.
STAR_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
