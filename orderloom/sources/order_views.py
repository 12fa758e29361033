"""The raw order tables expressed over the star-schema test tables.

Joins with plain tables carry no hint: Spark knows their file sizes and broadcasts
those under its own limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.cleaned import locations_cleaned, orders_cleaned, users_cleaned
from orderloom.schemas import LOAD_STAMP, STAR_TABLES

LOAD_EPOCH = 1_700_000_000


class OrderViews:
    """Raw and cleaned tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def raw_orders(self, sku: bool = True) -> DataFrame:
        """Order lines; ``sku=False`` leaves out the item and with it the join that names it."""
        lines, orders = self.table("lineitem"), self.table("orders")
        rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        item = F.lit(None).cast("string")
        if sku:
            parts = self.table("part")
            rows = rows.join(parts, rows.l_partkey == parts.p_partkey, "left")
            item = F.col("p_brand")
        return rows.select(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.try_divide("l_extendedprice", "l_quantity").alias("purchase_price"),
            item.alias("sku"),
            F.col("o_orderdate").alias("dt"),
        )

    def raw_users(self) -> DataFrame:
        day = F.make_dt_interval(days=(F.col("c_custkey") % 365).cast("int"))
        return self.table("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("company"),
            (F.col("c_acctbal") < 0).alias("is_test_user"),
            (F.expr("timestamp_ntz'2023-05-25 00:00:00'") + day).alias("created_at"),
        )

    def locations_file(self) -> DataFrame:
        """The location columns as the loaded file holds them."""
        nation, region = self.table("nation"), self.table("region")
        customer = self.table("customer")
        placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        return placed.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            F.col("c_custkey").alias("l_user_id"),
            F.col("c_name").alias("l_street_address"),
            F.col("n_name").alias("l_state"),
            F.col("r_name").alias("l_country"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("l_zip_code"),
        )

    def raw_locations(self) -> DataFrame:
        return self.locations_file().withColumn(LOAD_STAMP, F.lit(LOAD_EPOCH).cast("int"))

    def orders(self, sku: bool = True) -> DataFrame:
        return orders_cleaned(self.raw_orders(sku))

    def users(self) -> DataFrame:
        return users_cleaned(self.raw_users())

    def locations(self) -> DataFrame:
        return locations_cleaned(self.raw_locations())

    def country_cells(self) -> DataFrame:
        """Six text columns per country, as a page shows them: customers and orders count as people."""
        per_user = self.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
        customer = self.table("customer")
        people = (
            customer.join(per_user, customer.c_custkey == per_user.o_custkey, "left")
            .groupBy("c_nationkey")
            .agg(F.count(F.lit(1)).alias("n_users"), F.sum("n_orders").alias("n_orders"))
        )
        nation, region = self.table("nation"), self.table("region")
        return (
            nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .join(people, nation.n_nationkey == people.c_nationkey, "left")
            .select(
                F.col("n_name").alias("country"),
                F.format_number("n_users", 0).alias("before"),
                F.format_number("n_orders", 0).alias("after"),
                F.lit("").alias("change"),
                F.col("r_name").alias("continent"),
                F.concat_ws(" ", "r_name", F.substring("n_name", -1, 1)).alias("region"),
            )
        )

    def listing(self) -> DataFrame:
        """Documents as a listing of changed tables; labels decide the reasons."""
        docs, labels = self.table("documents").select("doc_id", "lang", "source"), self.table("labels")
        clean, toxic = F.col("toxic") == 0, F.col("toxic") == 1
        reasons = (
            F.when((F.col("quality") == 1) & clean, F.array(F.lit("NEW")))
            .when((F.col("quality") == 1) & toxic, F.array(F.lit("TAGS"), F.lit("METADATA")))
            .when((F.col("quality") == 0) & clean, F.array(F.lit("REMOVED"), F.lit("CODE_VERSION")))
            .when((F.col("quality") == 0) & toxic, F.array(F.lit("DEPENDENCIES")))
        )
        return docs.join(labels, "doc_id", "left").select(
            F.array("lang", "source", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))).alias("asset_path"),
            reasons.alias("changed_reasons"),
            F.col("source").alias("location"),
            F.when(F.col("lang") == "en", "__repository__").otherwise(F.col("lang")).alias("repository"),
        )

    def query_history(self) -> DataFrame:
        """Events as commented queries."""
        comment = F.concat(
            F.lit("select 1 /* opaque_id[[[model."), "event_type", F.lit(":"), F.col("event_id").cast("string"), F.lit("]]] */")
        )
        return self.table("events").select(
            comment.alias("query_text"), F.col("ts").alias("start_time"), F.col("value").alias("credits")
        )
