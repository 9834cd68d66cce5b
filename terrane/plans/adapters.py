"""The star-schema test tables in the shape of the sources: sales, deliveries, bookings and so on.

Line items with status F are sales and those with status O are deliveries; purchases are bookings
and clicks are concession purchases. Whole tables are read; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import Scd2Columns, dedupe_latest, scd2_snapshot

TRACKED = ("status", "priority")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_product_id().alias("product_id"))


def _product_id() -> Column:
    """Product name without blanks, product type, part number."""
    name = F.replace("p_name", F.lit(" "), F.lit(""))
    return F.concat_ws("_", name, F.lower("p_type"), _text("p_partkey"))


def _lines(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("line_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
        .withColumn("product_id", _product_id())
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "F").select(
        F.col("line_id").alias("transaction_id"),
        F.col("o_orderdate").alias("event_ts"),
        F.col("l_shipdate").alias("ingestion_ts"),
        _text("o_custkey").alias("customer_id"),
        "product_id",
        F.col("l_quantity").cast("int").alias("quantity_purchased"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price_at_sale"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, "O").select(
        F.col("line_id").alias("delivery_id"),
        F.col("o_orderdate").alias("event_ts"),
        F.col("l_shipdate").alias("ingestion_ts"),
        _text("l_suppkey").alias("supplier_id"),
        "product_id",
        F.col("l_quantity").cast("int").alias("quantity_delivered"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")).alias("unit_cost"),
    )


def _screen_events(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("bigint")
    hall = F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.lit("_hall_"), _text("p_partkey"))
    return (
        table(spark, sf_dir, "events").where(F.col("event_type") == event_type).withColumn("k", number)
        .join(table(spark, sf_dir, "part"), F.col("k") == F.col("p_partkey"))
        .withColumn("screening_id", hall)
        .withColumn("units", F.ceil(F.col("value") / 25).cast("int"))
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _screen_events(spark, sf_dir, "purchase").select(
        _text("event_id").alias("booking_id"),
        F.col("ts").alias("event_ts"),
        F.col("ts").alias("ingestion_ts"),
        _text("user_id").alias("customer_id"),
        "screening_id",
        F.col("units").alias("quantity_purchased"),
        F.col("value").alias("unit_price_at_sale"),
    )


def concessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _screen_events(spark, sf_dir, "click").select(
        _text("event_id").alias("purchase_id"),
        F.col("ts").alias("ingestion_ts"),
        "screening_id",
        F.col("units").alias("item_quantity"),
        F.col("value").alias("item_unit_price"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue: product names, and the nouns in them."""
    part = table(spark, sf_dir, "part")

    def catalogue(text: Column, prefix: str) -> DataFrame:
        return (
            part.groupBy(text.alias("title"))
            .agg(
                F.concat(F.lit(prefix), F.min("p_partkey").cast("string")).alias("anime_id"),
                F.min("p_type").alias("genre"),
                F.min("p_brand").alias("studio"),
                F.max("p_brand").alias("season"),
            )
        )

    return catalogue(F.col("p_name"), "name-").unionByName(catalogue(F.get(F.split("p_name", " "), F.lit(1)), "noun-"))


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        _text("o_orderkey").alias("registration_id"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), _text("o_custkey"), F.lit("."), F.lower("o_orderstatus"), F.lit("@example.com")).alias("email"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), _text("c_custkey"), F.lit("@example.com")).alias("email"),
    )


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a version of its customer: status and priority from the order date on."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("effective_start_date"),
        F.col("o_orderkey").alias("order_id"),
    )


def snapshot(
    spark: SparkSession, sf_dir: str, before: str | None = None, since: str | None = None
) -> DataFrame:
    """Latest version per customer among all orders or those of a period."""
    versions = order_versions(spark, sf_dir)
    if before:
        versions = versions.where(F.col("effective_start_date") < F.lit(before).cast("timestamp_ntz"))
    if since:
        versions = versions.where(F.col("effective_start_date") >= F.lit(since).cast("timestamp_ntz"))
    return dedupe_latest(versions, ["customer_id"], ["effective_start_date", "order_id"]).drop("order_id")


def opened(versions: DataFrame) -> DataFrame:
    """Versions as the open rows of a new dimension."""
    return versions.select(
        "customer_id", *TRACKED, "effective_start_date",
        F.lit(None).cast("timestamp_ntz").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension with history: the state of 1996 after the snapshot of 1997."""
    first = opened(snapshot(spark, sf_dir, "1996-01-01"))
    return scd2_snapshot(
        first, snapshot(spark, sf_dir, "1997-01-01"), "customer_id", TRACKED, "1997-01-01 00:00:00",
        cols=Scd2Columns(),
    )
