"""Stock movements, balances and the product master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import token
from .clean import latest_by_key
from .running import running_by_chunk

# Upper bounds (exclusive) and labels of the stock classes.
STOCK_CLASSES = ((30, "Low Stock – Reorder Needed"), (51, "Low Stock – Monitor"))
STOCK_OK = "Stock OK"


def movement_ledger(sales: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Stock movements, one row per sale (negative) or delivery (positive)."""
    sold = sales.select(
        "product_id",
        F.col("event_ts").alias("movement_ts"),
        (-F.col("quantity_purchased")).cast("bigint").alias("quantity_change"),
        F.lit("SALE").alias("movement_type"),
        F.col("transaction_id").alias("movement_id"),
    )
    delivered = deliveries.select(
        "product_id",
        F.col("event_ts").alias("movement_ts"),
        F.col("quantity_delivered").cast("bigint").alias("quantity_change"),
        F.lit("DELIVERY").alias("movement_type"),
        F.col("delivery_id").alias("movement_id"),
    )
    return delivered.unionByName(sold).dropna(subset=["product_id"])


def inventory_position(sales: DataFrame, deliveries: DataFrame, links: DataFrame) -> DataFrame:
    """Balance, last movement and latest supplier per product, with its linked title.

    Inputs are de-duplicated. Three per-product results meet on one partitioning by product: the
    balance (combined on the map side), the latest supplier (group limit) and the link.
    """
    balance = movement_ledger(sales, deliveries).groupBy("product_id").agg(
        F.sum("quantity_change").alias("current_quantity"),
        F.max("movement_ts").alias("last_update_ts"),
    )
    supplier = latest_by_key(
        deliveries.select("product_id", "supplier_id", "ingestion_ts", "delivery_id"),
        "product_id", "ingestion_ts", ["delivery_id"],
    ).select("product_id", "supplier_id")
    return (
        balance.join(supplier, on="product_id", how="left")
        .join(links.select("product_id", F.col("anime_id").alias("linked_anime_id")), on="product_id", how="left")
        .select("product_id", "linked_anime_id", "current_quantity", "last_update_ts", "supplier_id")
    )


def product_master(deliveries: DataFrame, sales: DataFrame, links: DataFrame) -> DataFrame:
    """Latest cost, latest price, category and linked title of every product sold or delivered."""
    costs = latest_by_key(
        deliveries.select("product_id", "supplier_id", "unit_cost", "ingestion_ts", "delivery_id"),
        "product_id", "ingestion_ts", ["delivery_id"], "last_cost_update",
    )
    prices = latest_by_key(
        sales.select("product_id", "unit_price_at_sale", "ingestion_ts", "transaction_id"),
        "product_id", "ingestion_ts", ["transaction_id"], "last_price_update",
    )
    return (
        costs.join(prices, on="product_id", how="outer")
        .join(links.select("product_id", F.col("anime_id").alias("linked_anime_id")), on="product_id", how="left")
        .select(
            "product_id",
            "supplier_id",
            F.col("unit_cost").alias("current_unit_cost"),
            F.col("unit_price_at_sale").alias("current_unit_price"),
            "last_cost_update",
            "last_price_update",
            token("product_id", 1).alias("category"),
            "linked_anime_id",
        )
    )


def inventory_status(
    inventory: DataFrame, thresholds: Sequence[tuple[int, str]] = STOCK_CLASSES, otherwise: str = STOCK_OK
) -> DataFrame:
    """Stock level, date and class per product; an unknown level falls to ``otherwise``."""
    status = F.lit(otherwise)
    for bound, label in reversed(sorted(thresholds)):
        status = F.when(F.col("stock_level") < bound, label).otherwise(status)
    return inventory.select(
        "product_id",
        F.col("current_quantity").alias("stock_level"),
        F.to_date("last_update_ts").alias("last_update"),
    ).withColumn("status", status)


def level_at_sale(ledger: DataFrame, chunk: str = "hour") -> DataFrame:
    """Stock level right after each sale: the running balance of the product up to that movement.

    At equal times deliveries come before sales, then ids decide.
    """
    order = [F.col("movement_ts").asc(), F.col("movement_type").asc(), F.col("movement_id").asc()]
    running = running_by_chunk(
        ledger, ["product_id"], "movement_ts", order, "quantity_change", "level", "sum", chunk=chunk
    )
    return running.where(F.col("movement_type") == "SALE").select(
        F.col("movement_id").alias("transaction_id"), "product_id", "level"
    )
