"""Facts, dimensions and report tables of the gold layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_id, exact_sum, money
from .joins import salted_left_join

# Segment label, range of product transactions, range of ticket bookings (both ends
# included, None = no bound), in order of precedence. Counts outside all ranges are LOW.
LOW = "Low Spender"
SEGMENTS = (
    (LOW, (0, 1), (0, 1)),
    ("Moderate - Products", (2, 3), (0, 1)),
    ("Moderate - Tickets", (0, 1), (2, 3)),
    ("Moderate - Both", (2, 3), (2, 3)),
    ("Heavy - Products", (4, None), (0, 1)),
    ("Heavy - Tickets", (0, 1), (4, None)),
    ("Top Customer", (4, None), (4, None)),
)
# Description of each segment.
DESCRIPTIONS = {
    "Low Spender": "Buys few or no products or tickets",
    "Moderate - Products": "Buys 2–3 products, few tickets",
    "Moderate - Tickets": "Buys 2–3 tickets, few products",
    "Moderate - Both": "Buys 2–3 of both tickets and products",
    "Heavy - Products": "Buys >3 products, few tickets",
    "Heavy - Tickets": "Buys >3 tickets, few products",
    "Top Customer": "Buys more than 3 in both products and tickets",
}
UNCATEGORIZED = "Uncategorized"


def fact_sales(
    sales: DataFrame, inventory: DataFrame, levels: DataFrame | None = None, salts: int = 1
) -> DataFrame:
    """Sales facts: one row per cleaned sale with the stock level of its product.

    The level is the present balance from ``inventory`` or, when ``levels`` (transaction_id, level)
    is given, the balance right after the sale.
    """
    if levels is None:
        stock = inventory.select("product_id", F.col("current_quantity").alias("level"))
        joined = salted_left_join(sales, stock, ["product_id"], ["transaction_id"], salts)
    else:
        joined = sales.join(levels.select("transaction_id", "level"), on="transaction_id", how="left")
    return joined.select(
        F.col("transaction_id").alias("sale_id"),
        "customer_id",
        "product_id",
        F.to_date("transaction_ts").alias("calendar_date"),
        F.col("quantity_purchased").alias("quantity"),
        F.col("total_price").alias("revenue"),
        F.col("level").alias("inventory_level_at_sale"),
    )


def fact_screenings(bookings: DataFrame, concession_summary: DataFrame, salts: int = 1) -> DataFrame:
    """One row per booking with the concession revenue of its whole screening.

    That revenue repeats for every booking of a screening: add it up with ``screening_rollup``.
    """
    totals = concession_summary.select("screening_id", "total_revenue")
    return salted_left_join(bookings, totals, ["screening_id"], ["booking_id"], salts).select(
        "booking_id",
        "screening_id",
        F.col("linked_anime_id").alias("anime_id"),
        F.to_date("booking_ts").alias("calendar_date"),
        F.col("total_price").cast("double").alias("ticket_revenue"),
        F.col("total_revenue").cast("double").alias("concession_revenue"),
    )


def stale_screenings(screenings: DataFrame, concession_summary: DataFrame) -> DataFrame:
    """Facts whose concession revenue is no longer that of the summary, with the present one."""
    totals = concession_summary.select("screening_id", F.col("total_revenue").cast("double").alias("_now"))
    joined = screenings.join(totals, on="screening_id", how="left")
    return joined.where(~F.col("concession_revenue").eqNullSafe(F.col("_now"))).select(
        *[F.col("_now").alias(c) if c == "concession_revenue" else F.col(c) for c in screenings.columns]
    )


def screening_totals(screenings: DataFrame) -> DataFrame:
    """One row per screening: its bookings, ticket revenue and, once, its concession revenue."""
    return screenings.groupBy("screening_id", "anime_id").agg(
        F.count("*").alias("bookings"),
        exact_sum("ticket_revenue").alias("ticket_revenue"),
        F.max("concession_revenue").alias("concession_revenue"),
    )


def screening_rollup(screenings: DataFrame) -> DataFrame:
    """Screening revenue per title; concession revenue counts once per screening.

    ``avg_views`` is the mean ticket revenue of a booking. Facts are combined per screening before
    and per title after the shuffle, so a title with very many bookings stays cheap.
    """
    return (
        screening_totals(screenings)
        .groupBy("anime_id")
        .agg(
            exact_sum("ticket_revenue").alias("sales_from_tickets"),
            F.sum("bookings").alias("bookings"),
            exact_sum("concession_revenue").alias("sales_from_concessions"),
        )
        .select(
            "anime_id",
            "sales_from_tickets",
            F.try_divide("sales_from_tickets", "bookings").alias("avg_views"),
            "sales_from_concessions",
        )
    )


def activity_counts(products: DataFrame, tickets: DataFrame, key: str = "customer_id") -> DataFrame:
    """Product transactions and ticket bookings per customer, 0 where there are none.

    Ids are cleaned like those of the customer master.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(clean_id(key).alias(key)).agg(F.count("*").alias(name)).dropna(subset=[key])

    both = counted(products, "product_count").join(counted(tickets, "ticket_count"), on=key, how="outer")
    return both.fillna(0, subset=["product_count", "ticket_count"])


def segment_customers(
    customers: DataFrame,
    counts: DataFrame,
    segments: Sequence[tuple] = SEGMENTS,
    otherwise: str = LOW,
    key: str = "customer_id",
) -> DataFrame:
    """Customers with ``segment`` from their activity; the first range pair that fits decides."""
    def within(name: str, bounds: tuple[int, int | None]) -> Column:
        low, high = bounds
        count = F.coalesce(F.col(name), F.lit(0))
        return count >= low if high is None else count.between(low, high)

    segment = F.lit(otherwise)
    for label, products, tickets in reversed(segments):
        fits = within("product_count", products) & within("ticket_count", tickets)
        segment = F.when(fits, label).otherwise(segment)
    joined = customers.join(counts, on=key, how="left")
    return joined.select(key, "name", segment.alias("segment"), "email")


def segment_summary(
    dim: DataFrame, descriptions: Mapping[str, str] = DESCRIPTIONS, otherwise: str = UNCATEGORIZED
) -> DataFrame:
    """Number of customers and description per segment."""
    text = reduce(
        lambda rest, item: F.when(F.col("segment") == item[0], item[1]).otherwise(rest),
        descriptions.items(), F.lit(otherwise),
    )
    return dim.groupBy("segment").agg(F.count("*").alias("customer_count")).withColumn("description", text)


def top_entities(
    dim: DataFrame, sales: DataFrame, bookings: DataFrame, n: int = 5, measure: str = "pos"
) -> DataFrame:
    """The ``n`` titles with the highest sales and their attendance; equal sales rank by id.

    ``measure`` is ``pos`` (product sales) or ``total`` (product and ticket sales).
    """
    if measure not in ("pos", "total"):
        raise ValueError("measure must be 'pos' or 'total'")
    products = sales.groupBy(F.col("linked_anime_id").alias("anime_id")).agg(
        exact_sum("total_price").alias("pos")
    )
    tickets = bookings.groupBy(F.col("linked_anime_id").alias("anime_id")).agg(
        exact_sum("total_price").alias("tickets"),
        F.sum("quantity_purchased").alias("attendance"),
    )
    total = F.coalesce("pos", F.lit(0.0))
    if measure == "total":
        total = money(total + F.coalesce("tickets", F.lit(0.0)))
    return (
        dim.select("anime_id", "title")
        .join(products, on="anime_id", how="left")
        .join(tickets, on="anime_id", how="left")
        .select(
            "anime_id",
            "title",
            total.alias("total_sales"),
            F.coalesce("attendance", F.lit(0)).cast("bigint").alias("total_attendance"),
        )
        .orderBy(F.col("total_sales").desc(), F.col("anime_id").asc())
        .limit(n)
    )


def sales_by_name(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Product revenue per title name.

    Facts are summed per product before the join, so it sees one row per product, not per sale.
    """
    per_product = sales.groupBy("product_id").agg(exact_sum("revenue").alias("revenue"))
    return (
        per_product.join(products.select("product_id", "name"), on="product_id")
        .groupBy("name")
        .agg(exact_sum("revenue").alias("sales_from_pos"))
    )


def title_features(
    dim: DataFrame, sales: DataFrame, screenings: DataFrame, products: DataFrame,
    upcoming_after: Column | None = None,
) -> DataFrame:
    """Feature row per current title: revenue history from tickets, concessions and products.

    Product revenue reaches a title through the equality of product name and title. With
    ``upcoming_after`` only titles released later are kept.
    """
    if upcoming_after is not None:
        dim = dim.where(F.col("release_date") > upcoming_after)
    parts = ("sales_from_tickets", "sales_from_concessions", "sales_from_pos")
    history = reduce(lambda x, y: x + y, [F.coalesce(F.col(c), F.lit(0.0)) for c in parts])
    return (
        dim.join(screening_rollup(screenings), on="anime_id", how="left")
        .join(sales_by_name(sales, products).withColumnRenamed("name", "title"), on="title", how="left")
        .select(
            "anime_id",
            "title",
            money(history).alias("historical_sales"),
            F.coalesce("avg_views", F.lit(0.0)).alias("avg_views"),
            "season",
            "genre",
        )
    )
