"""Silver to gold refresh."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import clean, inventory, marts, quality, scd2
from ..sources.lake import Lake
from ..sources.scratch import stage_measured
from . import silver

log = logging.getLogger(__name__)

SALES = "silver.silver_pos_transactions_clean"
BOOKINGS = "silver.silver_ticket_bookings_clean"
STOCK = "silver.silver_inventory_movements_clean"
PRODUCTS = "silver.silver_product_master_data"
CUSTOMERS = "silver.silver_customer_master_data"
TITLES = "silver.silver_anime_broadcast_schedule_scd2"
CONCESSIONS = "silver.silver_concession_sales_summary"

PRODUCT_TRACKED = ("name", "category", "price", "cost", "supplier_id")
TITLE_HASHED = ("anime_id", "genre", "title", "studio", "release_date", "season")


def append_facts(
    lake: Lake, table: str, rows: DataFrame, id_col: str, not_null: list[str],
    suspicious: dict[str, Column], on_fail: str,
) -> None:
    """Stage new facts, gate them, count suspicious values, append.

    ``on_fail`` ``abort`` raises on a missing value, ``warn`` appends all the same, ``quarantine``
    publishes the rows with missing or suspicious values as ``<table>_rejects`` and appends the good ones.
    """
    missing = quality.null_counts(rows, not_null)
    counts = {rule: F.count_if(cond) for rule, cond in suspicious.items()}
    batch, seen = stage_measured(rows, {"rows": F.count("*"), **missing, **counts})
    if not seen["rows"]:
        log.info("%s: nothing new", table)
        return
    if on_fail == "quarantine":
        batch, bad = quality.quarantine(batch, {
            **{f"{c} present": F.col(c).isNotNull() for c in not_null},
            **{f"not: {rule}": ~F.coalesce(cond, F.lit(False)) for rule, cond in suspicious.items()},
        })
        lake.publish(f"{table}_rejects", bad)
    else:
        quality.enforce_counts({rule: seen[rule] for rule in missing}, table, on_fail)
    quality.enforce(quality.dq_report(batch, [id_col]), table)
    quality.enforce_counts({rule: seen[rule] for rule in counts}, table, "warn")
    lake.append(table, batch)


def measured(rows: DataFrame, table: str, suspicious: dict[str, Column], not_null: list[str] = ()) -> DataFrame:
    """``rows`` staged; suspicious and missing values are logged."""
    counts = {rule: F.count_if(cond) for rule, cond in suspicious.items()}
    staged, seen = stage_measured(rows, {**counts, **quality.null_counts(rows, not_null)})
    quality.enforce_counts(seen, table, "warn")
    return staged


def refresh_fact_sales(
    lake: Lake, on_fail: str = "abort", salts: int = 1, level_as_of_sale: bool = False
) -> None:
    """New sales with the present stock level, or the level right after the sale."""
    table = "gold.fact_sales"
    sales, stock = lake.load(SALES), lake.load(STOCK)
    if sales is None or stock is None:
        return
    known = lake.load_or_empty(table).select(F.col("sale_id").alias("transaction_id"))
    fresh = clean.new_rows_only(sales, known, ["transaction_id"])
    levels = None
    if level_as_of_sale:
        levels = inventory.level_at_sale(inventory.movement_ledger(silver.sold(lake), silver.delivered(lake)))
    append_facts(
        lake, table, marts.fact_sales(fresh, stock, levels, salts), "sale_id",
        ["sale_id", "product_id", "customer_id"],
        {"revenue not positive": F.col("revenue") <= 0, "quantity negative": F.col("quantity") < 0},
        on_fail,
    )


def refresh_fact_screenings(lake: Lake, on_fail: str = "abort", salts: int = 1) -> None:
    table = "gold.fact_screenings"
    bookings, concessions = lake.load(BOOKINGS), lake.load(CONCESSIONS)
    if bookings is None or concessions is None:
        return
    facts = lake.load_or_empty(table)
    stale, seen = stage_measured(marts.stale_screenings(facts, concessions), {"rows": F.count("*")})
    if seen["rows"]:
        dates = lake.replace_rows(table, stale, ["booking_id"])
        log.info("%s: concession revenue of %d bookings on %d dates has changed", table, seen["rows"], len(dates))
    fresh = clean.new_rows_only(bookings, lake.load_or_empty(table), ["booking_id"])
    append_facts(
        lake, table, marts.fact_screenings(fresh, concessions, salts), "booking_id",
        ["booking_id", "screening_id"],
        {f"{c} negative": F.col(c) < 0 for c in ("ticket_revenue", "concession_revenue")},
        on_fail,
    )


def refresh_dim_customer(lake: Lake) -> None:
    table = "gold.dim_customer"
    tickets, products, customers = lake.load(BOOKINGS), lake.load(SALES), lake.load(CUSTOMERS)
    if tickets is None or products is None or customers is None:
        return
    segmented = silver.checked(
        marts.segment_customers(customers, marts.activity_counts(products, tickets)), ["customer_id"], table
    )
    if segmented is not None:
        lake.publish(table, clean.replace_by_key(lake.load_or_empty(table), segmented, ["customer_id"]))


def refresh_segments(lake: Lake) -> None:
    """Recomputed whole, so a segment that lost its last member disappears."""
    customers = lake.load("gold.dim_customer")
    if customers is not None:
        segments = silver.checked(marts.segment_summary(customers), ["segment"], "gold.customer_segments")
        if segments is not None:
            lake.publish("gold.customer_segments", segments)


def current_titles(lake: Lake) -> DataFrame:
    return lake.load_or_empty(TITLES).where(F.col("is_current_broadcast"))


def refresh_tiles(lake: Lake, measure: str = "pos") -> None:
    table = "gold.gold_top_anime_performance_tiles"
    tiles = silver.checked(marts.top_entities(
        current_titles(lake), lake.load_or_empty(SALES), lake.load_or_empty(BOOKINGS), measure=measure
    ), ["anime_id"], table)
    if tiles is not None:
        lake.publish(table, tiles)


def refresh_inventory_summary(lake: Lake, as_of: Column) -> None:
    table = "gold.gold_inventory_summary"
    status = measured(
        inventory.inventory_status(lake.load_or_empty(STOCK)).withColumn("ingestion_ts", as_of), table,
        {"stock_level negative": F.col("stock_level") < 0}, ["product_id", "stock_level", "last_update"],
    )
    quality.enforce(quality.dq_report(status, ["product_id"]), table, "warn")
    lake.publish(table, status)


def refresh_dim_product(lake: Lake, as_of: Column, on_missing: str = "keep") -> None:
    """Product versions, named by the linked current title."""
    table = "gold.dim_product"
    names = current_titles(lake).select(F.col("anime_id").alias("linked_anime_id"), F.col("title").alias("name"))
    incoming = (
        lake.load_or_empty(PRODUCTS)
        .join(names, on="linked_anime_id", how="left")
        .select(
            "product_id",
            "name",
            "category",
            F.col("current_unit_price").alias("price"),
            F.col("current_unit_cost").alias("cost"),
            "supplier_id",
            F.coalesce("last_price_update", "last_cost_update").alias("effective_start_date"),
        )
    )
    versions = measured(
        scd2.scd2_snapshot(lake.load_or_empty(table), incoming, "product_id", PRODUCT_TRACKED, as_of, on_missing),
        table, {f"{c} not positive": F.col(c) <= 0 for c in ("price", "cost")},
    )
    report = quality.dq_report(versions, ["product_id", "effective_start_date"], ["product_id"])
    quality.enforce(report, table)
    lake.publish(table, versions)


def refresh_dim_title(lake: Lake) -> None:
    """Title versions by content hash; nothing is written when nothing changed."""
    table = "gold.dim_anime_title_scd2"
    incoming = lake.load_or_empty(TITLES).select(
        "anime_id", "genre", "title", "studio", F.col("broadcast_start_ts").alias("release_date"), "season",
        "effective_start_date", "effective_end_date", F.col("is_current_broadcast").alias("is_current"),
    )
    target = lake.load_or_empty(table)
    added = scd2.hash_diff_append(target, incoming, "anime_id", TITLE_HASHED, "effective_start_date")
    closed = scd2.closure_updates(target, incoming, "anime_id", TITLE_HASHED)
    changes, seen = stage_measured(added.unionByName(closed), {"rows": F.count("*")})
    if seen["rows"]:
        versions = clean.replace_by_key(target, changes, ["anime_id", "record_hash", "effective_start_date"])
        lake.publish(table, silver.checked(versions, ["anime_id", "effective_start_date"], table))


def refresh_features(lake: Lake, upcoming_after: Column | None = None) -> None:
    table = "gold.ML_features_upcoming_titles"
    features = marts.title_features(
        lake.load_or_empty("gold.dim_anime_title_scd2").where(F.col("is_current")),
        lake.load_or_empty("gold.fact_sales"),
        lake.load_or_empty("gold.fact_screenings"),
        lake.load_or_empty("gold.dim_product").where(F.col("is_current")),
        upcoming_after,
    )
    suspicious = {f"{c} negative": F.col(c) < 0 for c in ("historical_sales", "avg_views")}
    lake.publish(table, measured(features, table, suspicious))


def run_silver_to_gold(lake: Lake, as_of: Column | None = None, on_fail: str = "abort") -> None:
    """All gold tables, in dependency order.

    A step that fails leaves its table as it was and the others go on; the run fails at its end.
    """
    now = F.current_timestamp() if as_of is None else as_of
    steps = {
        "fact_sales": lambda: refresh_fact_sales(lake, on_fail),
        "fact_screenings": lambda: refresh_fact_screenings(lake, on_fail),
        "dim_customer": lambda: refresh_dim_customer(lake),
        "segments": lambda: refresh_segments(lake),
        "tiles": lambda: refresh_tiles(lake),
        "inventory_summary": lambda: refresh_inventory_summary(lake, now),
        "dim_product": lambda: refresh_dim_product(lake, now),
        "dim_title": lambda: refresh_dim_title(lake),
        "features": lambda: refresh_features(lake),
    }
    failed = []
    for name, step in steps.items():
        try:
            step()
        except Exception as error:
            log.exception("%s failed", name)
            failed.append((name, error))
    if failed:
        raise quality.QualityError("; ".join(f"{name}: {error}" for name, error in failed)) from failed[0][1]
