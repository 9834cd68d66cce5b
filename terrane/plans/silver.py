"""Bronze to silver refresh. Each step may be run alone and twice: the second run changes nothing."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import no_amount
from ..operators import clean, inventory, link, quality, scd2
from ..schemas import LANDED
from ..sources.lake import Lake
from ..sources.scratch import stage, stage_measured
from .known import KnownKeys

log = logging.getLogger(__name__)

SALES = "bronze.bronze_pos_transaction_events"
DELIVERIES = "bronze.bronze_supplier_delivery_events"
BOOKINGS = "bronze.bronze_ticket_booking_events"
CONCESSIONS = "bronze.bronze_concession_purchase_events"
TITLES = "bronze.bronze_anime_broadcast_schedule"
REGISTRATIONS = "bronze.bronze_customer_registration_events"

TITLES_SCD2 = "silver.silver_anime_broadcast_schedule_scd2"
TITLE_TRACKED = ("title", "genre", "studio", "broadcast_start_ts", "broadcast_end_ts", "season")
TITLE_VALIDITY = scd2.Scd2Columns(current="is_current_broadcast", open_end="9999-12-31 23:59:59")
# Fixed value: a screening links only to titles of at least this many characters.
SCREENING_MIN_LEN = 3


def checked(rows: DataFrame, keys: list[str], name: str) -> DataFrame | None:
    """``rows`` staged and gated, or None when there are none.

    Rows and NULL keys are counted while the stage is written; only uniqueness needs another pass,
    over the key columns. A failed gate raises before anything is published.
    """
    batch, seen = stage_measured(rows, {"rows": F.count("*"), **quality.null_counts(rows, keys)})
    if not seen.pop("rows"):
        log.info("%s: nothing new", name)
        return None
    quality.enforce_counts(seen, name)
    quality.enforce(quality.dq_report(batch, keys), name)
    return batch


def refresh_transactions(
    lake: Lake, events: str, table: str, id_col: str, link_key: str, ts_as: str, links: DataFrame,
    since: datetime | str | None = None, bits: bool = False,
) -> None:
    """Clean the events whose id is not in ``table`` yet and append them.

    Known ids leave before the de-duplication, so its shuffle carries new events only. With
    ``since`` only events that landed then or later are looked at, by the clock of the ingest, and older
    files are skipped; events without a landing time are always looked at. With ``bits`` bitmaps beside the table
    prove most new ids new, and only the others are looked for in it. Events whose price times
    quantity is no amount of money go to ``<table>_rejects`` as they came.
    """
    source = lake.load(events)
    if source is None:
        return
    if since is not None:
        landed = F.col(LANDED) >= F.lit(since).cast("timestamp")
        source = stage(source.where(landed | F.col(LANDED).isNull()))
    known_ids = KnownKeys(lake, table, [id_col])
    if bits:
        fresh = known_ids.new_rows(source)
    else:
        fresh = clean.new_rows_only(source, lake.load_or_empty(table), [id_col], small=since is not None)
    fresh = stage(fresh.drop(LANDED))
    broken = no_amount(F.col("unit_price_at_sale") * F.col("quantity_purchased"))
    rejected = fresh.where(broken)
    if not rejected.isEmpty():
        log.warning("%s: events without a readable amount are set aside", table)
        known = lake.load(f"{table}_rejects")
        lake.append(f"{table}_rejects", rejected if known is None else clean.new_rows_only(rejected, known, [id_col]))
    fresh = fresh.where(~F.coalesce(broken, F.lit(False)))
    rows = clean.clean_transactions(fresh, id_col, link_key, links, "anime_id", ts_as)
    batch = checked(rows, [id_col], table)
    if batch is not None:
        if bits:
            known_ids.append(batch)
        else:
            lake.append(table, batch)


def product_links(lake: Lake) -> DataFrame:
    """Linked title per product that was sold or delivered."""
    products = lake.load_or_empty(SALES).select("product_id").unionByName(
        lake.load_or_empty(DELIVERIES).select("product_id")
    )
    return link.link_entities(products, "product_id", lake.load_or_empty(TITLES), "anime_id", "title")


def screening_links(lake: Lake) -> DataFrame:
    """Linked title per booked screening."""
    return link.link_entities(
        lake.load_or_empty(BOOKINGS), "screening_id", lake.load_or_empty(TITLES), "anime_id", "title",
        min_len=SCREENING_MIN_LEN,
    )


def sold(lake: Lake) -> DataFrame:
    """The cleaned sales in the shape of sale events."""
    return lake.load_or_empty("silver.silver_pos_transactions_clean").withColumnRenamed("transaction_ts", "event_ts")


def delivered(lake: Lake) -> DataFrame:
    """Deliveries, each id once."""
    deliveries = lake.load_or_empty(DELIVERIES).dropna(subset=["product_id"])
    return clean.dedupe_latest(deliveries, ["delivery_id"], ["ingestion_ts"])


def refresh_products(lake: Lake, links: DataFrame) -> None:
    """Product master and stock balances: fresh values replace those of the same product.

    The latest record of a product is the same with and without repeated events, so the master
    reads the events as they are and each task sends at most one row per product. The balance
    adds up the cleaned sales, which hold each id once, and needs no second de-duplication.
    """
    events = lake.load_or_empty(SALES).dropna(subset=["transaction_id", "product_id"])
    supplies = lake.load_or_empty(DELIVERIES).dropna(subset=["delivery_id", "product_id"])
    masters = {
        "silver.silver_product_master_data": inventory.product_master(supplies, events, links),
        "silver.silver_inventory_movements_clean": inventory.inventory_position(sold(lake), delivered(lake), links),
    }
    for table, rows in masters.items():
        updates = checked(rows, ["product_id"], table)
        if updates is not None:
            lake.publish(table, clean.replace_by_key(lake.load_or_empty(table), updates, ["product_id"]))


def refresh_customers(lake: Lake) -> None:
    table = "silver.silver_customer_master_data"
    updates = checked(clean.customer_master(lake.load_or_empty(REGISTRATIONS)), ["customer_id"], table)
    if updates is not None:
        lake.publish(table, clean.replace_by_key(lake.load_or_empty(table), updates, ["customer_id"]))


def refresh_titles(lake: Lake) -> None:
    """Versions of the broadcast schedule, one for every change in any load since the last refresh.

    Loads that start after a title's current version extend its history; a differing load that does not is set
    aside in a table of its own, where the next refresh doesn't look.
    """
    table = TITLES_SCD2
    start = TITLE_VALIDITY.start
    current = lake.load_or_empty(table)
    loads = lake.load_or_empty(TITLES).withColumnRenamed("ingestion_ts", start).select("anime_id", *TITLE_TRACKED, start)
    last = current.where(F.col(TITLE_VALIDITY.current)).select("anime_id", F.col(start).alias("_since"), F.lit(True).alias("_known"))
    placed = loads.dropna(subset=["anime_id"]).join(last, "anime_id", "left")
    newer = F.col("_known").isNull() | F.coalesce(F.col(start) > F.col("_since"), F.col("_since").isNull() & F.col(start).isNotNull())
    fresh, seen = stage_measured(placed.withColumn("_newer", newer), {"new": F.count_if(newer), "old": F.count_if(~newer)})
    if seen["old"]:
        # What the dimension holds at or before its current version is no news.
        known = current.select("anime_id", *TITLE_TRACKED).distinct()
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("anime_id", *TITLE_TRACKED)]
        late = stage(fresh.where(~F.col("_newer")).alias("l").join(known.alias("k"), same, "left_anti").select("anime_id", *TITLE_TRACKED, start).distinct())
        if not late.isEmpty():
            log.warning("%s: versions older than the current one are set aside", table)
            lake.publish(f"{table}_late", late)
    if seen["new"]:
        touched = fresh.where("_newer").select("anime_id").distinct()
        versions = current.join(touched, "anime_id", "left_semi").select("anime_id", *TITLE_TRACKED, start)
        merged = scd2.scd2_history(
            versions.unionByName(fresh.where("_newer").select(*versions.columns)), "anime_id", TITLE_TRACKED, TITLE_VALIDITY
        )
        shaped = merged.withColumn(TITLE_VALIDITY.end, F.col(TITLE_VALIDITY.end).cast("timestamp"))
        lake.publish(table, checked(clean.replace_by_key(current, shaped, ["anime_id"]), ["anime_id", start], table))


def refresh_concessions(lake: Lake) -> None:
    table = "silver.silver_concession_sales_summary"
    rows = checked(clean.revenue_summary(
        lake.load_or_empty(CONCESSIONS).dropna(subset=["screening_id"]),
        "screening_id", "item_quantity", "item_unit_price", "purchase_id",
    ), ["screening_id"], table)
    if rows is not None:
        lake.publish(table, rows)


def run_bronze_to_silver(lake: Lake, since: datetime | str | None = None, bits: bool = False) -> None:
    """All silver tables, in dependency order; ``since`` limits the event tables to later arrivals, ``bits`` keeps bitmaps of their ids."""
    links = stage(product_links(lake))
    refresh_transactions(
        lake, SALES, "silver.silver_pos_transactions_clean", "transaction_id", "product_id",
        "transaction_ts", links, since, bits,
    )
    refresh_transactions(
        lake, BOOKINGS, "silver.silver_ticket_bookings_clean", "booking_id", "screening_id",
        "booking_ts", screening_links(lake), since, bits,
    )
    refresh_products(lake, links)
    refresh_customers(lake)
    refresh_titles(lake)
    refresh_concessions(lake)
