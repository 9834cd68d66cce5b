"""One query per operator, over the test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from .. import operators as ops
from ..operators.marts import SEGMENTS
from ..sources import replace_in_parts, stage, stage_parts
from ..streaming import late_events as mark_late
from ..streaming import parse_json_events, split_events
from . import adapters as src


class Shop:
    """Intermediate results that several steps of one query share.

    The links are staged: each use would repeat the search. The rest stays lazy, and Spark reuses
    the shuffles of repeated parts of a plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def titles(self) -> DataFrame:
        return src.titles(self.spark, self.sf_dir)

    @cached_property
    def links(self) -> DataFrame:
        products = src.products(self.spark, self.sf_dir)
        return stage(ops.link_entities(products, "product_id", self.titles, "anime_id", "title"))

    @cached_property
    def bookings(self) -> DataFrame:
        return src.bookings(self.spark, self.sf_dir)

    @cached_property
    def sales(self) -> DataFrame:
        return ops.dedupe_latest(src.sales(self.spark, self.sf_dir), ["transaction_id"], ["ingestion_ts"])

    @cached_property
    def deliveries(self) -> DataFrame:
        return ops.dedupe_latest(src.deliveries(self.spark, self.sf_dir), ["delivery_id"], ["ingestion_ts"])

    @cached_property
    def clean_sales(self) -> DataFrame:
        return ops.clean_transactions(
            src.sales(self.spark, self.sf_dir), "transaction_id", "product_id", self.links, "anime_id",
            "transaction_ts",
        )

    def screening_links(self, min_len: int) -> DataFrame:
        return ops.link_entities(self.bookings, "screening_id", self.titles, "anime_id", "title", min_len)

    @cached_property
    def clean_bookings(self) -> DataFrame:
        return ops.clean_transactions(
            self.bookings, "booking_id", "screening_id", self.screening_links(3), "anime_id", "booking_ts"
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return ops.inventory_position(self.sales, self.deliveries, self.links)

    @cached_property
    def concessions(self) -> DataFrame:
        return ops.revenue_summary(
            src.concessions(self.spark, self.sf_dir), "screening_id", "item_quantity", "item_unit_price",
            "purchase_id",
        )

    @cached_property
    def fact_sales(self) -> DataFrame:
        return ops.fact_sales(self.clean_sales, self.inventory)

    @cached_property
    def revenue(self) -> DataFrame:
        """What the marts need of the sales facts; without the stock level there is no balance to compute."""
        return self.clean_sales.select("product_id", F.col("total_price").alias("revenue"))

    @cached_property
    def fact_screenings(self) -> DataFrame:
        return ops.fact_screenings(self.clean_bookings, self.concessions)

    @cached_property
    def named_products(self) -> DataFrame:
        names = self.titles.select("anime_id", F.col("title").alias("name"))
        return self.links.join(names, on="anime_id").select("product_id", "name")


# --- primitives ---------------------------------------------------------------------------------

def line_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived and renamed columns."""
    return src.sales(spark, sf_dir).select(
        "transaction_id",
        F.col("event_ts").alias("transaction_ts"),
        "product_id",
        "quantity_purchased",
        X.money(F.col("unit_price_at_sale") * F.col("quantity_purchased")).alias("total_price"),
    )


def current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the open versions of a dimension."""
    return src.dimension(spark, sf_dir).where(F.col("is_current"))


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their orders; some have none."""
    customer = src.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")
    orders = src.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "customer_id")
    return customer.join(orders, on="customer_id", how="left").select(
        "customer_id", "c_name", "c_acctbal", "o_orderkey", "o_orderstatus"
    )


def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their orders, if any."""
    return _customer_orders(spark, sf_dir)


def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the same without customers that have none."""
    return _customer_orders(spark, sf_dir).dropna(subset=["customer_id", "o_orderkey"])


def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event counts by user and order counts by customer on one coalesced key."""
    events = src.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("customer_id")).agg(F.count("*").alias("n_events"))
    orders = src.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count("*").alias("n_orders"))
    return events.join(orders, on="customer_id", how="outer")


def new_rows_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales that are not among those shipped before 1998."""
    sales = src.sales(spark, sf_dir)
    known = sales.where(F.col("ingestion_ts") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return ops.new_rows_only(sales, known, ["transaction_id"])


def new_rows_by_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 by bitmaps of the known keys: only keys with a set bit are compared with the table."""
    sales = src.sales(spark, sf_dir)
    known = sales.where(F.col("ingestion_ts") < F.lit("1998-01-01").cast("timestamp_ntz"))
    slots = ops.slots_for(known.count())
    bits = ops.key_bits(known, ["transaction_id"], slots)
    return ops.new_rows_by_bits(sales, known, ["transaction_id"], bits, slots)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_keys(src.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products with normalised id and category."""
    return src.sales(spark, sf_dir).select("product_id").distinct().select(
        "product_id",
        X.normalized("product_id").alias("normalized_id"),
        X.token("product_id", 1).alias("category"),
        X.token("product_id", 7).alias("absent"),
    )


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).sales


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ops.latest_by_key(
        Shop(spark, sf_dir).sales, "product_id", "ingestion_ts", ["transaction_id"], "last_price_update"
    )
    return latest.select("product_id", "transaction_id", "unit_price_at_sale", "last_price_update")


# --- links --------------------------------------------------------------------------------------

def link_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.link_entities(
        src.products(spark, sf_dir), "product_id", src.titles(spark, sf_dir), "anime_id", "title"
    )


def link_min_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screenings link only to titles of at least 5 characters."""
    return Shop(spark, sf_dir).screening_links(5)


def link_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage; whole texts."""
    return ops.link_entities(
        src.table(spark, sf_dir, "documents"), "doc_id", src.table(spark, sf_dir, "benchmark"),
        "item_id", "text", text="text", gram=24,
    )


# --- silver -------------------------------------------------------------------------------------

def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).clean_sales


def clean_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).clean_bookings


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return ops.product_master(shop.deliveries, shop.sales, shop.links)


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.customer_master(src.registrations(spark, sf_dir))


def movement_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return ops.movement_ledger(shop.sales, shop.deliveries)


def inventory_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).inventory


def revenue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).concessions


# --- versions -----------------------------------------------------------------------------------

def scd2_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which customers of 1999 are new or changed since 1997."""
    old = src.snapshot(spark, sf_dir, "1997-01-01").alias("old")
    new = src.snapshot(spark, sf_dir, "1999-01-01").alias("new")
    changed = X.any_changed((F.col(f"new.{c}"), F.col(f"old.{c}")) for c in src.TRACKED)
    return new.join(old, F.col("new.customer_id") == F.col("old.customer_id"), "left").select(
        F.col("new.customer_id").alias("customer_id"),
        F.col("old.customer_id").isNull().alias("is_new"),
        changed.alias("is_changed"),
    )


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of every customer meets a dimension that knows orders before 1998."""
    current = src.opened(src.snapshot(spark, sf_dir, "1998-01-01"))
    incoming = src.snapshot(spark, sf_dir)
    return ops.scd2_apply(current, incoming, "customer_id", src.TRACKED)


def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = src.opened(src.snapshot(spark, sf_dir, "1998-01-01"))
    return ops.scd2_merge(current, _changes(spark, sf_dir), "customer_id")


def _snapshot_1999(spark: SparkSession, sf_dir: str, on_missing: str) -> DataFrame:
    """Customers without an order in 1998 are missing from the incoming snapshot."""
    return ops.scd2_snapshot(
        src.dimension(spark, sf_dir), src.snapshot(spark, sf_dir, "1999-01-01", since="1998-01-01"),
        "customer_id", src.TRACKED, "1999-01-01 00:00:00", on_missing,
    )


def scd2_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot_1999(spark, sf_dir, "keep")


def scd2_close_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot_1999(spark, sf_dir, "close")


HASHED = ("customer_id", "status", "priority", "effective_start_date")


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a load of its customer; all of them make the dimension at once."""
    return ops.scd2_history(src.order_versions(spark, sf_dir), "customer_id", src.TRACKED)


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.order_versions(spark, sf_dir).select("order_id", X.row_hash(HASHED).alias("record_hash"))


def hash_diff_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = src.order_versions(spark, sf_dir)
    known = versions.where(F.col("effective_start_date") < F.lit("1998-01-01").cast("timestamp_ntz"))
    target = known.withColumn("record_hash", X.row_hash(HASHED))
    return ops.hash_diff_append(target, versions, "customer_id", HASHED, "effective_start_date")


def closure_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions open in 1996 that the dimension of 1997 has closed."""
    target = src.opened(src.snapshot(spark, sf_dir, "1996-01-01")).withColumn("record_hash", X.row_hash(HASHED))
    return ops.closure_updates(target, src.dimension(spark, sf_dir), "customer_id", HASHED)


def hash_diff_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = src.opened(src.snapshot(spark, sf_dir, "1996-01-01")).withColumn("record_hash", X.row_hash(HASHED))
    return ops.hash_diff_refresh(target, src.dimension(spark, sf_dir), "customer_id", HASHED)


def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.replace_by_key(
        src.snapshot(spark, sf_dir, "1997-01-01"),
        src.snapshot(spark, sf_dir, "1999-01-01", since="1998-01-01"), ["customer_id"],
    )


# --- gold ---------------------------------------------------------------------------------------

def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).fact_sales


def level_at_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.level_at_sale(movement_ledger(spark, sf_dir), chunk="quarter")


def fact_screenings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Shop(spark, sf_dir).fact_screenings


def screening_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that knew the concessions before mid-January, after those of all time have come in."""
    shop = Shop(spark, sf_dir)
    early = src.concessions(spark, sf_dir).where(F.col("ingestion_ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    known = ops.revenue_summary(early, "screening_id", "item_quantity", "item_unit_price", "purchase_id")
    facts = ops.fact_screenings(shop.clean_bookings, known)
    return ops.replace_by_key(facts, ops.stale_screenings(facts, shop.concessions), ["booking_id"])


def screening_refresh_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same refresh of facts partitioned by date: only the dates of stale facts are read again and written."""
    shop = Shop(spark, sf_dir)
    early = src.concessions(spark, sf_dir).where(F.col("ingestion_ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    known = ops.revenue_summary(early, "screening_id", "item_quantity", "item_unit_price", "purchase_id")
    facts = ops.fact_screenings(shop.clean_bookings, known)
    path = stage_parts(facts, "calendar_date")
    stale = ops.stale_screenings(spark.read.schema(facts.schema).parquet(path).select(*facts.columns), shop.concessions)
    return replace_in_parts(spark, path, stale, ["booking_id"], "calendar_date")


def screening_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.screening_totals(Shop(spark, sf_dir).fact_screenings)


def screening_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.screening_rollup(Shop(spark, sf_dir).fact_screenings)


def activity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are product transactions, purchases are ticket bookings."""
    orders = src.table(spark, sf_dir, "orders")
    events = src.table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return ops.activity_counts(
        orders.withColumnRenamed("o_custkey", "customer_id"), events.withColumnRenamed("user_id", "customer_id")
    )


# Ranges of the segments for counts over the whole period of the test tables.
WHOLE_PERIOD = tuple(
    (name, *[{(0, 1): (0, few - 1), (2, 3): (few, many - 1), (4, None): (many, None)}[bounds] for bounds, few, many in zip(ranges, (9, 12), (12, 16), strict=True)])
    for name, *ranges in SEGMENTS
)


def customer_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_customers(src.customers(spark, sf_dir), activity_counts(spark, sf_dir), WHOLE_PERIOD)


def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_summary(customer_segmentation(spark, sf_dir))


def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return ops.top_entities(shop.titles, shop.clean_sales, shop.clean_bookings)


def top_entities_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return ops.top_entities(shop.titles, shop.clean_sales, shop.clean_bookings, measure="total")


def inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.inventory_status(Shop(spark, sf_dir).inventory)


def sales_by_dim_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return ops.sales_by_name(shop.revenue, shop.named_products)


def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = Shop(spark, sf_dir)
    return ops.title_features(shop.titles, shop.revenue, shop.fact_screenings, shop.named_products)


# --- quality ------------------------------------------------------------------------------------

def gate_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dq_report(_customer_orders(spark, sf_dir), non_null_cols=["customer_id", "c_acctbal", "o_orderkey"])


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dq_report(
        _customer_orders(spark, sf_dir), ["customer_id"], ["customer_id", "c_name", "o_orderkey"], ["c_acctbal"]
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "has an order": F.col("o_orderkey").isNotNull(),
        "positive balance": F.col("c_acctbal") > 0,
        "not pending": F.col("o_orderstatus") != "P",
    }
    _, bad = ops.quarantine(_customer_orders(spark, sf_dir), rules)
    return bad.withColumn("failed_rules", F.array_join("failed_rules", "; "))


# --- streams, batch form ------------------------------------------------------------------------

def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages, with conversation turns as messages that are not JSON."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    event = F.struct(
        F.col("event_id").cast("string").alias("booking_id"), stamp.alias("event_ts"), stamp.alias("ingestion_ts"),
        F.col("user_id").cast("string").alias("customer_id"), F.col("event_type").alias("screening_id"),
        F.col("value").alias("unit_price_at_sale"), F.col("props").alias("unknown_field"),
    )
    events = src.table(spark, sf_dir, "events").select(F.to_json(event).alias("value"))
    return events.unionByName(src.table(spark, sf_dir, "conversations").select(F.col("text").alias("value")))


EVENT = (
    "booking_id STRING, event_ts STRING, ingestion_ts STRING, customer_id STRING, screening_id STRING,"
    " quantity_purchased INT, unit_price_at_sale DOUBLE"
)


def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_events(parse_json_events(_messages(spark, sf_dir), EVENT), "booking_id")
    utc = {
        c: F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz") for c in ("event_ts", "ingestion_ts")
    }
    return good.withColumns(utc)


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_events(parse_json_events(_messages(spark, sf_dir), EVENT), "booking_id")
    return bad


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that are more than a year behind their supplier's latest earlier arrival."""
    return mark_late(
        Shop(spark, sf_dir).deliveries.select("delivery_id", "supplier_id", "event_ts", "ingestion_ts"),
        "supplier_id", "delivery_id", delay_seconds=365 * 86400, chunk="quarter",
    )


QUERIES = (
    clean_sales, line_total, current_rows, dropna_subset, join_left, join_full, new_rows_only, new_rows_by_bits, duplicate_keys,
    distinct_keys, dedupe_latest, latest_by_key, link_entities, link_min_len, link_docs, clean_bookings,
    product_master, customer_master, movement_ledger, inventory_position, revenue_summary, scd2_changed,
    scd2_apply, scd2_merge, scd2_history, scd2_full_outer, scd2_close_missing, row_hash, hash_diff_append, closure_updates,
    hash_diff_refresh, replace_by_key, fact_sales, level_at_sale, fact_screenings, screening_refresh, screening_refresh_parts, screening_totals,
    screening_features, activity_counts, customer_segmentation, segment_summary, top_entities,
    top_entities_total, inventory_status, sales_by_dim_name, ml_features, gate_nulls, dq_report, quarantine,
    json_ingest, json_rejects, late_events,
)
