"""Declared columns of every source and table (fixed values)."""

# Messages of the four event topics, as they arrive: the two clocks are text with a zone offset.
SALE_EVENT = (
    "transaction_id STRING, event_ts STRING, ingestion_ts STRING, customer_id STRING, product_id STRING,"
    " quantity_purchased INT, unit_price_at_sale DOUBLE"
)
DELIVERY_EVENT = (
    "delivery_id STRING, event_ts STRING, ingestion_ts STRING, supplier_id STRING, product_id STRING,"
    " quantity_delivered INT, unit_cost DOUBLE"
)
BOOKING_EVENT = (
    "booking_id STRING, event_ts STRING, ingestion_ts STRING, customer_id STRING, screening_id STRING,"
    " quantity_purchased INT, unit_price_at_sale DOUBLE"
)
CONCESSION_EVENT = (
    "purchase_id STRING, event_ts STRING, ingestion_ts STRING, screening_id STRING, item_id STRING,"
    " item_quantity INT, item_unit_price DOUBLE"
)
EVENT_CLOCKS = ("event_ts", "ingestion_ts")

# CSV files: broadcast times are text that may hold the word NULL.
TITLE_CSV = (
    "broadcast_id INT, anime_id INT, title STRING, season_name STRING, season_number INT, genre STRING,"
    " studio STRING, broadcast_start_ts STRING, broadcast_end_ts STRING, season STRING"
)
CUSTOMER_CSV = "registration_id STRING, customer_id STRING, name STRING, email STRING"
TITLE_CLOCKS = ("broadcast_start_ts", "broadcast_end_ts")


def _typed(event: str) -> str:
    for clock in EVENT_CLOCKS:
        event = event.replace(f"{clock} STRING", f"{clock} TIMESTAMP")
    return event


# When a message landed, by the clock of the cluster that took it up.
LANDED = "landing_ts"
_LANDED = f", {LANDED} TIMESTAMP"
_REJECTED = f"value STRING{_LANDED}"

# Micro-batches taken up and written: a row without a sink when a batch starts, one per sink when it is there.
# Each event table has a ledger of its own, because streams that run side by side must not append to one folder.
_LEDGER = f"stream STRING, batch BIGINT, sink STRING, rows BIGINT{_LANDED}"

TABLES = {
    "bronze.bronze_pos_transaction_events_ledger": _LEDGER,
    "bronze.bronze_supplier_delivery_events_ledger": _LEDGER,
    "bronze.bronze_ticket_booking_events_ledger": _LEDGER,
    "bronze.bronze_concession_purchase_events_ledger": _LEDGER,
    # bronze
    "bronze.bronze_pos_transaction_events": _typed(SALE_EVENT) + _LANDED,
    "bronze.bronze_supplier_delivery_events": _typed(DELIVERY_EVENT) + _LANDED,
    "bronze.bronze_ticket_booking_events": _typed(BOOKING_EVENT) + _LANDED,
    "bronze.bronze_concession_purchase_events": _typed(CONCESSION_EVENT) + _LANDED,
    "bronze.bronze_pos_transaction_events_rejects": _REJECTED,
    "bronze.bronze_supplier_delivery_events_rejects": _REJECTED,
    "bronze.bronze_ticket_booking_events_rejects": _REJECTED,
    "bronze.bronze_concession_purchase_events_rejects": _REJECTED,
    "bronze.bronze_anime_broadcast_schedule": (
        "broadcast_id STRING, ingestion_ts TIMESTAMP, anime_id STRING, title STRING, season_name STRING,"
        " season_number INT, genre STRING, studio STRING, broadcast_end_ts TIMESTAMP,"
        " broadcast_start_ts TIMESTAMP, season STRING"
    ),
    "bronze.bronze_customer_registration_events": CUSTOMER_CSV,
    # silver
    "silver.silver_pos_transactions_clean": (
        "transaction_id STRING, transaction_ts TIMESTAMP, customer_id STRING, product_id STRING,"
        " quantity_purchased INT, total_price DOUBLE, linked_anime_id STRING"
    ),
    "silver.silver_ticket_bookings_clean": (
        "booking_id STRING, booking_ts TIMESTAMP, customer_id STRING, screening_id STRING,"
        " quantity_purchased INT, total_price DOUBLE, linked_anime_id STRING"
    ),
    "silver.silver_product_master_data": (
        "product_id STRING, supplier_id STRING, current_unit_cost DOUBLE, current_unit_price DOUBLE,"
        " last_cost_update TIMESTAMP, last_price_update TIMESTAMP, category STRING, linked_anime_id STRING"
    ),
    "silver.silver_customer_master_data": CUSTOMER_CSV,
    "silver.silver_inventory_movements_clean": (
        "product_id STRING, linked_anime_id STRING, current_quantity BIGINT, last_update_ts TIMESTAMP,"
        " supplier_id STRING"
    ),
    "silver.silver_anime_broadcast_schedule_scd2": (
        "anime_id STRING, title STRING, genre STRING, studio STRING, broadcast_start_ts TIMESTAMP,"
        " broadcast_end_ts TIMESTAMP, season STRING, effective_start_date TIMESTAMP,"
        " effective_end_date TIMESTAMP, is_current_broadcast BOOLEAN"
    ),
    "silver.silver_concession_sales_summary": (
        "screening_id STRING, total_quantity_purchased BIGINT, total_revenue DOUBLE"
    ),
    # gold
    "gold.fact_sales": (
        "sale_id STRING, customer_id STRING, product_id STRING, calendar_date DATE, quantity INT,"
        " revenue DOUBLE, inventory_level_at_sale BIGINT"
    ),
    "gold.fact_screenings": (
        "booking_id STRING, screening_id STRING, anime_id STRING, calendar_date DATE, ticket_revenue DOUBLE,"
        " concession_revenue DOUBLE"
    ),
    "gold.dim_customer": "customer_id STRING, name STRING, segment STRING, email STRING",
    "gold.customer_segments": "segment STRING, customer_count BIGINT, description STRING",
    "gold.dim_product": (
        "product_id STRING, name STRING, category STRING, price DOUBLE, cost DOUBLE, supplier_id STRING,"
        " effective_start_date TIMESTAMP, effective_end_date TIMESTAMP, is_current BOOLEAN"
    ),
    "gold.dim_anime_title_scd2": (
        "anime_id STRING, genre STRING, title STRING, studio STRING, release_date TIMESTAMP, season STRING,"
        " effective_start_date TIMESTAMP, effective_end_date TIMESTAMP, is_current BOOLEAN,"
        " record_hash STRING"
    ),
    "gold.gold_top_anime_performance_tiles": (
        "anime_id STRING, title STRING, total_sales DOUBLE, total_attendance BIGINT"
    ),
    "gold.gold_inventory_summary": (
        "product_id STRING, stock_level BIGINT, last_update DATE, status STRING, ingestion_ts TIMESTAMP"
    ),
    "gold.ML_features_upcoming_titles": (
        "anime_id STRING, title STRING, historical_sales DOUBLE, avg_views DOUBLE, season STRING, genre STRING"
    ),
}

# Id column of the append-only event tables above bronze.
EVENT_IDS = {
    "silver.silver_pos_transactions_clean": "transaction_id",
    "silver.silver_ticket_bookings_clean": "booking_id",
    "gold.fact_sales": "sale_id",
    "gold.fact_screenings": "booking_id",
}

# Partition column of the facts. A refresh replaces the dates it touches, and filters on the date prune the scan.
PARTITIONS = {
    "gold.fact_sales": "calendar_date",
    "gold.fact_screenings": "calendar_date",
}
