"""Sources to bronze tables."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sources.files import read_csv
from ..sources.lake import Lake
from ..streaming.exact import ingest_once

log = logging.getLogger(__name__)

# Topic, message schema, id column and table of each event stream.
STREAMS = {
    "POS_topic": (schemas.SALE_EVENT, "transaction_id", "bronze.bronze_pos_transaction_events"),
    "bookings_topic": (schemas.BOOKING_EVENT, "booking_id", "bronze.bronze_ticket_booking_events"),
    "supllier_topic": (schemas.DELIVERY_EVENT, "delivery_id", "bronze.bronze_supplier_delivery_events"),
    "concession_topic": (schemas.CONCESSION_EVENT, "purchase_id", "bronze.bronze_concession_purchase_events"),
}


def ingest_topic(
    lake: Lake, topic: str, source: DataFrame, checkpoint: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Start the stream of one topic into its bronze table; ``source`` has the message in ``value``.

    Messages without a readable id go to ``<table>_rejects`` as they came. Every row carries the time at
    which it landed, from this cluster's clock. One query reads the topic for both tables, and a repeated batch adds
    nothing to either.
    """
    schema, id_col, table = STREAMS[topic]
    lake.create(table)
    lake.create(f"{table}_rejects")
    lake.create(f"{table}_ledger")
    return [ingest_once(source, lake, schema, id_col, table, checkpoint, f"{table}_rejects", trigger=trigger)]


def count_rejects(lake: Lake) -> dict[str, int]:
    """Rejected messages per table so far, logged where there are any."""
    found = {}
    for _, _, table in STREAMS.values():
        rejects = lake.load(f"{table}_rejects")
        found[table] = rejects.count() if rejects is not None else 0
        if found[table]:
            log.warning("%s: %d messages without a readable id are set aside", table, found[table])
    return found


def ingest_all(
    lake: Lake, source_of: Callable[[str], DataFrame], checkpoints: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Start all topics; ``source_of`` gives the unbounded rows of a topic."""
    return [
        query
        for topic in STREAMS
        for query in ingest_topic(lake, topic, source_of(topic), f"{checkpoints}/{topic}", trigger)
    ]


def load_titles(lake: Lake, path: str) -> DataFrame:
    """Append the broadcast schedule CSV, stamped with the time of loading; returns its rows."""
    rows = read_csv(lake.spark, path, schemas.TITLE_CSV, schemas.TITLE_CLOCKS, "ingestion_ts")
    ids = {c: F.col(c).cast("string") for c in ("broadcast_id", "anime_id")}
    rows = rows.withColumns(ids)
    lake.append("bronze.bronze_anime_broadcast_schedule", rows)
    return rows


def load_customers(lake: Lake, path: str) -> DataFrame:
    """Append the customer registration CSV; returns its rows."""
    rows = read_csv(lake.spark, path, schemas.CUSTOMER_CSV)
    lake.append("bronze.bronze_customer_registration_events", rows)
    return rows
