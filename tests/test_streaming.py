import json

from pyspark.sql import functions as F

from terrane import schemas
from terrane import operators as ops
from terrane.plans import bronze
from terrane.sources import file_source
from terrane.streaming import (
    dedupe_stream, ingest_json_stream, late_events, parse_json_events, refresh_stream, split_events,
)

from .helpers import rows, ts


def message(n, at="2024-01-01T10:00:00+00:00", **more):
    event = {
        "transaction_id": None if n is None else str(n), "event_ts": at, "ingestion_ts": at, "customer_id": "c", "product_id": "p_x_1",
        "quantity_purchased": 1, "unit_price_at_sale": 2.5,
    }
    return json.dumps({**event, **more})


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(queries):
    for query in queries if isinstance(queries, list) else [queries]:
        assert query.awaitTermination(120)
        assert query.exception() is None


def test_parsing(frame):
    messages = frame(
        "value string", (message(1, "2024-01-01T12:00:00+02:00"),), ("not json",),
        (message(2, quantity_purchased="many", colour="red"),), (message(None),), (message(3, "soon"),),
    )
    good, bad = split_events(parse_json_events(messages, schemas.SALE_EVENT), "transaction_id")
    assert rows(good, "transaction_id", "event_ts", "quantity_purchased") == [
        ("1", ts("2024-01-01 10:00:00"), 1), ("2", ts("2024-01-01 10:00:00"), None), ("3", None, 1),
    ]
    assert rows(bad) == [("not json",), (message(None),)]


def test_binary_messages(spark, frame):
    messages = frame("value string", (message(1),)).select(F.col("value").cast("binary").alias("value"))
    assert parse_json_events(messages, schemas.SALE_EVENT).first().transaction_id == "1"


def test_stream_equals_batch_and_restarts_without_repeats(spark, lake, tmp_path):
    landing, table = tmp_path / "in", "bronze.bronze_pos_transaction_events"
    lines = [message(n, f"2024-01-01T10:{n:02d}:00+00:00") for n in range(30)] + ["broken"]
    for part in range(3):
        put(landing, f"{part}.json", *lines[part::3])

    def ingest():
        run(bronze.ingest_topic(lake, "POS_topic", file_source(spark, str(landing), 1), str(tmp_path / "ck")))

    ingest()
    batch, _ = split_events(parse_json_events(spark.read.text(str(landing)), schemas.SALE_EVENT), "transaction_id")
    assert rows(lake.load(table), *batch.columns) == rows(batch)
    assert lake.load(table).where(F.col(schemas.LANDED).isNull()).isEmpty()
    ingest()
    assert lake.load(table).count() == 30
    put(landing, "4.json", message(99))
    ingest()
    assert lake.load(table).count() == 31


def test_rejects_go_to_their_own_table(spark, lake, tmp_path):
    put(tmp_path / "in", "0.json", message(1), "broken", message(None))
    lake.create("bronze.bronze_pos_transaction_events")
    run(ingest_json_stream(
        file_source(spark, str(tmp_path / "in")), schemas.SALE_EVENT, "transaction_id",
        "bronze.bronze_pos_transaction_events", str(tmp_path / "ck"), rejects="bronze.rejects",
    ))
    assert lake.load("bronze.bronze_pos_transaction_events").count() == 1
    assert rows(spark.table("bronze.rejects")) == [("broken",), (message(None),)]


def arrivals(frame):
    return frame(
        "src string, id string, event_ts timestamp, ingestion_ts timestamp",
        ("a", "1", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00")),
        ("a", "2", ts("2024-01-01 10:20:00"), ts("2024-01-01 11:01:00")),
        ("a", "3", ts("2024-01-01 10:16:00"), ts("2024-01-01 12:02:00")),
        ("a", "4", ts("2024-01-01 10:14:59"), ts("2024-01-01 12:03:00")),
        ("b", "5", ts("2024-01-01 09:00:00"), ts("2024-01-01 12:03:00")),
    )


def test_late_events(frame):
    for chunk in ("minute", "hour", "day"):
        got = late_events(arrivals(frame), "src", "id", chunk=chunk)
        assert rows(got, "id", "is_late") == [("1", False), ("2", False), ("3", False), ("4", True), ("5", False)]
    marks = dict(rows(got, "id", "high_water"))
    assert marks["1"] is None and marks["5"] is None and marks["4"] == ts("2024-01-01 10:20:00")


def test_stream_deduplication_and_table_deduplication(spark, lake, tmp_path):
    """Repeats within the delay go in the stream, later ones at the table; late drops are late in batch."""
    landing, table = tmp_path / "in", "silver.silver_pos_transactions_clean"
    put(landing, "0.json", message(1), message(1, "2024-01-01T10:02:00+00:00"), message(2, "2024-01-01T10:01:00+00:00"))
    put(landing, "1.json", message(3, "2024-01-01T10:30:00+00:00"), message(2, "2024-01-01T10:01:00+00:00"))
    put(landing, "2.json", message(1, "2024-01-01T10:40:00+00:00"), message(4, "2024-01-01T10:39:00+00:00"))
    links = spark.createDataFrame([], "product_id string, anime_id string")

    def clean(batch):
        return ops.clean_transactions(batch, "transaction_id", "product_id", links, "anime_id", "transaction_ts")

    def refresh():
        parsed = parse_json_events(file_source(spark, str(landing), 1), schemas.SALE_EVENT).drop("value")
        run(refresh_stream(
            dedupe_stream(parsed, "transaction_id"), lake, table, ["transaction_id"], clean, str(tmp_path / "ck")
        ))

    refresh()
    assert rows(lake.load(table), "transaction_id") == [("1",), ("2",), ("3",), ("4",)]
    refresh()
    assert lake.load(table).count() == 4
