"""One read of a stream into two tables, each message once in one of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import EVENT_CLOCKS, LANDED
from ..sources.lake import Lake
from ..sources.scratch import stage_measured
from .ingest import parse_json_events


def _started(lake: Lake, ledger: str, stream: str, batch: int) -> tuple[datetime | None, set[str]]:
    """When this batch was first taken up, and the sinks that have all of it."""
    found = lake.load_or_empty(ledger).where((F.col("stream") == stream) & (F.col("batch") == batch)).select("sink", LANDED).collect()
    return min((r[1] for r in found if r[0] is None), default=None), {r[0] for r in found if r[0] is not None}


def _note(lake: Lake, ledger: str, stream: str, batch: int, sink: str | None, rows: int, landed: datetime) -> None:
    lake.append(ledger, lake.spark.createDataFrame([(stream, batch, sink, rows, landed)], lake.tables[ledger]))


def ingest_once(
    source: DataFrame,
    lake: Lake,
    schema: str,
    id_col: str,
    table: str,
    checkpoint: str,
    rejects: str,
    ts_cols: Sequence[str] = EVENT_CLOCKS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream of JSON messages to ``table``, those without an id to ``rejects``; one query feeds both.

    A micro-batch is read and parsed once and staged. The table's ledger notes when it starts, which is the landing time of
    all its rows, and each sink when it is written. A batch that Spark repeats after a failure keeps its
    landing time, passes over the sinks that have it, and adds to an unfinished sink only what a failed
    write has not left there, row by row, repeats counted: rows of that landing time are all of this batch, because a
    later one starts later. So either table has every message once, wherever a run was cut off.
    """
    ledger = f"{table}_ledger"

    def write(batch: DataFrame, number: int) -> None:
        here = lake.on(batch.sparkSession)
        landed, done = _started(here, ledger, checkpoint, number)
        again = landed is not None
        if not again:
            # Whole milliseconds: equality on finer ones is not found again behind ORC's statistics.
            landed = batch.sparkSession.sql("SELECT date_trunc('MILLISECOND', current_timestamp())").first()[0]
            _note(here, ledger, checkpoint, number, None, 0, landed)
        good = F.col(id_col).isNotNull()
        parsed, seen = stage_measured(parse_json_events(batch, schema, ts_cols), {
            "good": F.count_if(good), "bad": F.count_if(~good),
        })
        parsed = parsed.withColumn(LANDED, F.lit(landed))
        for sink, rows, n in (
            (table, parsed.where(good).drop("value"), seen["good"]),
            (rejects, parsed.where(~good).select("value", LANDED), seen["bad"]),
        ):
            if sink in done:
                continue
            if again and n:
                there = here.load_or_empty(sink)
                rows = rows.select(*there.columns).exceptAll(there.where(F.col(LANDED) == F.lit(landed)))
            if n:
                here.append(sink, rows)
            _note(here, ledger, checkpoint, number, sink, n, landed)

    return (
        source.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )
