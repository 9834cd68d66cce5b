"""JSON messages to typed rows. The same expressions serve batch and streaming DataFrames."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import EVENT_CLOCKS


def parse_json_events(messages: DataFrame, schema: str, ts_cols: Sequence[str] = EVENT_CLOCKS) -> DataFrame:
    """The columns of ``schema`` plus the raw text ``value``, one row per message.

    A message that is not JSON gives NULLs, a field of another type gives NULL for that field,
    unknown fields are ignored. ``ts_cols`` are text with a zone offset and become timestamps.
    """
    value = F.col("value").cast("string")
    rows = messages.select(value.alias("value"), F.from_json(value, schema).alias("data"))
    rows = rows.select("data.*", "value")
    return rows.withColumns({c: F.try_to_timestamp(F.col(c)) for c in ts_cols})


def split_events(parsed: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with an id, raw messages without one)."""
    good = parsed.where(F.col(id_col).isNotNull()).drop("value")
    return good, parsed.where(F.col(id_col).isNull()).select("value")


def ingest_json_stream(
    source: DataFrame,
    schema: str,
    id_col: str,
    table: str,
    checkpoint: str,
    ts_cols: Sequence[str] = EVENT_CLOCKS,
    fmt: str = "orc",
    rejects: str | None = None,
    trigger: dict | None = None,
    landed: str | None = None,
) -> list[StreamingQuery]:
    """Append a stream of JSON messages to ``table``; messages without an id go to ``rejects``.

    ``landed`` names a column for the time at which the batch was taken up.

    Progress lives in ``checkpoint``, one folder per stream, so a restart neither repeats nor skips
    messages. The default trigger takes what is there and stops, leaving the cluster to the batch
    jobs; pass ``{"processingTime": "30 seconds"}`` to keep running.
    """
    good, bad = split_events(parse_json_events(source, schema, ts_cols), id_col)
    sinks = [(good, table, checkpoint)]
    if rejects:
        sinks.append((bad, rejects, f"{checkpoint}-rejects"))
    if landed:
        sinks = [(rows.withColumn(landed, F.current_timestamp()), name, place) for rows, name, place in sinks]
    return [
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", place)
        .trigger(**(trigger or {"availableNow": True}))
        .toTable(name)
        for rows, name, place in sinks
    ]


def run_for(queries: Sequence[StreamingQuery], seconds: float) -> None:
    """Let streams run for a time at most, then stop them and raise the error of a failed one.

    A stopped stream goes on from its checkpoint at the next start.
    """
    end = time.monotonic() + seconds
    for query in queries:
        query.awaitTermination(max(1, int(end - time.monotonic())))
    for query in queries:
        query.stop()
        if query.exception():
            raise query.exception()
