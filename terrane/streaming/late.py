"""Late and repeated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.running import running_by_chunk

# Fixed value: the greatest delay between event and arrival that the sources are built for.
MAX_DELAY_SECONDS = 300


def late_events(
    events: DataFrame,
    source: str,
    id_col: str,
    event_ts: str = "event_ts",
    ingestion_ts: str = "ingestion_ts",
    delay_seconds: int = MAX_DELAY_SECONDS,
    chunk: str = "hour",
) -> DataFrame:
    """Batch view of the watermark: every event with its source's ``high_water`` mark and ``is_late``.

    The mark is the greatest event time among events of the source that arrived earlier (equal
    arrivals rank by event time, then id); an event is late when it lies more than the delay behind
    it. A stream moves its mark only between micro-batches, so it drops a subset of these.
    """
    order = [F.col(ingestion_ts).asc(), F.col(event_ts).asc(), F.col(id_col).asc()]
    marked = running_by_chunk(
        events, [source], ingestion_ts, order, event_ts, "high_water", "max",
        include_current=False, chunk=chunk,
    )
    limit = F.col("high_water") - F.make_dt_interval(secs=F.lit(delay_seconds))
    return marked.withColumn("is_late", F.coalesce(F.col(event_ts) < limit, F.lit(False)))


def dedupe_stream(
    events: DataFrame, id_col: str, event_ts: str = "event_ts", delay: str = f"{MAX_DELAY_SECONDS} seconds"
) -> DataFrame:
    """One row per id within the delay; state older than the watermark is dropped.

    Repeats that come later than the delay are removed at the table by ``new_rows_only``.
    """
    return events.withWatermark(event_ts, delay).dropDuplicatesWithinWatermark([id_col])
