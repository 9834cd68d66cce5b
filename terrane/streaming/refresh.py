"""Batch operators run on every micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import new_rows_only
from ..sources.lake import Lake


def refresh_stream(
    events: DataFrame,
    lake: Lake,
    table: str,
    keys: Sequence[str],
    transform: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append ``transform(micro-batch)`` to ``table``, new keys only.

    A micro-batch that is repeated after a failure finds its rows in the table and adds nothing.
    """
    def write(batch: DataFrame, _: int) -> None:
        here = lake.on(batch.sparkSession)
        here.append(table, new_rows_only(transform(batch), here.load_or_empty(table), keys))

    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )
