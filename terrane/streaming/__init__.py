"""Structured Streaming ingest and stateful de-duplication."""

from .exact import ingest_once
from .ingest import ingest_json_stream, parse_json_events, run_for, split_events
from .late import dedupe_stream, late_events
from .refresh import refresh_stream

__all__ = [
    "dedupe_stream", "ingest_json_stream", "ingest_once", "late_events", "parse_json_events", "refresh_stream",
    "run_for", "split_events",
]
