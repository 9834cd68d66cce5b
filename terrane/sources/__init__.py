"""Files, catalog tables and scratch tables."""

from .files import file_source, kafka_source, read_csv, show_sample
from .lake import Lake
from .scratch import clear_staged, replace_in_parts, stage, stage_measured, stage_parts

__all__ = ["Lake", "file_source", "kafka_source", "read_csv", "show_sample", "clear_staged", "replace_in_parts", "stage", "stage_measured", "stage_parts"]
