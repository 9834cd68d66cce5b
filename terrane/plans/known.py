"""A table's key bitmaps, kept beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keybits import BUCKET_SLOTS, SLOTS_PER_KEY, key_bits, merged_bits, new_rows_by_bits, slots_for
from ..sources.lake import Lake

# The row of a note that holds its numbers in place of a bitmap.
_HEAD = -1
_COLUMNS = "bucket BIGINT, bits BINARY, slots BIGINT, known BIGINT"


class KnownKeys:
    """Bitmaps of a table's keys in ``<table>_bits``, extended at every append.

    The bits of a batch are noted before its rows are appended, together with the number of rows the table then has. A failed
    append so leaves bits too many, which cost a comparison, never too few. A number of rows other than the noted one
    (a failed append, rows written by another way) makes the next use build the bitmaps anew from the table; so does growth
    beyond four times the keys they were made for. A change that leaves the number of rows equal but not the keys needs
    ``rebuild``. Notes are appended, a few rows a batch, and merged into one row a bucket after ``MOST_NOTES``.

    One job writes a table at a time, as with all refreshes.
    """

    MOST_NOTES = 32

    def __init__(self, lake: Lake, table: str, keys: Sequence[str]):
        self.lake, self.table, self.keys, self.bits_table = lake, table, list(keys), f"{table}_bits"

    def _note(self, bits: DataFrame, slots: int, known: int) -> DataFrame:
        head = self.lake.spark.createDataFrame([(_HEAD, None, slots, known)], _COLUMNS)
        return head.unionByName(bits.select("bucket", "bits", F.lit(None).cast("bigint").alias("slots"), F.lit(None).cast("bigint").alias("known")))

    def rebuild(self) -> int:
        """Make the bitmaps anew from the table; returns the number of slots."""
        rows = self.lake.load_or_empty(self.table)
        n = rows.count()
        slots = slots_for(n)
        self.lake.publish(self.bits_table, self._note(key_bits(rows, self.keys, slots), slots, n))
        return slots

    def current(self) -> tuple[DataFrame, int]:
        """``bucket`` and ``bits`` that note every key of the table, and the number of slots."""
        n = self.lake.load_or_empty(self.table).count()
        notes, slots, noted = 0, 0, -1
        if self.lake.exists(self.bits_table):
            heads = self.lake.load(self.bits_table).where(F.col("bucket") == _HEAD)
            notes, slots, noted = heads.agg(F.count("*"), F.coalesce(F.max("slots"), F.lit(0)), F.coalesce(F.max("known"), F.lit(-1))).first()
        if noted != n or n * SLOTS_PER_KEY > 4 * max(slots, BUCKET_SLOTS):
            slots = self.rebuild()
        elif notes > self.MOST_NOTES:
            bits = self.lake.load(self.bits_table).where(F.col("bucket") != _HEAD)
            self.lake.publish(self.bits_table, self._note(merged_bits(bits), slots, n))
        return self.lake.load(self.bits_table).where(F.col("bucket") != _HEAD).select("bucket", "bits"), slots

    def new_rows(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose key is not in the table."""
        bits, slots = self.current()
        return new_rows_by_bits(df, self.lake.load_or_empty(self.table), self.keys, bits, slots)

    def append(self, batch: DataFrame) -> None:
        """Append rows to the table, their keys to the bitmaps first; ``batch`` is read three times, so stage it."""
        _, slots = self.current()
        known = self.lake.load_or_empty(self.table).count() + batch.count()
        self.lake.append(self.bits_table, self._note(key_bits(batch, self.keys, slots), slots, known))
        self.lake.append(self.table, batch)
