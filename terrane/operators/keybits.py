"""Bitmaps of key hashes that prove most new keys new without a look at the table.

A key's hash is a slot; 32,768 slots are one bucket, a bitmap of 4 KB. A clear bit proves that no row with the key was
noted; a set bit may be another key's, so those rows, and no others, are compared with the table's keys. With sixteen
slots a key about six new keys in a hundred meet a set bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage
from .clean import new_rows_only

BUCKET_SLOTS, SLOTS_PER_KEY = 32_768, 16


def slots_for(keys: int) -> int:
    """Slots for as many keys: a power of two, one bucket at least."""
    return max(BUCKET_SLOTS, 1 << (max(1, keys) * SLOTS_PER_KEY - 1).bit_length())


def _slot(keys: Sequence[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots))


def _any_null(keys: Sequence[str]) -> Column:
    first, *rest = [F.col(k).isNull() for k in keys]
    for each in rest:
        first = first | each
    return first


def key_bits(df: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    """``bucket`` and ``bits`` of the keys of ``df``; rows with a NULL key have none.

    Bits are gathered on the map side, so a task sends one row of 4 KB per bucket, however many rows or
    repeats of a key it has.
    """
    placed = df.where(~_any_null(keys)).select(_slot(keys, slots).alias("slot"))
    return placed.groupBy(F.expr(f"slot div {BUCKET_SLOTS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("slot") % BUCKET_SLOTS).alias("bits")
    )


def merged_bits(bits: DataFrame) -> DataFrame:
    """One row per bucket from any number of them."""
    return bits.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set: the lowest bit of byte 0 is the first one."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2.0), position % 8)) % 2 == 1


def mark_possible(df: DataFrame, keys: Sequence[str], bits: DataFrame, slots: int) -> DataFrame:
    """``df`` with ``_possible``: false if its key is proved not to be among the noted ones.

    ``bits`` may hold several rows a bucket, as they were noted. A NULL key equals none, so it is never possible.
    The bitmap is only read by the join's condition and does not travel on with the row.
    """
    one = merged_bits(bits).select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"), F.lit(True).alias("_hit"))
    slot = F.when(~_any_null(keys), _slot(keys, slots))
    placed = df.withColumn("_slot", slot)
    met = (F.expr(f"_slot div {BUCKET_SLOTS}") == F.col("_bucket")) & _is_set(F.col("_bits"), F.col("_slot") % BUCKET_SLOTS)
    return placed.join(one, met, "left").select(*df.columns, F.coalesce("_hit", F.lit(False)).alias("_possible"))


def new_rows_by_bits(df: DataFrame, target: DataFrame, keys: Sequence[str], bits: DataFrame, slots: int) -> DataFrame:
    """``new_rows_only`` by bitmaps: the same rows, as long as ``bits`` note every key of ``target``.

    ``target`` is cut down to the few keys with a set bit, which the planner broadcasts if their size allows,
    so a large table is not shuffled; without a possible key it is not read at all.
    """
    marked = stage(mark_possible(df, keys, bits, slots))
    clear, rest = marked.where(~F.col("_possible")).drop("_possible"), marked.where("_possible").drop("_possible")
    if rest.isEmpty():
        return clear
    return clear.unionByName(new_rows_only(rest, target, keys, small=True))
