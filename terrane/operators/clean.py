"""De-duplication, incremental and replacing refreshes, and the cleaned silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean_id, exact_sum, money


def _total_order(df: DataFrame, first: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """``first`` descending, then every other column, so that equal ranks are equal rows."""
    rest = [c for c in df.columns if c not in first and c not in keys]
    return [F.col(c).desc_nulls_last() for c in [*first, *rest]]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the greatest in ``order_cols``; rows with a NULL key are dropped.

    Ties fall to the remaining columns, so a rerun keeps the same row. The ``= 1`` filter becomes a
    group limit on the map side: a task sends at most one row per key, however hot the key is.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_total_order(df, order_cols, keys)))
    return (
        df.dropna(subset=list(keys))
        .withColumn("_rank", rank)
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_by_key(
    df: DataFrame, key: str, ts: str, tie: Sequence[str] = (), ts_as: str | None = None
) -> DataFrame:
    """Latest record per ``key`` by ``ts``; ``ts_as`` renames the time column of the result."""
    latest = dedupe_latest(df, [key], [ts, *tie])
    return latest.withColumnRenamed(ts, ts_as) if ts_as else latest


def new_rows_only(df: DataFrame, target: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``target``; only the key columns of it are read.

    ``small`` is for a batch of known, small size (a staged one) against a large table: the table
    is first cut down to the batch's keys, which the planner broadcasts if their size allows, so
    the table is scanned but not shuffled. The result is the same.
    """
    known = target.select(*keys)
    if small:
        known = known.join(df.select(*keys), on=list(keys), how="left_semi")
    return df.join(known, on=list(keys), how="left_anti").select(*df.columns)


def replace_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` in place of, or added to, rows of equal key."""
    return new_rows_only(target, updates, keys).unionByName(updates.select(*target.columns))


def clean_transactions(
    events: DataFrame, id_col: str, link_key: str, links: DataFrame, link_col: str, ts_as: str
) -> DataFrame:
    """Cleaned sales or bookings: latest event per id, linked title, line total, no NULL keys.

    ``links`` has one row per ``link_key``, so the join cannot multiply rows.
    """
    deduped = dedupe_latest(events.dropna(subset=[id_col, link_key]), [id_col], ["ingestion_ts"])
    return deduped.join(links.select(link_key, link_col), on=link_key, how="left").select(
        id_col,
        F.col("event_ts").alias(ts_as),
        "customer_id",
        link_key,
        "quantity_purchased",
        money(F.col("unit_price_at_sale") * F.col("quantity_purchased")).alias("total_price"),
        F.col(link_col).alias("linked_anime_id"),
    )


def customer_master(
    registrations: DataFrame, id_col: str = "customer_id", order_cols: Sequence[str] = ("registration_id",)
) -> DataFrame:
    """One row per cleaned customer id: the registration that sorts last."""
    return dedupe_latest(registrations.withColumn(id_col, clean_id(id_col)), [id_col], order_cols)


def revenue_summary(
    purchases: DataFrame, group_key: str, qty: str, price: str, id_col: str | None = None
) -> DataFrame:
    """Quantity and revenue per group; with ``id_col`` repeated purchases count once."""
    if id_col:
        purchases = dedupe_latest(purchases, [id_col], ["ingestion_ts"])
    amount = F.col(qty).cast("int") * F.col(price).cast("double")
    return purchases.groupBy(group_key).agg(
        F.sum(F.col(qty).cast("int")).alias("total_quantity_purchased"),
        exact_sum(amount).alias("total_revenue"),
    )
