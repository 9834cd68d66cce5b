"""Type 2 slowly changing dimensions.

Rules common to all forms: a key has at most one current row; a version ends when its successor
starts; closed rows are never changed or lost; NULL equals NULL, so an unchanged row stays
untouched and the same input applied twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import any_changed, row_hash
from .clean import new_rows_only, replace_by_key


@dataclass(frozen=True)
class Scd2Columns:
    """Names of the three validity columns, and the end of an open version (default NULL)."""

    start: str = "effective_start_date"
    end: str = "effective_end_date"
    current: str = "is_current"
    open_end: datetime | str | None = None


def scd2_apply(
    current: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], cols: Scd2Columns = Scd2Columns()
) -> DataFrame:
    """Changes that the latest ``incoming`` row per key makes to a dimension.

    Returns rows of the dimension plus ``scd_action``: ``close`` (a current row, now ended),
    ``add`` (a new current row) or ``late`` (a differing row that does not start after the current
    version; set aside rather than stored as newest). ``incoming`` has ``key``, ``tracked`` and
    the start column. One left join: each joined row unfolds into the none, one or two rows it causes.
    """
    old = current.where(F.col(cols.current)).alias("old")
    new = incoming.select(key, *tracked, cols.start).dropna(subset=[key]).alias("new")
    joined = new.join(old, F.col(f"new.{key}") == F.col(f"old.{key}"), "left")

    known = F.col(f"old.{key}").isNotNull()
    changed = any_changed((F.col(f"new.{c}"), F.col(f"old.{c}")) for c in tracked)
    start, since = F.col(f"new.{cols.start}"), F.col(f"old.{cols.start}")
    # A current version of unknown start began before any known one.
    newer = F.coalesce(start > since, since.isNull() & start.isNotNull())
    types = {c: current.schema[c].dataType for c in (key, *tracked, cols.start, cols.end)}

    def version(side: str, end: Column, is_current: bool, action: str) -> Column:
        kept = [F.col(f"{side}.{c}").cast(types[c]).alias(c) for c in (key, *tracked, cols.start)]
        return F.struct(
            *kept,
            end.cast(types[cols.end]).alias(cols.end),
            F.lit(is_current).alias(cols.current),
            F.lit(action).alias("scd_action"),
        )

    opened = F.lit(cols.open_end)
    close = version("old", F.col(f"new.{cols.start}"), False, "close")
    add = version("new", opened, True, "add")
    late = version("new", opened, False, "late")
    rows = (
        F.when(~known, F.array(add))
        .when(changed & newer, F.array(close, add))
        .when(changed, F.array(late))
    )
    return joined.select(F.inline(rows))


def scd2_merge(
    table: DataFrame, changes: DataFrame, key: str, cols: Scd2Columns = Scd2Columns()
) -> DataFrame:
    """The whole dimension after ``changes``: closed rows take the place of the rows they close."""
    applied = changes.where(F.col("scd_action") != "late").drop("scd_action")
    same = table[key].eqNullSafe(applied[key]) & table[cols.start].eqNullSafe(applied[cols.start])
    return table.join(applied, same, "left_anti").unionByName(applied.select(*table.columns))


def scd2_history(
    loads: DataFrame, key: str, tracked: Sequence[str], cols: Scd2Columns = Scd2Columns()
) -> DataFrame:
    """A whole dimension from all loads of its keys: ``key``, ``tracked`` and the start column.

    Loads are ordered by their start, one of unknown start first; of several with one start the greatest
    in ``tracked`` counts. A load that equals its predecessor opens no version, and a version ends
    when its successor starts, so the intervals of a key are contiguous and exactly the last is current.
    """
    order = Window.partitionBy(key).orderBy(F.col(cols.start).asc_nulls_first())
    at_once = Window.partitionBy(key, cols.start).orderBy(*[F.col(c).desc_nulls_last() for c in tracked])
    single = (
        loads.select(key, *tracked, cols.start).dropna(subset=[key])
        .withColumn("_nth", F.row_number().over(at_once)).where(F.col("_nth") == 1)
    )
    before = F.lag(F.struct(*tracked)).over(order)
    versions = single.withColumn("_same", F.coalesce(F.struct(*tracked).eqNullSafe(before), F.lit(False))).where(~F.col("_same"))
    following = F.lead(F.lit(True)).over(order)
    return versions.select(
        key, *tracked, cols.start,
        F.when(following, F.lead(cols.start).over(order)).otherwise(F.lit(cols.open_end)).alias(cols.end),
        following.isNull().alias(cols.current),
    )


def scd2_snapshot(
    dim_table: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: Column | datetime | str,
    on_missing: str = "keep",
    cols: Scd2Columns = Scd2Columns(),
) -> DataFrame:
    """The whole dimension after a full snapshot ``incoming`` (unique per key, with the start column).

    ``on_missing`` says what happens to a current key that the snapshot lacks: ``keep`` it or
    ``close`` it at ``as_of``. A changed version whose own start is not after its predecessor's
    starts at ``as_of``. History is carried along; the join is planned once.
    """
    if on_missing not in ("keep", "close"):
        raise ValueError("on_missing must be 'keep' or 'close'")
    start_type = dim_table.schema[cols.start].dataType
    now = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast(start_type)
    old = dim_table.where(F.col(cols.current)).alias("old")
    new = incoming.select(key, *tracked, cols.start).dropna(subset=[key]).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    changed = any_changed((F.col(f"new.{c}"), F.col(f"old.{c}")) for c in tracked)
    own_start = F.col(f"new.{cols.start}").cast(start_type)
    since = F.col(f"old.{cols.start}")
    follows = F.coalesce(own_start > since, since.isNull() & own_start.isNotNull())
    next_start = F.when(follows, own_start).otherwise(now)

    def version(side: str, start: Column, end: Column, is_current: bool) -> Column:
        values = {cols.start: start, cols.end: end, cols.current: F.lit(is_current)}
        return F.struct(*[
            values.get(c, F.col(f"{side}.{c}")).cast(dim_table.schema[c].dataType).alias(c)
            for c in dim_table.columns
        ])

    opened = F.lit(cols.open_end)
    old_start, old_end = F.col(f"old.{cols.start}"), F.col(f"old.{cols.end}")
    same = version("old", old_start, old_end, True)
    gone = same if on_missing == "keep" else version("old", old_start, now, False)
    rows = (
        F.when(F.col(f"new.{key}").isNull(), F.array(gone))
        .when(F.col(f"old.{key}").isNull(), F.array(version("new", own_start, opened, True)))
        .when(
            changed,
            F.array(version("old", old_start, next_start, False), version("new", next_start, opened, True)),
        )
        .otherwise(F.array(same))
    )
    history = dim_table.where(~F.coalesce(F.col(cols.current), F.lit(False)))
    return history.unionByName(joined.select(F.inline(rows)))


def with_row_hash(df: DataFrame, hash_cols: Sequence[str], hash_col: str = "record_hash") -> DataFrame:
    """``df`` with a digest of ``hash_cols``; instants are hashed as UTC, whatever the session's zone."""
    utc = {f.name: F.to_utc_timestamp(f.name, F.current_timezone()) for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumn(hash_col, row_hash([utc.get(c, F.col(c)) for c in hash_cols]))


def hash_diff_append(
    target: DataFrame, incoming: DataFrame, key: str, hash_cols: Sequence[str], version_col: str,
    hash_col: str = "record_hash",
) -> DataFrame:
    """Hashed rows of ``incoming`` whose (key, hash, version) ``target`` does not hold yet."""
    hashed = with_row_hash(incoming, hash_cols, hash_col)
    return new_rows_only(hashed, target, [key, hash_col, version_col])


def closure_updates(
    target: DataFrame, incoming: DataFrame, key: str, hash_cols: Sequence[str],
    cols: Scd2Columns = Scd2Columns(), hash_col: str = "record_hash",
) -> DataFrame:
    """Hashed rows that ``target`` holds as open and ``incoming`` holds as closed."""
    hashed = with_row_hash(incoming, hash_cols, hash_col).where(~F.col(cols.current))
    still_open = target.where(F.col(cols.current)).select(key, hash_col, cols.start)
    return hashed.join(still_open, on=[key, hash_col, cols.start], how="left_semi").select(*hashed.columns)


def hash_diff_refresh(
    target: DataFrame, incoming: DataFrame, key: str, hash_cols: Sequence[str],
    cols: Scd2Columns = Scd2Columns(), hash_col: str = "record_hash",
) -> DataFrame:
    """The whole target after new versions were added and closed versions got their end."""
    hashed = with_row_hash(incoming, hash_cols, hash_col)
    return replace_by_key(target, hashed, [key, hash_col, cols.start])
