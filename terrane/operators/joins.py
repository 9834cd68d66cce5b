"""Joins of a large, possibly skewed side with a side that is unique per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_left_join(
    facts: DataFrame, dim: DataFrame, on: Sequence[str], spread_by: Sequence[str], salts: int
) -> DataFrame:
    """``facts`` left-joined to ``dim``, every key spread over ``salts`` partitions.

    The salt comes from a hash of ``spread_by`` (columns that vary within a hot key), so a retried
    task sends each row to the same place. ``dim`` is repeated ``salts`` times. Use it when one key
    holds so many facts that a single reduce task cannot take them and the plan does not allow
    the adaptive skew split; ``salts=1`` is the plain join.
    """
    if salts <= 1:
        return facts.join(dim, on=list(on), how="left")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, on=[*on, "_salt"], how="left").drop("_salt")
