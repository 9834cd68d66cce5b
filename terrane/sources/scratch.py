"""Intermediate tables in the folder shared by all executors."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root


_staged: list[str] = []


def clear_staged(spark: SparkSession) -> None:
    """Delete what this process has staged; for the end of a job, when nothing is read from it any more."""
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and gives the planner its true size.

    The files lie below ``spark.checkpoint.dir``, so a lost executor costs only its running tasks,
    and later reads take only the columns they need.
    """
    path = f"{scratch_root(df.sparkSession)}/terrane/{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict[str, Any]]:
    """``stage`` that also returns aggregates of the rows, taken while they are written.

    The aggregates are observed in the writing tasks, where a repeated task counts once.
    """
    seen = Observation()
    staged = stage(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]))
    return staged, seen.get


def stage_parts(df: DataFrame, part: str) -> str:
    """Write ``df`` partitioned by a column into a folder of its own; returns its path."""
    path = f"{scratch_root(df.sparkSession)}/terrane/{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.partitionBy(part).parquet(path)
    return path


def replace_in_parts(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """Put ``updates`` in place of the rows of equal ``keys`` in a folder of ``stage_parts``; returns all its rows.

    Only the partitions of the updates are read and written. A row must stay in its partition.
    """
    schema = updates.schema
    there = spark.read.schema(schema).parquet(path)
    updates = stage(updates)
    # As many values as parts that change; a NULL meets the default partition.
    touched = [r[0] for r in updates.select(part).distinct().collect()]
    some = [v for v in touched if v is not None]
    wanted = (F.col(part).isin(*some) if some else F.lit(False)) | (F.col(part).isNull() if None in touched else F.lit(False))
    kept = there.where(wanted).join(updates.select(*keys), on=list(keys), how="left_anti").select(*there.columns)
    changed = stage(kept.unionByName(updates))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
