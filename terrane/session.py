"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# UTC and ANSI fix the meaning of casts; AQE coalesces small shuffle partitions, turns joins with a
# small measured side into broadcasts and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.orc.filterPushdown": "true",
}


def build_session(app: str = "terrane", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the defaults above; ``conf`` wins. The master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, gets a folder of its own
    when the setting is missing; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="terrane-")
