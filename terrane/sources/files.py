"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(
    spark: SparkSession, path: str, schema: str, ts_cols: Sequence[str] = (), ingestion_col: str | None = None
) -> DataFrame:
    """CSV with header and declared schema; cells that do not fit become NULL.

    ``ts_cols`` are declared as text and turned into timestamps here, NULL when unreadable.
    ``ingestion_col`` adds the time of loading.
    """
    df = spark.read.option("header", True).schema(schema).csv(path)
    for name in ts_cols:
        df = df.withColumn(name, F.try_to_timestamp(F.col(name)))
    return df.withColumn(ingestion_col, F.current_timestamp()) if ingestion_col else df


def kafka_source(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Unbounded rows of a Kafka topic, message in ``value``; needs the Kafka connector jar.

    A stream without a checkpoint starts at the oldest message that the topic still holds, and one whose next
    messages are gone fails; ``options`` may say otherwise.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", "earliest")
    return reader.options(**(options or {})).load().select(F.col("value").cast("string").alias("value"))


def file_source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Unbounded rows of the text files in a folder, one message per line in ``value``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def show_sample(df: DataFrame, n: int = 5) -> None:
    """Print the schema and the first rows found, to look at a load."""
    df.printSchema()
    df.show(n, truncate=False)
