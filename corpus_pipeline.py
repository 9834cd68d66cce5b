"""Corpus pipeline: toxicity filter, line and near de-duplication, decontamination, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrane.llm.stages import STAGES
from terrane.sources import stage

#: Fitted models and sampled segmentations have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
