"""Stages of the corpus pipeline: (name, function of session, documents and table folder).

Each works on all documents that its predecessor kept. All but the last return the columns they got; where
a stage changes a text, ``n_chars`` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, lines, near, pieces, toxicity
from .common import checked_broadcast, fold, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3, unchanged; the labels of ``sf_dir`` teach the classifier."""
    model = toxicity.fit(docs, "text", "doc_id", table(spark, sf_dir, "labels"), "toxic", fold(F.col("doc_id"), 4) != 2)
    kept = docs.withColumnsRenamed({c: f"_{c}" for c in docs.columns if c == "score"})  # a column of that name may be there
    return toxicity.score(kept, "text", model, kept.columns).where(F.col("score") < 0.3).drop("score").toDF(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated three-line windows, short documents and long lines; documents that lose all their lines go."""
    cut = lines.remove_repeats(docs, "doc_id", "text").where(~((F.col("_cut.n_removed") > 0) & (F.col("_cut.n_removed") == F.col("_cut.n_lines"))))
    new = {"text": F.col("_cut.kept"), "n_chars": F.when(F.col("_cut.n_removed") > 0, F.char_length("_cut.kept")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return cut.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least id."""
    return near.keep_one(docs, "doc_id", "text")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of any benchmark item occurs."""
    hit = decontaminate.contaminated(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    doc = F.struct(docs["doc_id"].alias("key"), F.xxhash64(docs["text"]).alias("hash"))
    return docs.join(checked_broadcast(hit, hit.count()), doc == hit["doc"], "left_anti")


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each text, with log-probabilities and inclusion scores."""
    return pieces.encode(docs, "doc_id", "text", pieces.load(VOCABULARY), ["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", sample_pieces),
]
