"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, audit, decontaminate, fingerprint, html, language, licences, lines, near, pieces, quality, rules, toxicity
from .common import fold, table
from .stages import VOCABULARY

VOCABULARIES = alignment.Vocabularies("/opt/tokenizers/byte_bpe_50k.json", VOCABULARY)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"), "html", ["page_id", "url"]).withColumn("n_chars", F.char_length("text").cast("long"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = fold(F.col("doc_id"), 4)
    model = toxicity.fit(docs, "text", "doc_id", labels, "toxic", remainder != 2)
    return toxicity.score(docs, "text", model, ["doc_id"]).select(
        "doc_id", (remainder == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = fold(F.col("doc_id"), 5)
    net = quality.fit(docs, "text", "doc_id", labels, "quality", remainder != 0)
    return quality.score(docs, "text", net, ["doc_id"]).select(
        "doc_id", (remainder == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.encode(docs, "doc_id", "text", pieces.load(VOCABULARY), ["doc_id"])


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, "doc_id", "text", licences.known(spark)).select(
        "doc_id", F.array_join("whole", ",").alias("whole"), F.array_join("notices", ",").alias("notices"),
    )


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprint.fingerprints_with_edits(docs, "doc_id", "text").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, "doc_id", "text", items, "item_id", "text").select(
        F.col("doc.key").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.classes(docs, "doc_id", "text").select("doc_id", "class_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Its SQL knows windows of three lines only; the pipeline also takes short documents and long lines.
    return lines.remove_repeats(docs, "doc_id", "text", three_only=True).select("doc_id", "_cut.n_lines", "_cut.n_removed", F.col("_cut.kept").alias("text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), 3)
    filters = language.fit(docs, "text", "lang", "doc_id", remainder != 1)
    return language.predict(docs, "text", filters, ["doc_id"]).select(
        "doc_id", (remainder == 1).alias("held_out"), "lang_pred", "score",
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), "doc_id", "text", "source", table(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), "doc_id", "text", VOCABULARIES)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "labels"), "quality")


QUERIES = (
    op1_main_text, op2_toxicity, op3_quality, op4_sentencepiece, op5_licences, op6_fingerprint, op7_decontaminate, op8_near_dedup,
    op9_line_dedup, op10_language, op11_filter_audit, op12_token_alignment, op13_quality_rules,
)
