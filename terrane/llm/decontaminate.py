"""Benchmark decontamination by a positional inverted index of the training tokens.

The index stores postings: one row per occurrence of a term, with the document, the place and the words
around it. A query phrase is looked up from its rarest terms: the lists of its two rarest terms, each moved
back by the term's offset in the phrase, are intersected on document and start, and the words around the
posting then decide exactly. Near matches need the same two terms within a number of words in any order.

Only terms that a query can anchor on are worth a posting, so ``build`` first counts all corpus
occurrences of the query vocabulary, picks each phrase's anchors and stores the postings of those terms.
Everything is built-in expressions. A term list with many rows is split over tasks by its documents.

Words: A-Z are lower-cased, then maximal runs of characters other than ASCII ones that are no digit and no
letter. Edge cases: NULL and empty texts have no words and no hits; an item of fewer words than the window
is one window, one of none is no window; repeated documents get equal results, documents of one key and
different texts are told apart by a hash of the text; an empty table on either side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import stage
from .common import checked_broadcast

WORDS = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    # Only A-Z are lower-cased; where there is nothing but ASCII, that is lower().
    changed = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lower = F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(changed)
    return F.filter(F.split(F.coalesce(lower, F.lit("")), _SEPARATORS), lambda w: w != "")


def windows(items: DataFrame, key: str, text: str, size: int = WORDS) -> DataFrame:
    """Distinct windows of all items: ``phrase`` (the words), ``id`` and ``item_ids`` (as text)."""
    split = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    each = split.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))).alias("at"))
    return (
        each.select("item", F.slice("w", F.col("at"), size).alias("phrase"))
        .groupBy("phrase").agg(F.collect_set("item").alias("item_ids"))
        .withColumn("id", F.sha2(F.array_join("phrase", " "), 256))
    )


def _tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    # A struct, because structs with a NULL inside are equal where bare NULLs are not.
    return docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash")).alias("doc"), words(F.col(text)).alias("_w"))


class PositionalIndex:
    """Postings of the anchor terms of ``phrases``: term, document, place, and ``context``.

    ``context`` holds the ``size - 1`` words before and after the place, which is enough to read any
    phrase through it. ``phrases`` are those of ``windows``.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, phrases: DataFrame, size: int = WORDS):
        self.reach = size - 1
        tokens = _tokens(docs, key, text)
        vocabulary = stage(phrases.select(F.explode("phrase").alias("term")).distinct())
        counts = (
            tokens.select(F.explode("_w").alias("term")).join(checked_broadcast(vocabulary, vocabulary.count()), "term", "left_semi")
            .groupBy("term").agg(F.count("*").alias("times"))
        )
        anchors = stage(self._anchors(phrases, counts))
        self.anchors = checked_broadcast(anchors, anchors.count())
        terms = stage(anchors.select("term").distinct())
        few = terms.count()
        around = F.slice("_w", F.greatest(F.col("at") - self.reach, F.lit(0)) + 1, 2 * self.reach + 1).alias("context")
        # The array of words must not travel with each of its words: the broadcast join filters them in the
        # same pass; without it the places are found first and read in their documents after.
        places = tokens.select("doc", "_w", F.posexplode("_w").alias("at", "term"))
        kept = checked_broadcast(terms, few)
        if kept is terms:
            bare = places.select("doc", "at", "term").join(terms, "term", "left_semi")
            places = bare.join(tokens.dropDuplicates(["doc"]), "doc")
        else:
            places = places.join(kept, "term", "left_semi")
        self.postings = stage(places.select("term", "doc", "at", around))

    @staticmethod
    def _anchors(phrases: DataFrame, counts: DataFrame) -> DataFrame:
        """The two rarest terms of each phrase whose terms all occur; a term counts at its first offset."""
        terms = phrases.select("id", F.posexplode("phrase").alias("offset", "term")).groupBy("id", "term").agg(F.min("offset").alias("offset"))
        rank = Window.partitionBy("id").orderBy("times", "term")
        known = terms.join(counts, "term", "left")
        whole = known.groupBy("id").agg(F.count("times").alias("there"), F.count("*").alias("all")).where(F.col("there") == F.col("all")).select("id")
        return known.join(whole, "id", "left_semi").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= 2).select("id", "term", "offset", "rank")

    def _lists(self, rank: int) -> DataFrame:
        """Postings of the phrases' terms of that rank, moved back to where the phrase would start."""
        found = self.postings.join(self.anchors.where(F.col("rank") == rank), "term")
        return found.withColumn("start", F.col("at") - F.col("offset"))

    def matches(self, phrases: DataFrame) -> DataFrame:
        """Exact occurrences: ``doc``, ``start``, phrase ``id`` and length ``n``."""
        place = ["id", "doc", "start"]
        first = self._lists(1).where(F.col("start") >= 0)
        # A phrase of one repeated word has one list only.
        lone = self.anchors.groupBy("id").agg(F.max("rank").alias("last")).where(F.col("last") == 1).select("id")
        both = first.join(self._lists(2).select(*place), place, "left_semi").unionByName(first.join(lone, "id", "left_semi"))
        before = F.least(F.col("at"), F.lit(self.reach))
        return (
            both.join(checked_broadcast(phrases.select("id", "phrase"), phrases.count()), "id")
            .where(F.slice("context", before - F.col("offset") + 1, F.size("phrase")) == F.col("phrase"))
            .select(*place, F.size("phrase").alias("n")).distinct()
        )

    def near_matches(self, slop: int) -> DataFrame:
        """Documents and phrase ids whose two rarest terms stand at most ``slop`` words apart, in any order.

        The places meet on bands of ``slop + 1`` words, the first term's also on the neighbour bands.
        """
        band = F.floor(F.col("at") / (slop + 1))
        first = self._lists(1).select("id", "doc", "at", F.explode(F.array(band - 1, band, band + 1)).alias("band"))
        second = self._lists(2).select("id", "doc", F.col("at").alias("at2"), band.alias("band"))
        return first.join(second, ["id", "doc", "band"]).where(F.abs(F.col("at") - F.col("at2")) <= slop).select("doc", "id").distinct()


def contaminated(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, size: int = WORDS) -> DataFrame:
    """``doc`` (key, hash of the text) of each document in which a window occurs, staged."""
    phrases = stage(windows(items, item_key, item_text, size))
    return stage(PositionalIndex(docs, key, text, phrases, size).matches(phrases).select("doc").distinct())


def contamination(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, size: int = WORDS) -> DataFrame:
    """One row per document: ``doc`` (key, hash of the text), n_words, n_hit (words inside any match), item_ids."""
    phrases = stage(windows(items, item_key, item_text, size))
    found = stage(PositionalIndex(docs, key, text, phrases, size).matches(phrases))
    hits = found.groupBy("doc").agg(
        F.size(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("start", "n")), lambda m: F.sequence(m.start, m.start + m.n - 1))))).alias("n_hit"),
    )
    named = (
        found.select("doc", "id").distinct().join(phrases.select("id", F.explode("item_ids").alias("item")), "id")
        .groupBy("doc").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    counted = _tokens(docs, key, text).select("doc", F.size("_w").cast("long").alias("n_words"))
    return counted.join(hits.join(named, "doc"), "doc", "left").select(
        "doc", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
