"""Licence scan by canonical digests.

A text is made canonical: lower case, no claims of copyright, no punctuation, one spelling of words that are
written in several ways, single spaces. Its sha-256 digest is looked up among the
digests of known licences by a hash join. Both the whole text of a document and each of its lines are
looked up, so a licence that is a document and a notice that is a line of one are both found.

A claim is a copyright sign with a year, a placeholder or another sign behind it, wherever it stands; among
the first ``HEAD`` words it is also a sign with a name, but never "copyright holder", "notice" or "owner" and their
like. It ends where its sentence, its line or "all rights reserved" does, or before words that open a licence. A
line goes on in the next one if it has no name yet or ends in a comma, "and" or "by", in an open bracket, or if an address
follows, or an opening in the same paragraph within ``NEAR`` letters. So the wrap of a text makes
no difference, except where a name is followed by other words that neither a line, a full stop nor an opening parts from it.

Edge cases: NULL and empty texts, and those of claims only, have no digest and match nothing; a
known text without words is ignored; two known texts with one canonical form are both reported; repeated
rows give repeated results, rows of one key and different texts are told apart.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked_broadcast, map_texts
from .licence_texts import KNOWN, OPENINGS, SPELLINGS

HEAD, NEAR = 8, 200

_SIGN = r"(?:copyright\b|\(c\)|©|&copy;)"
_CLAIM = re.compile(
    rf"(?:\bcopyright\b|\(c\)|©|&copy;)(?P<more>(?:[\s:,]*{_SIGN})*)[\s:,]*(?:by\s+)?"
    r"(?P<year>[<\[{(]?(?:(?:19|20)\d\d\b|yyyy|year\b))?(?P<name>(?!(?:holder|owner|notice|law|licen[cs]e|statement|interest|"
    r"disclaimer|permission|protection|information|infringement|act|treat)(?:s|es|y|ies|d|e|ee)?\b|(?:and|or|in|to|of|is|are|for|on|the|this|that|as)\b)\w)?"
)
_RESERVED = re.compile(r"\ball\s+rights\s+reserved\b\.?")
_PARAGRAPH = re.compile(r"\n\s*\n")
_STOP = re.compile(
    r"\n|\b(?:" + "|".join(x.replace(" ", r"\s+") for x in OPENINGS) + r")\b"
    r"|(?:(?<=[^\W\d_]{4})|(?<=\d{4}))(?<!\bcorp)(?<!\bdept)(?<!\buniv)(?<!\bbros)\.(?=\s|\Z)"
)
_OPEN = re.compile(r"(?:[,&]|\b(?:and|by)|\[[^\]]*|<[^>]*)\s*\Z")
_ADDRESS = re.compile(r"[ \t]*\d+[ \t]+\w+[ \t]+(?:street|st|place|avenue|road)\b")
_LETTER = re.compile(r"[^\W\d_]")
_NEXT_CLAIM = re.compile(rf"[ \t*#/;-]*{_SIGN}")
_GAPS = re.compile(r"[\W_]+")


def _claimed(text: str) -> bool:
    return any(x in text for x in ("copyright", "(c)", "©", "&copy;", "reserved"))


def _end(text: str, begin: int) -> int:
    """Where the claim ends whose years or names begin at ``begin``."""
    at, paragraph = begin, _PARAGRAPH.search(text, begin, begin + NEAR)
    for stop in _STOP.finditer(text, begin, paragraph.start() if paragraph else begin + NEAR):
        if stop[0] == ".":
            break
        if stop[0] != "\n":
            return stop.start()
    while stop := _STOP.search(text, at):
        if stop[0] != "\n":
            return stop.end() if stop[0] == "." else stop.start()
        said, line_end = text[begin : stop.start()], text.find("\n", stop.end())
        line = text[stop.end() : line_end if line_end >= 0 else len(text)]
        if (_LETTER.search(said) and not _OPEN.search(said) and not _ADDRESS.match(line)) or not line.strip() or _NEXT_CLAIM.match(line):
            return stop.start()
        at = stop.end()
    return len(text)


def unclaimed(text: str) -> str:
    """A lower-cased text without its claims of copyright."""
    if not _claimed(text):
        return text
    text = _RESERVED.sub("\n\n", text)
    kept, words, at, seek = [], 0, 0, 0
    while found := _CLAIM.search(text, seek):
        if words <= HEAD:
            words = len(_GAPS.sub(" ", " ".join([*kept, text[at : found.start()]])).split())
        sure = found["more"] or found["year"] or found[0][0] in "©&"
        # (c) may also be the third item of a list.
        named = found["name"] and words <= HEAD and not (found[0][0] == "(" and "(b)" in text[: found.start()])
        if sure or named:
            kept.append(text[at : found.start()])
            at = seek = _end(text, found.start("year") if found["year"] else found.start("name") if found["name"] else found.end())
        else:
            seek = found.end()
    return " ".join([*kept, text[at:]])


def canonical(text: str) -> str:
    """Canonical form of a lower-cased text."""
    return " ".join([SPELLINGS.get(w, w) for w in _GAPS.sub(" ", unclaimed(text)).split()])


def _digest(text: str) -> str | None:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest() if text else None


def digests(text: str | None) -> tuple[str | None, list[str]]:
    """Digest of the whole text, and of each line that has one."""
    lower = (text or "").lower()
    return _digest(canonical(lower)), sorted({d for x in lower.split("\n") if (d := _digest(canonical(x)))})


def known(spark: SparkSession) -> DataFrame:
    """The bundled licences, notices and SPDX lines: licence, text."""
    return spark.createDataFrame(KNOWN, "licence string, text string")


def scan(docs: DataFrame, key: str, text: str, licences: DataFrame) -> DataFrame:
    """Per document: key, whole (licences that its text is) and notices (those that a line of it is), sorted.

    ``licences`` has the columns licence and text; its digests are broadcast only if they are few.
    """
    hashed = lambda: lambda found: zip(*[digests(x) for x in found], strict=True)
    table = map_texts(licences, "text", ["licence"], "digest string, _lines array<string>", hashed).where(F.col("digest").isNotNull()).select("licence", "digest").distinct()
    own = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash")).alias("doc"), F.col(text))
    each = map_texts(own, text, ["doc"], "whole string, lines array<string>", hashed)
    looked = each.select("doc", F.explode(F.concat(
        F.transform(F.filter(F.array("whole"), lambda d: d.isNotNull()), lambda d: F.struct(d.alias("digest"), F.lit(True).alias("all"))),
        F.transform("lines", lambda d: F.struct(d.alias("digest"), F.lit(False).alias("all"))),
    )).alias("x")).select("doc", "x.*")
    met = looked.join(checked_broadcast(table, table.count()), "digest")
    of = lambda all_: F.array_sort(F.collect_set(F.when(F.col("all") == all_, F.col("licence"))))
    found = met.groupBy("doc").agg(of(True).alias("whole"), of(False).alias("notices"))
    none = F.array().cast("array<string>")
    return own.select("doc").join(found, "doc", "left").select(
        F.col("doc.key").alias(key), F.coalesce("whole", none).alias("whole"), F.coalesce("notices", none).alias("notices"),
    )
