"""Line de-duplication by overlapping windows of three lines.

Every three consecutive lines of a document make a window. Unless ``three_only`` is set, so do all lines of a
document of one or two, and each line of ``LONG`` words or more. A window that occurs anywhere else too keeps
its first occurrence, by document key and then place; the lines under its later occurrences go. Windows
that overlap cover more than three lines together, and a line goes if any later occurrence covers it.
Lines are compared without blanks, tabs and carriage returns at their ends. Blank lines are no lines of
a window; they stay where they are, unless every other line of the document went.

Everything is built-in expressions. Only hashes of windows are counted and joined, never lines.

Edge cases: NULL text stays NULL; with ``three_only`` a document of fewer than three lines has no window and
stays as it is; without, it goes if another one of the same lines came before; rows of equal key and text are one document and get the same result; rows of equal key and different text are
documents in the order of a hash of their text; NULL keys come first. All columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import stage

WINDOW, LONG = 3, 50


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def windows(text: Column, three_only: bool = False) -> Column:
    """(place, number of lines, two hashes) of every window of a text; places count its lines that aren't blank."""

    def window(kept: Column, at: Column, n: int) -> Column:
        found = [F.get(kept, at + k) for k in range(n)]
        return F.struct(at.alias("at"), F.lit(n).alias("n"), F.xxhash64(*found).alias("h1"), F.xxhash64(F.lit(9), *found).alias("h2"))

    def hashed(kept: Column) -> Column:
        last = F.size(kept) - WINDOW
        threes = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: window(kept, i, WINDOW)))
        if three_only:
            return threes
        short = [F.when(F.size(kept) == n, F.array(window(kept, F.lit(0), n))) for n in range(1, WINDOW)]
        # A line of so many words has as many signs and blanks between at least.
        wordy = lambda x: (F.char_length(x) >= 2 * LONG - 1) & (F.size(F.split(x, r"\s+")) >= LONG)
        places = F.filter(F.transform(kept, lambda x, i: F.when(wordy(x), i)), lambda i: i.isNotNull())
        long = F.when(F.size(kept) > 1, F.transform(places, lambda i: window(kept, i, 1)))
        none = F.array().cast("array<struct<at:int,n:int,h1:bigint,h2:bigint>>")
        return F.concat(*[F.coalesce(x, none) for x in (threes, *short, long)])

    return _let(F.filter(F.transform(_lines(text), _trimmed), lambda x: x != ""), hashed)


def _without(text: Column, covered: Column) -> Column:
    """(n_lines, n_removed, kept) of a text whose ``covered`` windows (place, number of lines) go."""

    def cut(x: Column) -> Column:
        gone = F.array_distinct(F.flatten(F.transform(x.covered, lambda p: F.slice(x.full, p["at"] + 1, p["n"]))))
        stay = F.array_except(F.sequence(F.lit(0), F.size(x.lines) - 1), gone)
        return _let(F.struct(x.lines.alias("lines"), x.full.alias("full"), gone.alias("gone"), stay.alias("stay")), lambda y: F.struct(
            F.size(y.full).cast("long").alias("n_lines"), F.size(y.gone).cast("long").alias("n_removed"),
            F.when(F.size(y.gone) == F.size(y.full), F.lit("")).otherwise(F.array_join(F.transform(y.stay, lambda i: F.get(y.lines, i)), "\n")).alias("kept"),
        ))

    full = lambda lines: F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: _trimmed(F.get(lines, i)) != "")
    counted = _let(_lines(text), lambda x: F.struct(F.size(full(x)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), text.alias("kept")))
    return (
        F.when(text.isNull(), F.struct(F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), text.alias("kept")))
        .when(covered.isNull(), counted)
        .otherwise(_let(_lines(text), lambda x: _let(F.struct(x.alias("lines"), full(x).alias("full"), covered.alias("covered")), cut)))
    )


def remove_repeats(docs: DataFrame, key: str, text: str, hot: int = 2000, three_only: bool = False) -> DataFrame:
    """``docs`` and a struct ``_cut``: n_lines and n_removed (blank lines aside), and the kept text.

    A window that makes up more than one in ``hot`` of all occurrences meets them by a broadcast join: there
    are fewer than ``hot`` such windows. The others meet in a shuffled join, each with less than that share.
    """
    identity = [F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_hash")]
    each = stage(docs.where(F.col(text).isNotNull()).select(*identity, F.explode(windows(F.col(text), three_only)).alias("_x")).select("_key", "_hash", "_x.*"))
    firsts = stage(
        each.groupBy("n", "h1", "h2").agg(F.count("*").alias("times"), F.min(F.struct("_key", "_hash", "at")).alias("first"))
        .where(F.col("times") > 1)
    )
    total = each.count()
    often = F.broadcast(firsts.where(F.col("times") * hot > total))
    rare = firsts.where(F.col("times") * hot <= total)
    same = ["n", "h1", "h2"]
    met = each.join(often, same).unionByName(each.join(often, same, "left_anti").join(rare, same))
    covered = (
        met.where(~F.struct("_key", "_hash", "at").eqNullSafe(F.col("first")))
        .groupBy("_key", "_hash").agg(F.collect_set(F.struct("at", "n")).alias("_covered"))
    )
    own = docs[key].eqNullSafe(covered["_key"]) & (F.xxhash64(docs[text]) == covered["_hash"])
    return docs.join(covered, own, "left").select(*[docs[c] for c in docs.columns], _without(docs[text], covered["_covered"]).alias("_cut"))
