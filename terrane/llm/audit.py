"""How the filters of a chain interact: every order of them, from one contingency table per part.

A row's outcome under five filters is one of 32 patterns, whatever the order in which they run. One pass counts
the patterns of each part (all rows, good ones, toxic ones); the counts, as a tensor of 2x2x2x2x2, then answer
every step of every order without another look at the rows: along the axis of each earlier filter ``einsum``
takes the rows that pass, along the step's own axis those that pass or fail, and all along the others.

Filters: A, under 200 words; B, fewer distinct words than half of them; C, capitals A-Z above 2 % of the code
points; D, any of ``#$%&*|``; E, the same text as a row with a smaller key, anywhere in the table.
Rows of equal text fail A to D alike and differ in E only, so a group of copies becomes one row per part before
its parts meet: nothing is joined row by row but the flags.

Edge cases: a NULL text counts as empty; a NULL part is the empty string; a row with a NULL key fails E never,
makes no other row fail it and has no flags; rows of equal key and text have no smaller key and don't fail E for each other; a key
with several labels is good (toxic) if one of them says 1; an empty table gives no row. Columns other than the
named ones don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import stage
from .common import map_texts

FILTERS = "ABCDE"
_CAPITALS, _SIGNS, _LATER = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
_RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(raw: bytes) -> int:
    """Bits 0 to 3: whether a text fails A to D."""
    words = raw.split()  # bytes are split at \x20 and \x09-\x0D, nothing else
    points = len(raw.translate(None, _LATER))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    signs = len(raw) - len(raw.translate(None, _SIGNS))
    return (len(words) < 200) + 2 * (2 * len(set(words)) < len(words)) + 4 * (100 * capitals > 2 * points) + 8 * (signs > 0)


def orders(n: int) -> list[tuple[int, ...]]:
    return list(permutations(range(n)))


def contract(counts: np.ndarray) -> np.ndarray:
    """Every order's every step, from ``counts`` of the shape (measures, 2, ..., 2) with fail = 1.

    The result has one row per order and step, and columns kept, removed, redundant and unique failures of
    the first measure, then the removed of each further measure, then the first's removed of that filter over all orders.
    """
    n = counts.ndim - 1
    steps = [(order, k) for order in orders(n) for k in range(n)]
    passes, fails, every = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
    axes = "abcdefghij"[:n]

    def taken(earlier, own, later) -> np.ndarray:
        chosen = np.empty((n, len(steps), 2), np.int64)
        for at, (order, k) in enumerate(steps):
            for place, axis in enumerate(order):
                chosen[axis, at] = earlier if place < k else own if place == k else later
        return np.einsum(f"m{axes},{','.join('s' + a for a in axes)}->ms", counts, *chosen, optimize="greedy")

    kept, removed = taken(passes, passes, every), taken(passes, fails, every)
    failing, alone = taken(every, fails, every), taken(passes, fails, passes)
    own = np.array([order[k] for order, k in steps])
    total = np.zeros(n, np.int64)
    np.add.at(total, own, removed[0])
    return np.stack([kept[0], removed[0], failing[0] - removed[0], alone[0], *removed[1:], total[own]], 1)


def patterns(docs: DataFrame, key: str, text: str, part: str, labels: DataFrame) -> DataFrame:
    """``part``, ``pattern`` (bit k: fails filter k) and the counts n, good and toxic of it."""
    def start():
        def judged(texts):
            raw = [x or b"" for x in texts]
            return [failures(x) for x in raw], [hashlib.blake2b(x, digest_size=16).digest() for x in raw]

        return judged

    given = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("binary").alias("text"))
    rows = map_texts(given, "text", ["key", "part"], "bits int, digest binary", start)
    rows = stage(rows.groupBy("digest", "part", "bits", "key").agg(F.count("*").alias("times")))
    flags = labels.groupBy(F.col(key).alias("key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    ).where((F.col("good") == 1) | (F.col("toxic") == 1))
    # Rows without a key have no flags; they stay out of the join, where they would all meet in one task.
    zero = F.lit(0)
    flagged = rows.where(F.col("key").isNotNull()).join(flags, "key", "left").unionByName(
        rows.where(F.col("key").isNull()).withColumns({"good": zero, "toxic": zero}))
    flagged = flagged.withColumns({c: F.coalesce(c, zero) * F.col("times") for c in ("good", "toxic")}).withColumn("n", F.col("times"))
    names = ("n", "good", "toxic")
    # A text's rows in one part, and among them those with the least key.
    copies = stage(
        flagged.groupBy("digest", "part", "bits").agg(
            F.min("key").alias("least"), *[F.sum(c).alias(c) for c in names], F.min_by(F.struct(*names), "key").alias("first"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), zero).alias("keyless"),
        )
    )
    least = copies.groupBy("digest").agg(F.min("least").alias("all_least"), F.sum("n").alias("all")).where(F.col("all") > 1).drop("all")
    met = copies.join(least, "digest", "left")

    def passing(c: str) -> Column:
        here = F.when(F.col("least") == F.col("all_least"), F.col(f"first.{c}")).otherwise(zero)
        return F.when(F.col("all_least").isNull(), F.col(c)).otherwise(here + F.col("keyless") if c == "n" else here)

    both = met.select("part", "bits", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), *[passing(c).alias(c) for c in names]),
        F.struct(F.lit(16).alias("copy"), *[(F.col(c) - passing(c)).alias(c) for c in names]),
    )).alias("x"))
    return both.groupBy("part", (F.col("bits") + F.col("x.copy")).alias("pattern")).agg(*[F.sum(f"x.{c}").alias(c) for c in names])


def audit(docs: DataFrame, key: str, text: str, part: str, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; ``labels`` has the key, ``quality`` and ``toxic``."""
    found = patterns(docs, key, text, part, labels)
    # At most 32 patterns a part, so a part's list is short.
    parts = found.groupBy("part").agg(F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("cells"))
    every = orders(len(FILTERS))
    names = np.array(["".join(FILTERS[k] for k in order) for order in every]).repeat(len(FILTERS))
    step = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(every))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, cells in zip(batch["part"], batch["cells"], strict=True):
                counts = np.zeros((3, 32), np.int64)
                for cell in cells:
                    counts[:, cell["pattern"]] = cell["n"], cell["good"], cell["toxic"]
                # Bit 0 of the pattern is filter A, the first axis.
                tensor = counts.reshape(3, *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
                result = pd.DataFrame(contract(tensor), columns=["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])
                yield pd.concat([pd.DataFrame({"part": name, "filter_order": names, "step": step}), result], axis=1)

    return parts.mapInPandas(run, _RESULT)
