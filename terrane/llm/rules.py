"""Quality rules by an isolation forest over rule statistics.

Each text gives counts for the base rules and a row of statistics: length of its words, share of symbols, capitals, of
signs that shout, and of words that repeat the one before. (Repeated lines and windows stay with the base rules: one repeated
line alone would make a good text stand apart.) Trees split small random samples of these rows at random statistics and
random values; a row that stands apart is alone after few splits, so its mean path over the trees is short. The score
is 2 ** (-path / usual path), 0 to 1. The threshold on it is calibrated from labelled rows: among all thresholds
that keep at least ``keep`` of the good ones that pass the base rules, the one that parts good from bad best.

The trees learn from a sample of ``trees * sample`` rows at most, chosen by a hash of the text and of the key
after a count, so neither a hot key nor a hot text fills it; labelled rows enter as a histogram of scores.
Statistics and scores cover every row and its whole text.

Edge cases: NULL has no word and the statistics 0, like empty text; both fail the base rules. Without rows to
learn from, or without both good and bad labels, no row is anomalous. A row with several labels counts as good if
one of them is 1; labels other than 0 and 1 are none. Repeated rows give repeated results; a NULL key is no label.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import stage
from .common import map_texts, sample_bound, sample_hash

WINDOW = 8
_SYMBOLS, _LATER, _WHITE = b"#*$%&|<>", bytes(range(0x80, 0xC0)), b" \t\n\x0b\x0c\r"
_CAPITALS, _SHOUTS = bytes(range(65, 91)), b"!?"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("word_length", "symbols", "capitals", "shouts", "echoes")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` (a power of two) that occurs twice or more.

    Windows get ranks by doubling: equal windows of twice the length are equal pairs of ranks, so no hash can mislead.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    size = 1
    while True:
        pairs = rank[:-size] * (len(words) + 1) + rank[size:]
        _, rank, times = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(times) == len(rank):
            return 0
        size *= 2
        if size == window:
            break
    starts = np.flatnonzero(times[rank] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] = 1
    np.subtract.at(edges, starts + window, 1)
    return int(np.count_nonzero(np.cumsum(edges[:-1]) > 0))


def statistics(raw: bytes) -> tuple[list[int], list[float]]:
    """The values of ``COUNTS`` and of ``SHARES``."""
    words = raw.split()  # bytes are split at \x20 and \x09-\x0D, nothing else
    if not words:
        signs = len(raw) - len(raw.translate(None, _SYMBOLS))
        return [0, 0, signs, 0, 0], [0.0] * len(SHARES)
    solid = raw.translate(None, _WHITE)
    chars = len(solid.translate(None, _LATER))
    of = lambda signs: len(solid) - len(solid.translate(None, signs))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    symbols, repeats, doubles = of(_SYMBOLS), repeated_words(words), len(lines) - len(set(lines))
    n = len(words)
    shares = [chars / n, symbols / n, of(_CAPITALS) / chars, of(_SHOUTS) / n, sum(map(eq, words, words[1:])) / n]
    return [n, chars, symbols, doubles, repeats], shares


def usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path of a search that fails in a tree of ``n`` rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): a node's children are ``left`` and ``left + 1``, a leaf is its own child."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    usual: float
    depth: int

    @staticmethod
    def grow(rows: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 7) -> Forest | None:
        """``trees`` trees, each over ``sample`` of ``rows``; None if there are fewer than two rows."""
        rng = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        if sample < 2:
            return None
        depth = int(np.ceil(np.log2(sample)))
        shape = (trees, 2 * sample)
        feature, value = np.zeros(shape, np.int32), np.full(shape, np.inf)
        left, path = np.tile(np.arange(shape[1], dtype=np.int32), (trees, 1)), np.zeros(shape)
        for t in range(trees):
            todo, size = [(0, rows[rng.choice(len(rows), sample, replace=False)], 0)], 1
            while todo:
                node, here, level = todo.pop()
                low, high = here.min(0), here.max(0)
                wide = np.flatnonzero(high > low)
                if level == depth or not len(wide):
                    path[t, node] = level + usual_path(len(here))
                    continue
                k = rng.choice(wide)
                cut = rng.uniform(low[k], high[k])
                below = here[:, k] <= cut
                feature[t, node], value[t, node], left[t, node] = k, cut, size
                todo += [(size, here[below], level + 1), (size + 1, here[~below], level + 1)]
                size += 2
        return Forest(feature, value, left, path, float(usual_path(sample)), depth)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1."""
        tree = np.arange(len(self.feature))[None]
        node = np.zeros((len(rows), len(self.feature)), np.int32)
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            above = rows[at, self.feature[tree, node]] > self.value[tree, node]
            node = self.left[tree, node] + above
        return 2.0 ** (-self.path[tree, node].mean(1) / self.usual)


def threshold(histogram: list[tuple[int, int, int]], bins: int, keep: float) -> float:
    """The least score that counts as anomalous, from (bin, good rows, bad rows); above 1 if nothing tells.

    Among the borders that leave at least ``keep`` of the good rows below, the one with the greatest sum of
    the shares of good rows below and of bad rows above; of equals the middle one.
    """
    good, bad = np.zeros(bins + 1), np.zeros(bins + 1)
    for at, g, b in histogram:
        good[at] += g
        bad[at] += b
    if not good.sum() or not bad.sum():
        return 2.0
    below = np.append(0, np.cumsum(good)) / good.sum()
    above = 1 - np.append(0, np.cumsum(bad)) / bad.sum()
    borders = np.flatnonzero(below >= keep)
    best = borders[(below + above)[borders] >= (below + above)[borders].max() - 1e-12]
    return float(best[len(best) // 2]) / bins


def judge(docs: DataFrame, key: str, text: str, labels: DataFrame, label: str, trees: int = 100, sample: int = 256, keep: float = 0.99, bins: int = 10_000) -> DataFrame:
    """The key, ``COUNTS``, ``base_failed``, ``anomaly`` (0 to 1) and ``kept`` of every row."""
    def start():
        def measured(texts):
            found = [statistics(x or b"") for x in texts]
            return *zip(*[c for c, _ in found], strict=True), [s for _, s in found]

        return measured

    given = docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text"), F.xxhash64(F.col(key), F.col(text)).alias("_hash"))
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    rows = stage(map_texts(given, "_text", ["_key", "_hash"], f"{counts}, shares array<double>", start))
    # Equal rows of statistics say nothing new to a tree, so a group of copies enters once.
    distinct = rows.groupBy("shares").agg(F.min("_hash").alias("_hash"))
    slot = sample_hash(F.col("_hash"), 11)
    total = distinct.count()
    taken = distinct.where(slot < F.lit(sample_bound(trees * sample, total))).select("_hash", "shares").toArrow()
    order = np.argsort(taken["_hash"].to_numpy())
    learnt = taken["shares"].combine_chunks().values.to_numpy().reshape(-1, len(SHARES))[order]
    forest = rows.sparkSession.sparkContext.broadcast(Forest.grow(learnt, trees, sample))  # trees * 2 * sample nodes

    def scorer():
        found = forest.value

        def scored(shares):
            return ([0.0] * len(shares) if found is None else found.score(np.array(shares, np.float64)),)

        return scored

    scored = stage(map_texts(rows, "shares", ["_key", *COUNTS], "anomaly double", scorer, rows=1024))
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_good"))
    place = F.floor(F.col("anomaly") * bins).cast("int")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    known = scored.where(F.col("_key").isNotNull() & ~failed).join(marks, "_key").groupBy(place.alias("at")).agg(F.sum("_good"), F.sum(1 - F.col("_good")))
    cut = threshold([tuple(r) for r in known.collect()], bins, keep)  # bins + 1 rows at most
    return scored.select(
        F.col("_key").alias(key), *COUNTS, failed.alias("base_failed"), "anomaly",
        (~failed & (place < F.lit(round(cut * bins)))).alias("kept"),
    )
