"""Language identification by n-gram filters that answer for all languages at once.

Every language has a Bloom filter of its n-grams. The filters share size and hash functions and are
stored bit-sliced: slot ``i`` holds bit ``i`` of every filter, one bit per language, in as many numbers of 64 bits
as the languages need. The conjunction of
the slots of an n-gram is then the mask of all languages that contain it. A text's masks are counted per
language, and the counts are corrected for the false positives that the filter's fill makes expected.

The n-grams are the byte quadruples of the lower-cased text, with everything but letters as one space. A
language's filter takes the n-grams that at least ``min_docs`` of its sampled documents contain and whose
share among its n-grams is at least ``keep`` of the largest share in any language, so quotations from another
language don't count. A language of fewer sampled documents needs its n-grams in all of them; if none is left, it takes all it has.

Edge cases: NULL text and text without a letter give ``und`` with score 0; a text of which no filter
knows anything gives the most frequent language with score 0; ties go to the first name. Without any
labelled row every text is ``und``. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, sample_bound, sample_hash

UNDETERMINED = "und"
_OTHER = re.compile(r"[\W\d_]+")
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263], dtype=np.uint32)


def grams(text: str) -> np.ndarray:
    """Byte quadruples of the letters of a text, as 32-bit numbers; empty if there is no letter."""
    letters = _OTHER.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):  # signs such as ² are no digits here, but no letters either
        return np.empty(0, np.uint32)
    b = np.frombuffer(f" {letters}  ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    return b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24


@dataclass(frozen=True)
class Filters:
    """``slots``: one language mask per slot, a row of numbers of 64 bits or just one; ``hashes`` of them answer for an n-gram."""

    languages: tuple[str, ...]
    slots: np.ndarray
    hashes: int
    default: int

    def places(self, gram: np.ndarray, k: int) -> np.ndarray:
        shift = np.uint32(32 - (len(self.slots).bit_length() - 1))
        return (gram ^ (gram >> np.uint32(15))) * _MULTIPLIERS[k] >> shift

    def masks(self, gram: np.ndarray) -> np.ndarray:
        found = self.slots[self.places(gram, 0)]
        for k in range(1, self.hashes):
            found = found & self.slots[self.places(gram, k)]
        return found

    def false_positives(self) -> np.ndarray:
        """Chance per language that an n-gram outside its filter is reported as contained."""
        planes = self.slots.reshape(len(self.slots), -1)
        fill = [np.count_nonzero(planes[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) / len(planes) for k in range(len(self.languages))]
        return np.array(fill) ** self.hashes

    def decide(self, text: str | None, chance: np.ndarray) -> tuple[str, float]:
        gram = grams(text) if text else np.empty(0, np.uint32)
        if not len(gram) or not self.languages:
            return UNDETERMINED, 0.0
        found, shares = self.masks(gram).reshape(len(gram), -1), []
        for word, column in enumerate(found.T):
            values, counts = np.unique(column, return_counts=True)
            bits = values[:, None] >> np.arange(min(64, len(self.languages) - 64 * word), dtype=np.uint64) & np.uint64(1)
            shares.append(counts @ bits.astype(np.float64) / len(gram))
        share = np.concatenate(shares)
        corrected = np.maximum(0.0, (share - chance) / (1.0 - np.minimum(chance, 0.999)))
        if not corrected.any():
            return self.languages[self.default], 0.0
        best = int(corrected.argmax())
        return self.languages[best], float(corrected[best] / corrected.sum())


def fit(
    docs: DataFrame, text: str, lang: str, key: str, train: Column,
    per_language: int = 2000, min_docs: int = 3, keep: float = 0.1, slot_bits: int = 20, hashes: int = 2,
) -> Filters:
    """Filters from at most about ``per_language`` documents of each language among the ``train`` rows.

    The languages are counted over all rows. The sample is chosen by a hash of the key; its n-grams are
    counted by Spark, so the driver gets one row per language and n-gram that the filters keep.
    """
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang)).count().collect()}
    names = tuple(sorted(sizes))
    if not names:
        return Filters((), np.zeros(1 << slot_bits, np.uint64), hashes, 0)
    # The sample's share and the least number of documents of each language, by a join whatever their number.
    bounds = F.broadcast(docs.sparkSession.createDataFrame(
        [(name, sample_bound(per_language, size), min(min_docs, size)) for name, size in sizes.items()],
        T.StructType([T.StructField("lang", docs.select(lang).schema[0].dataType), T.StructField("_bound", T.LongType()), T.StructField("_least", T.LongType())]),
    ))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("lang"):
                found = [np.unique(grams(x), return_counts=True) for x in part["text"]]
                values = np.concatenate([v for v, _ in found] or [np.empty(0, np.uint32)])
                times = np.concatenate([c for _, c in found] or [np.empty(0, np.int64)])
                unique, place = np.unique(values, return_inverse=True)
                yield pd.DataFrame({
                    "lang": name, "gram": unique.astype(np.int64), "docs": np.bincount(place, minlength=len(unique)),
                    "times": np.bincount(place, weights=times, minlength=len(unique)).astype(np.int64),
                })

    counted = (
        rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), sample_hash(F.col(key), seed=10).alias("_at"))
        .join(bounds, "lang").where(F.col("_at") < F.col("_bound")).select("lang", "text")
        .mapInPandas(count, "lang string, gram long, docs long, times long")
        .groupBy("lang", "gram").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"))
    )
    seen = counted.join(bounds, "lang").where(F.col("docs") >= F.col("_least")).select(counted.columns).toPandas()
    lost = [name for name in names if name not in set(seen["lang"])]
    if lost:  # documents without a common n-gram: take all they have
        lost_ones = F.broadcast(docs.sparkSession.createDataFrame([(name,) for name in lost], counted.select("lang").schema))
        seen = pd.concat([seen, counted.join(lost_ones, "lang").toPandas()], ignore_index=True)
    seen["share"] = seen["times"] / seen.groupby("lang")["times"].transform("sum")
    seen = seen[seen["share"] >= keep * seen.groupby("gram")["share"].transform("max")]
    empty = Filters(names, np.zeros((1 << slot_bits, -(-len(names) // 64)), np.uint64), hashes, names.index(max(sizes, key=lambda n: (sizes[n], n))))
    for k, name in enumerate(names):
        gram = seen.loc[seen["lang"] == name, "gram"].to_numpy().astype(np.uint32)
        for h in range(hashes):
            empty.slots[empty.places(gram, h), k // 64] |= np.uint64(1 << k % 64)
    return empty


def predict(docs: DataFrame, text: str, filters: Filters, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score`` of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(filters)  # 2^slot_bits numbers for every 64 languages

    def start():
        model = shipped.value
        chance = model.false_positives()
        return lambda texts: zip(*[model.decide(x, chance) for x in texts], strict=True)

    return map_texts(docs, text, keep, "lang_pred string, score double", start)
