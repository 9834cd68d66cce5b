"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_SLOTS = 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a NULL key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def sample_hash(key: Column, seed: int) -> Column:
    """A number of a key; the keys whose number lies below ``sample_bound`` are a sample."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_SLOTS))


def sample_bound(wanted: int, of: int) -> int:
    return int((1.0 if of <= wanted else wanted / of) * _SLOTS)


def sampled(key: Column, wanted: int, of: int, seed: int) -> Column:
    """About ``wanted`` of ``of`` rows, chosen by a hash of their key, whatever their place."""
    return sample_hash(key, seed) < F.lit(sample_bound(wanted, of))


def checked_broadcast(df: DataFrame, rows: int, most: int = 500_000) -> DataFrame:
    """``df`` marked for a broadcast if its counted ``rows`` are few; else left to a shuffled join."""
    return F.broadcast(df) if rows <= most else df


def map_texts(
    docs: DataFrame, text: str, keep: Sequence[str], added: str,
    start: Callable[[], Callable[[list[str | None]], Sequence]], rows: int = 256,
) -> DataFrame:
    """The ``keep`` columns and the ``added`` ones (a DDL string), computed from each row's text.

    ``start`` runs once per task and returns a function from texts to one sequence per added column.
    It gets ``rows`` texts at a time, so a task's memory doesn't grow with its partition. The kept
    columns stay Arrow data of whatever type.
    """
    added_type = T.StructType.fromDDL(added)
    schema = T.StructType([*docs.select(*keep).schema.fields, *added_type.fields])
    kinds = [field.type for field in to_arrow_schema(added_type)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                *kept, texts = part.columns
                new = function(texts.to_pylist())
                columns = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(new, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=schema.names)

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def spelling(entries: Sequence[bytes]) -> Callable[[np.ndarray], np.ndarray]:
    """Function from an array of token ids to their bytes, one after another."""
    flat, size = np.frombuffer(b"".join(entries), np.uint8), np.array([len(x) for x in entries], np.int64)
    start = np.cumsum(size) - size

    def spell(ids: np.ndarray) -> np.ndarray:
        n = size[ids]
        ends = np.cumsum(n)
        return flat[np.repeat(start[ids] - ends + n, n) + np.arange(n.sum())]

    return spell


class Memo(dict):
    """Bounded cache of a pure function of one value; it starts anew when it is full."""

    def __init__(self, function: Callable[[Hashable], object], most: int):
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.function(key)
        return value

    def of(self, keys: Iterable[Hashable]) -> Iterable[object]:
        return map(self.__getitem__, keys)
