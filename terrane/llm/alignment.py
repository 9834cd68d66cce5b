"""Alignment of two tokenizers over a corpus, each distinct text once.

Rows of equal text meet in a shuffle by the text itself; one of them is tokenised, and its multiplicity
weighs what it adds to the counts. Both tokenizers see a space and the text. Where a single space stands
between signs that are no white space, neither has a token across it, so a text is cut there into cells, which often
repeat; a task remembers the tokens and links of cells. New cells go to tokenizer A several at a time,
laid end to end. Inside a cell, offsets where tokens
of both end cut groups, and two tokens are linked if their bytes overlap.

Texts go in chunks of a bounded number of signs (a longer text is a chunk of its own). A chunk carries the distinct id
pairs of its links once, with their weighted counts; summed over all chunks these give the counts of the corpus, which go back
to each chunk for its own pairs only. So what meets in a shuffle is one row per chunk and pair, not per link, and no task
holds the pairs of the corpus.

Edge cases: NULL, empty text and a text whose joined tokens of either kind differ from space + text have no
tokens: zeros and an empty digest. Repeated rows and ties count each. A NULL key is a row like others. An empty table
gives no row. Columns other than the named ones don't matter.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources import stage
from .common import spelling

# A space that follows a sign and comes before one: no token of either kind reaches across it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_CHUNK = """chunk binary, digest array<binary>, times array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>,
n_links array<bigint>, groups_sha256 array<string>, cells array<int>, ends array<int>, links array<int>, link_ends array<int>,
pairs array<bigint>, weights array<bigint>"""
_BATCH, _RUN = 8192, 64
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@dataclass(frozen=True)
class Vocabularies:
    """Paths of a byte-level BPE file (A) and of a SentencePiece model (B)."""

    a: str
    b: str

    def open(self) -> Cells:
        """One for the tasks of a worker, which run one after another: loading takes long, and cells come again."""
        return _opened(self.a, self.b)


@cache
def _opened(a: str, b: str) -> Cells:
    return Cells(a, b)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


def _per(ends: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """How many of the ascending ``marks`` lie in each of the stretches that end at ``ends``."""
    return np.diff(np.searchsorted(marks, ends, "right"), prepend=0)


class Cells:
    """Tokens, groups and links of cells, remembered for up to ``most`` cells under consecutive numbers."""

    def __init__(self, a: str, b: str, most: int = 250_000):
        # Tasks share the cores already; threads of the tokenizer's own would only take more memory and time.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b, self.most = Tokenizer.from_file(a), SentencePieceProcessor(model_file=b), most
        self.a.encode_special_tokens = True
        # Byte-level entries: printable Latin-1 signs stand for themselves, the other bytes for 256 and up in their order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        sign = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in set(plain))}
        a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, i in self.a.get_vocab(with_added_tokens=False).items():
            a_bytes[i] = bytes([sign[c] for c in entry]) if all(c in sign for c in entry) else b""
        b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in found], np.int64) for found in (a_bytes, b_bytes))
        self.a_spelt, self.b_spelt = spelling(a_bytes), spelling(b_bytes)
        # An id and what follows it: another of its side, the other side, or the next group.
        names = [str(i) for i in range(max(len(a_bytes), len(b_bytes)))]
        self.written = [name + after for after in ",|;" for name in names]
        self.written_size = np.array([len(x) for x in self.written], np.int64)
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.empty((4, 0), np.int64)  # tokens of A, of B, groups, links; -1 where tokens don't give the bytes
        self.links, self.link_starts = np.empty(0, np.int64), np.zeros(1, np.int64)

    def _keep(self, cells: list[str]) -> None:
        """Forget all but these cells: what comes back is likely to come again."""
        at = np.fromiter(map(self.number.__getitem__, cells), np.int64, len(cells))
        links, ends = self._links(at)
        self.number = dict(zip(cells, range(len(cells)), strict=True))
        self.groups = [self.groups[i] for i in at.tolist()]
        self.sizes, self.links, self.link_starts = self.sizes[:, at], links, np.append(0, ends)

    def _links(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of these cells one after another, and where each one's end."""
        n = np.maximum(self.sizes[3, at], 0)
        ends = np.cumsum(n)
        return self.links[np.arange(n.sum()) - np.repeat(ends - n, n) + np.repeat(self.link_starts[at], n)], ends

    def learn(self, cells: set[str]) -> None:
        """Tokenise the cells that aren't known."""
        if len(self.number) + len(cells) > self.most:
            self._keep([c for c in cells if c in self.number])
        new = [c for c in cells if c not in self.number]
        for at in range(0, len(new), _BATCH):  # what the tokenizers return takes far more room than what is kept of it
            self._learn(new[at : at + _BATCH])

    def _learn(self, new: list[str]) -> None:
        odd = {c for c in new if c[1:2].isspace() or c[-1].isspace()}
        plain = [c for c in new if c not in odd] if odd else new
        new = [*plain, *odd]
        length = np.array([len(c.encode()) for c in new], np.int64)
        raw = np.frombuffer("".join(new).encode(), np.uint8)
        a, n_a = self._a_ids(new, len(plain), length)
        found = self.b.encode([c[1:] for c in new], num_threads=1)
        b, n_b = _flat(found), np.array([len(x) for x in found], np.int64)
        good = _spelt(a, n_a, self.a_size, self.a_spelt, length, raw) & _spelt(b, n_b, self.b_size, self.b_spelt, length, raw)
        sizes = np.full((4, len(new)), -1, np.int64)
        groups, sizes[:, good], links = self._aligned(a[np.repeat(good, n_a)], n_a[good], b[np.repeat(good, n_b)], n_b[good], length[good])
        texts = iter(groups)
        self.groups += [next(texts) if x else "" for x in good.tolist()]
        per_cell = np.maximum(sizes[3], 0)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.sizes = np.concatenate([self.sizes, sizes], 1)
        self.link_starts = np.append(self.link_starts, self.link_starts[-1] + np.cumsum(per_cell))
        self.links = np.append(self.links, links)

    def _a_ids(self, cells: list[str], plain: int, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A, one cell's after another's, and how many each cell has.

        The first ``plain`` cells have signs behind their space and at their end, so no token reaches from one into the next, and
        ``_RUN`` of them are encoded as one text. If its tokens' bytes don't end where its cells do, its cells are encoded by themselves.
        """
        encoded = lambda texts: [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        runs = [slice(at, min(at + _RUN, plain)) for at in range(0, plain, _RUN)]
        ids, counts, alone = [], [], []
        for run, found in zip(runs, encoded(["".join(cells[run]) for run in runs]), strict=True):
            found = np.array(found, np.int64)
            ends, cell_ends = np.cumsum(self.a_size[found]), np.cumsum(length[run])
            last = np.searchsorted(ends, cell_ends)
            if len(ends) and ends[-1] == cell_ends[-1] and (ends[last] == cell_ends).all():
                ids.append(found)
                counts.append(np.diff(last, prepend=-1))
            else:
                alone.append((len(ids), run))
                ids.append(None)
                counts.append(None)
        for at, run in [*alone, (len(ids), slice(plain, len(cells)))]:
            each = encoded(cells[run])
            ids[at:at + 1], counts[at:at + 1] = [_flat(each)], [np.array([len(x) for x in each], np.int64)]
        return np.concatenate(ids), np.concatenate(counts)

    def _aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, length: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of cells laid end to end: groups as text, the four sizes, and the links (a << 32 | b).

        Every cell's end is an end of both, so nothing reaches from one cell into the next.
        """
        cell_ends = np.cumsum(length)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        # The tokens of a group in their written order: those of A, then those of B.
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        order = np.empty(len(a) + len(b), np.int64)
        a_place = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
        b_place = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        most = len(self.written) // 3
        order[a_place] = a + most * np.append(a_group[1:] != a_group[:-1], True)[: len(a)]
        order[b_place] = b + 2 * most * np.append(b_group[1:] != b_group[:-1], True)[: len(b)]
        text = "".join(map(self.written.__getitem__, order.tolist()))
        ends = np.append(0, np.cumsum(self.written_size[order]))[np.cumsum(n_a + n_b)].tolist() if len(n_a) else []
        groups = [text[s : e - 1] for s, e in zip([0, *ends], ends, strict=False)]
        # Tokens overlap from the one that ends after another's start to the one that reaches its end.
        first = np.searchsorted(b_ends, np.append(0, a_ends[:-1])[: len(a)], "right")
        n = np.searchsorted(b_ends, a_ends, "left") - first + 1
        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        links = np.repeat(a, n) << 32 | b[which]
        n_links = np.diff(np.append(0, np.append(0, np.cumsum(n))[np.cumsum(n_a)]))
        return groups, np.stack([n_a, n_b, _per(cell_ends, cuts), n_links]), links


def split(text: str) -> list[str]:
    """The cells of space + text; each begins with a space."""
    first, *others = _CUT.split(" " + text)
    return [first, *[" " + x for x in others]]


def _total(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each of the stretches, some of them empty, that end at ``ends``."""
    return np.diff(np.append(0, np.cumsum(values))[ends], prepend=0)


def _spelt(ids: np.ndarray, n: np.ndarray, size: np.ndarray, spell, length: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """For each cell, whether its ``n`` ids have the bytes of ``raw``, where cells of ``length`` bytes follow each other."""
    good = _total(size[ids], np.cumsum(n)) == length
    differ = spell(ids[np.repeat(good, n)]) != raw[np.repeat(good, length)]
    good[good] = _total(differ, np.cumsum(length[good])) == 0
    return good


def _chunk(cells: Cells, texts: list[str], digests: list[bytes], times: list[int]) -> tuple:
    """One row of the schema ``_CHUNK``."""
    parts = [split(x) for x in texts]
    cells.learn(set(chain.from_iterable(parts)))
    found = [np.fromiter(map(cells.number.__getitem__, part), np.int64, len(part)) for part in parts]
    found = [x if cells.sizes[0, x].min() >= 0 else x[:0] for x in found]
    sha = [hashlib.sha256(";".join(map(cells.groups.__getitem__, x.tolist())).encode()).hexdigest() if len(x) else "" for x in found]
    every, ends = np.concatenate(found), np.cumsum([len(x) for x in found])
    sizes = [_total(row[every], ends) for row in cells.sizes]
    used, at = np.unique(every, return_inverse=True)
    links, link_ends = cells._links(used)
    pairs, which = np.unique(links, return_inverse=True)
    # Cells by their weighted occurrences, then pairs by those of the cells that hold them.
    per_cell, weights = np.zeros(len(used), np.int64), np.zeros(len(pairs), np.int64)
    np.add.at(per_cell, at, np.repeat(np.array(times, np.int64), np.diff(ends, prepend=0)))
    np.add.at(weights, which, np.repeat(per_cell, np.diff(link_ends, prepend=0)))
    return digests[0], digests, times, *sizes, sha, at, ends, which, link_ends, pairs, weights


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def chunks(docs: DataFrame, text: str, vocabularies: Vocabularies, signs: int) -> DataFrame:
    """Rows of the schema ``_CHUNK`` over the distinct texts of ``docs``."""
    distinct = (
        docs.where(F.col(text).isNotNull() & (F.col(text) != "")).groupBy(F.col(text).alias("text")).agg(F.count("*").alias("times"))
        .select("text", _digest(F.col("text")).alias("digest"), "times")
    )
    schema = T.StructType.fromDDL(_CHUNK)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = vocabularies.open()
        texts, digests, times, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            values = _chunk(cells, texts, digests, times)
            columns = [pa.array([x], kind.type) for x, kind in zip(values, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for t, d, n in zip(*(column.to_pylist() for column in batch.slice(at, 256).columns), strict=True):
                    if texts and size + len(t) > signs:
                        yield row()
                        texts, digests, times, size = [], [], [], 0
                    texts.append(t)
                    digests.append(d)
                    times.append(n)
                    size += len(t)
        if texts:
            yield row()

    return distinct.mapInArrow(run, schema)


def pair_counts(made: DataFrame) -> DataFrame:
    """``pair``, its ``count`` over the corpus and ``best``: no pair of its B id has a greater one."""
    counts = made.select(F.explode(F.arrays_zip("pairs", "weights")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.weights").alias("count"))
    counts = stage(counts)
    # An id of A at most per pair, so a B id has as many pairs as A has ids, no more.
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    most = counts.groupBy(b).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _measured(made: DataFrame, counts: DataFrame) -> DataFrame:
    """``digest``, ``times`` and the measures of every distinct text."""
    asked = made.select("chunk", F.posexplode("pairs").alias("at", "pair")).join(counts, "pair")
    answers = asked.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("answers"))
    both = made.drop("pairs", "weights").join(answers.select("chunk", F.col("answers.count").alias("count"), F.col("answers.best").alias("best")), "chunk", "left").drop("chunk")
    schema = T.StructType.fromDDL("digest binary, times bigint, groups_sha256 string, " + ", ".join(f"{m} bigint" for m in MEASURES))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda name: batch[name].slice(k, 1).flatten()  # noqa: B023, E731
                value = lambda name: get(name).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
                counts, best, links = value("count"), value("best"), value("links")
                cells, ends = value("cells"), value("ends")
                in_text = [_total(_total(x[links], value("link_ends"))[cells], ends) for x in (best, counts)]
                columns = [get(c) for c in ("digest", "times", "groups_sha256", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x, pa.int64()) for x in in_text]], schema=arrow)

    return both.mapInArrow(run, schema)


def align(docs: DataFrame, key: str, text: str, vocabularies: Vocabularies, signs: int = 1_000_000, hot: int = 2000) -> DataFrame:
    """The key, ``MEASURES`` and ``groups_sha256`` of every row of ``docs``.

    A text that makes up more than one in ``hot`` of all rows is one of fewer than ``hot``: these meet their
    rows by a broadcast, the others in a shuffle.
    """
    made = stage(chunks(docs, text, vocabularies, signs))
    found = stage(_measured(made, pair_counts(made)))
    rows = docs.select(F.col(key).alias(key), _digest(F.col(text)).alias("digest"))
    total = found.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    often = F.col("times") * hot > total
    named = [*MEASURES, "groups_sha256"]
    common = found.where(often).select("digest", *[F.col(c).alias(f"_{c}") for c in named])
    rare = found.where(~often).select("digest", *named)
    # A row that has met a frequent text needs no partner in the shuffle and gets a place of its own there.
    met = rows.join(F.broadcast(common), "digest", "left")
    hit = F.col("_n_a").isNotNull()
    apart = met.where(hit).select(key, *[F.col(f"_{c}").alias(c) for c in named])
    others = met.where(~hit & F.col("digest").isNotNull()).select(key, "digest").join(rare, "digest", "left").select(key, *named)
    missing = met.where(F.col("digest").isNull()).select(key, *[F.lit(None).alias(c) for c in named])
    every = apart.unionByName(others).unionByName(missing)
    return every.select(key, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
