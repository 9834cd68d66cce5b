"""SentencePiece encoding by sampling without replacement, and decoding.

All segmentations of a text are the paths of a lattice whose arcs are the vocabulary's pieces. A path's
probability is in proportion to the product of its pieces' weights. ``encode`` returns the ``k`` paths that would
rank first if Gumbel noise were added to every path's log-probability, which is a sample of ``k`` distinct
paths without replacement. It finds them by an A* search over sets of paths: the greatest perturbed value of a
set is a Gumbel value at the set's total mass, cut off at the value of the set it is part of, so sets need not
be listed to be ranked. The first path descends from the start, choosing each arc by its share of
the mass; at each node it leaves behind the set of all paths that turn off there. The best set left is
opened next, from the node where it turns off. The ``k+1``-th value gives the threshold of the inclusion
probabilities, 1 - exp(-exp(log p - threshold)). Their logarithms are returned: a single path of a long text
has a chance below the range of a double.

Pieces never reach over the start of a run of spaces, so the lattice of a text is a chain of lattices of its
words; a task builds those of distinct words once and keeps them from batch to batch, up to a bound, and all words of a
batch descend together in numpy.
Noise is a hash of the row's seed, the path, the word and the step, so a row's samples don't depend on
its neighbours or on a repeated task.

A vocabulary whose scores are merge ranks (BPE) has weights by Zipf's law, 1 / (rank + 1) to the power of
``sharpness``; one whose scores are log-probabilities uses those, times ``sharpness``.

Edge cases: NULL text gives NULL; the empty text has one segmentation, of no pieces. A text with fewer than
``k`` segmentations gives all of them, with the log of 1. Characters outside the vocabulary become bytes,
so every text comes back from ``decode`` unchanged, the space marker itself included. Repeated rows give
repeated results.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, spelling

MARK = "▁"
_BASE, _ODD, _STEP = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SLOT_BITS = 18


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` by id (None: not a piece of text), natural logs of their weights, ids of the 256 bytes."""

    pieces: tuple[str | None, ...]
    weights: np.ndarray
    bytes_: tuple[int, ...]

    def raw(self) -> list[bytes]:
        """What each id decodes to; the marker is a space."""
        out = [(p or "").replace(MARK, " ").encode() for p in self.pieces]
        for value, at in enumerate(self.bytes_):
            out[at] = bytes([value])
        return out


def load(path: str, sharpness: float = 1.0) -> Vocabulary:
    """The vocabulary of a SentencePiece model file, read on the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i)) for i in ids]
    score = np.array([model.get_score(i) for i in ids])
    rank = np.where(score < -1e6, np.arange(len(score)), -score)  # user-defined pieces count by their id
    ranked = bool((rank == np.round(rank)).all())
    logs = -np.log1p(np.maximum(rank, 0)) if ranked else score
    usable = np.array([p or model.is_byte(i) for i, p in enumerate(plain)])
    logs = logs - np.log(np.exp(logs[usable]).sum())
    # A byte of its own is worth as little as the last piece.
    byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
    logs[list(byte_ids.values())] = logs[usable].min()
    return Vocabulary(tuple(model.id_to_piece(i) if plain[i] else None for i in ids), sharpness * logs, tuple(byte_ids[b] for b in range(256)))


class _Lookup:
    """Pieces, and what pieces begin with, by a rolling hash of their characters.

    Direct tables: what clashes in one is in the next. A place holds the piece's id, -2 if pieces only begin so, -1 if it is free.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.length = max(len(p) for p in vocabulary.pieces if p)
        known: dict[str, int] = {}
        for at, piece in enumerate(vocabulary.pieces):
            if piece:
                known.setdefault(piece, at)
        for piece in list(known):
            for n in range(len(piece) - 1, 0, -1):
                if known.setdefault(piece[:n], -2) == -2 and n > 1 and piece[: n - 1] in known:
                    break
        size = np.fromiter(map(len, known), np.int64, len(known))
        points = np.frombuffer("".join(known).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        begin, h, ids = np.cumsum(size) - size, np.zeros(len(size), np.uint64), np.fromiter(known.values(), np.int32, len(known))
        for n in range(self.length):
            on = np.flatnonzero(size > n)
            h[on] = h[on] * _BASE + points[begin[on] + n]
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        while len(h):
            slot = self._slot(h, len(self.tables))
            _, placed = np.unique(slot, return_index=True)
            table = np.zeros(1 << _SLOT_BITS, np.uint64), np.full(1 << _SLOT_BITS, -1, np.int32)
            table[0][slot[placed]], table[1][slot[placed]] = h[placed], ids[placed]
            self.tables.append(table)
            h, ids = np.delete(h, placed), np.delete(ids, placed)

    @staticmethod
    def _slot(h: np.ndarray, k: int) -> np.ndarray:
        return ((h ^ h >> np.uint64(29)) * np.uint64((int(_ODD) + 2 * k * int(_STEP)) % 2**64) >> np.uint64(64 - _SLOT_BITS)).astype(np.intp)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The ids; -2 where pieces only begin so, -1 where none does."""
        out, todo = np.full(len(h), -1, np.int32), np.arange(len(h))
        for k, (hashes, ids) in enumerate(self.tables):
            slot = self._slot(h[todo], k)
            there, same = ids[slot], hashes[slot] == h[todo]
            out[todo[same]] = there[same]
            todo = todo[(there != -1) & ~same]
        return out


class Lattices:
    """Lattices of distinct words. A node is a character; its longest arc comes first.

    ``token`` of an arc is a piece id, or beyond them a place in ``spelled``, byte ids of a character.
    """

    def __init__(self, words: list[str], lookup: _Lookup):
        v = lookup.v
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.room: dict[str, np.ndarray] = {}
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        left = np.repeat(self.end, lengths) - np.arange(len(points))
        # A space is the marker; the marker itself is a character outside the vocabulary.
        code = np.where(points == 0x20, ord(MARK), np.where(points == ord(MARK), 0x200000, points)).astype(np.uint64) + np.uint64(1)
        self.pieces, h, at = len(v.pieces), np.zeros(len(points), np.uint64), np.arange(len(points))
        found: list[tuple[np.ndarray, np.ndarray]] = []  # by length: nodes that a piece starts at, and the piece
        for n in range(1, lookup.length + 1):
            at = at[left[at] >= n]
            h[at] = h[at] * _BASE + code[at + n - 1]
            token = lookup.find(h[at])
            hit = token >= 0
            found.append((at[hit], token[hit]))
            at = at[token != -1]  # pieces that are longer begin so
        self.spelled: list[list[int]] = []
        there = np.zeros(len(points), bool)
        there[found[0][0]] = True
        bare = np.flatnonzero(~there)
        values, which = np.unique(points[bare], return_inverse=True)
        spelled = []
        for x in values.tolist():
            ids = [v.bytes_[b] for b in chr(x).encode()]
            spelled.append(ids[0] if len(ids) == 1 else len(v.pieces) + len(self.spelled))
            if len(ids) > 1:
                self.spelled.append(ids)
        found[0] = tuple(map(np.concatenate, zip(found[0], (bare, np.array(spelled, np.int32)[which]), strict=True)))
        weights = np.concatenate([v.weights, [sum(v.weights[i] for i in ids) for ids in self.spelled]])
        arcs = np.zeros(len(points), np.int64)
        for nodes, _ in found:
            arcs[nodes] += 1
        self.first = np.append(0, np.cumsum(arcs))
        node = np.repeat(np.arange(len(points)), arcs)
        self.token, self.span = np.empty(len(node), np.int32), np.empty(len(node), np.int16)
        free = self.first[:-1].copy()
        for n in range(lookup.length, 0, -1):
            nodes, token = found[n - 1]
            self.token[free[nodes]], self.span[free[nodes]] = token, n
            free[nodes] += 1
        # Mass of all paths from a node to its word's end, nearest the end first. Sums are taken relative to
        # the path that starts with one character, which is always there and the last of a node's arcs.
        mass = np.zeros(len(points) + 1)
        order = np.argsort(left.astype(np.uint16) if left.max(initial=0) < 1 << 16 else left, kind="stable")
        number = arcs[order]
        upto = np.cumsum(number)
        listed = _ranges(self.first[order], number)
        target = node + self.span
        target[left[node] == self.span] = len(points)  # the word's end, whose mass is one
        target, value = target[listed], weights[self.token[listed]]
        for a, b in zip(*_runs(left[order]), strict=True):
            lo, hi = upto[a] - number[a], upto[b - 1]
            value[lo:hi] += mass[target[lo:hi]]
            usual = value[upto[a:b] - 1]
            total = np.add.reduceat(np.exp(value[lo:hi] - np.repeat(usual, number[a:b])), upto[a:b] - number[a:b] - lo)
            mass[order[a:b]] = usual + np.log(total)
        self.arc_log = np.empty(len(node))
        self.arc_log[listed] = value
        self.arc_log -= mass[node]
        total = np.append(0.0, np.cumsum(np.exp(self.arc_log)))
        self.upto = total[1:] - total[self.first[node]]

    def extend(self, other: Lattices) -> None:
        """Put the words of another one behind those that are here."""
        nodes, arcs = len(self.first) - 1, len(self.token)
        token = np.where(other.token < self.pieces, other.token, other.token + np.int32(len(self.spelled)))
        more = {"start": other.start + nodes, "end": other.end + nodes, "first": other.first[1:] + arcs, "token": token}
        for name, new in {**more, "span": other.span, "arc_log": other.arc_log, "upto": other.upto}.items():
            here = getattr(self, name)
            n = len(here) + len(new)
            # Room for twice as much, whose pages take no memory before they are used.
            if len(self.room.get(name, ())) < n:
                self.room[name] = np.empty(2 * n, here.dtype)
                self.room[name][: len(here)] = here
            self.room[name][len(here) : n] = new
            setattr(self, name, self.room[name][:n])
        self.spelled = self.spelled + other.spelled

    def only(self, words: np.ndarray) -> None:
        """Drop all words but these, which get new numbers in their order."""
        self.room = {}
        size = self.end[words] - self.start[words]
        nodes = _ranges(self.start[words], size)
        self.end = np.cumsum(size)
        self.start = self.end - size
        number = self.first[nodes + 1] - self.first[nodes]
        arcs = _ranges(self.first[nodes], number)
        self.first = np.append(0, np.cumsum(number))
        for name in ("token", "span", "arc_log", "upto"):
            setattr(self, name, getattr(self, name)[arcs])
        far = self.token >= self.pieces
        used, which = np.unique(self.token[far], return_inverse=True)
        self.token[far] = self.pieces + which
        self.spelled = [self.spelled[i] for i in (used - self.pieces).tolist()]


class _Words:
    """Numbers and lattices of words, kept from batch to batch.

    When they would have more than ``most`` bytes, only those stay that the batch has again. A byte's lattice takes some
    hundred bytes, in every worker of an executor, and words that are frequent come again soon.
    """

    def __init__(self, lookup: _Lookup, most: int = 250_000):
        self.lookup, self.most = lookup, most
        self.numbers: dict[bytes, int] = {}
        self.net: Lattices | None = None

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's words; a word starts with a run of spaces, and every text at a space of its own."""
        spaced = [f" {x}".encode() if x else b"" for x in texts]
        flat = np.frombuffer(b"".join(spaced), np.uint8)
        ends = np.cumsum([len(x) for x in spaced])
        cut = flat == 0x20
        cut[1:] &= ~cut[:-1]
        cut[[e - len(x) for e, x in zip(ends.tolist(), spaced, strict=True) if x]] = True
        cuts = np.flatnonzero(cut)
        if not len(cuts):
            return [np.empty(0, np.int64) for _ in texts]
        offsets = pa.py_buffer(np.append(cuts, len(flat)).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, offsets, pa.py_buffer(flat)]).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter((self.numbers.get(w, -1) for w in words), np.int64, len(words))
        fresh = np.flatnonzero(number < 0)
        new = [words[i] for i in fresh.tolist()]
        if new and self.net and self.net.end[-1] + sum(map(len, new)) > self.most:
            again = np.flatnonzero(number >= 0)
            self.net.only(number[again])
            number[again] = np.arange(len(again))
            self.numbers = {words[i]: at for at, i in enumerate(again.tolist())}
        if new:
            built = Lattices([w.decode() for w in new], self.lookup)
            number[fresh] = np.arange(len(self.numbers), len(self.numbers) + len(new))
            self.numbers.update(zip(new, number[fresh].tolist(), strict=True))
            if self.net:
                self.net.extend(built)
            else:
                self.net = built
        return np.split(number[coded.indices.to_numpy()], np.searchsorted(cuts, ends[:-1]))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if not len(keys):
        return np.empty(0, np.intp), np.empty(0, np.intp)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.append(0, cuts), np.append(cuts, len(keys))


def _log_inclusion(above: float) -> float:
    """log(1 - exp(-exp(above)))."""
    return above if above < -30 else float(np.log(-np.expm1(-np.exp(min(above, 700.0)))))


@dataclass
class _Path:
    """A found path: its tokens by word, and where each of its words' tokens start."""

    tokens: np.ndarray
    starts: np.ndarray
    log_p: float
    value: float


class _Search:
    """Samples of one batch of texts."""

    def __init__(self, texts: list[str], seeds: list[int], k: int, words: _Words):
        self.k, self.texts = k, texts
        self.words = words.of(texts)
        self.net = words.net
        self.seeds = np.array([s & 0xFFFFFFFFFFFFFFFF for s in seeds], np.uint64)
        self.pieces = len(words.lookup.v.pieces)

    def descend(self, turns: list[tuple[int, int, int, int, float, float]]) -> dict[int, tuple]:
        """Follow one path in each of several texts, from a turn: (text, path number, word, node, log p, value).

        Per text: tokens and their number by word, log p, and the best sets of paths that it turned away from:
        (value, word, node, log p so far, arcs taken there).
        """
        net = self.net
        sizes = np.array([len(self.words[t[0]]) - t[2] for t in turns])
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(turns)), sizes)
        word = np.arange(len(owner)) - np.repeat(ends - sizes, sizes) + np.repeat([t[2] for t in turns], sizes)
        kind = np.concatenate([self.words[t[0]][t[2]:] for t in turns])
        place, stop = net.start[kind], net.end[kind]
        place[ends - sizes] = [t[3] for t in turns]
        base = _mix(self.seeds[[t[0] for t in turns]] + np.array([t[1] for t in turns], np.uint64) * _STEP)
        noise = _mix(base[owner] + word.astype(np.uint64) * _ODD)
        log_p, count = np.zeros(len(owner)), np.zeros(len(owner), np.int64)
        taken, active, step = [], np.flatnonzero(place < stop), 0
        while len(active):
            node = place[active]
            draw = _mix(noise[active] + np.array([step + 1], np.uint64) * _STEP)
            u = ((draw >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32
            arc, last = net.first[node], net.first[node + 1] - 1
            on = np.flatnonzero((arc < last) & (u > net.upto[arc]))
            while len(on):
                arc[on] += 1
                on = on[(arc[on] < last[on]) & (u[on] > net.upto[arc[on]])]
            so_far = log_p[active]
            chosen = net.arc_log[arc]
            log_p[active] = so_far + chosen
            taken.append((active, step, arc, node, so_far, chosen, draw))
            count[active] = step + 1
            place[active] = node + net.span[arc]
            active = active[place[active] < stop[active]]
            step += 1
        # Now that each word's log p is known, so is that of the path before each word.
        total = np.cumsum(log_p)
        before = total - log_p
        before += np.repeat(np.array([t[4] for t in turns]) - before[ends - sizes], sizes)
        at = np.cumsum(count) - count
        tokens = np.empty(count.sum(), np.int64)
        value = np.array([t[5] for t in turns])
        sets: list[tuple] = []
        for step_ in range(len(taken)):
            (occurrence, _, arc, node, so_far, chosen, draw), taken[step_] = taken[step_], None
            tokens[at[occurrence] + step_] = net.token[arc]
            p = np.exp(chosen)
            other = np.flatnonzero(p < 1 - 1e-12)
            o = occurrence[other]
            here = before[o] + so_far[other]
            rest = here + np.log1p(-p[other])
            low = ((draw[other] & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * 2.0**-32
            top = value[owner[o]]
            sets.append((owner[o], rest - np.log(np.exp(rest - top) - np.log(low)), word[o], node[other], here, arc[other]))
        columns = [np.concatenate(x) for x in zip(*sets, strict=True)] if sets else [np.empty(0)] * 6
        sets.clear()
        # The k best sets of each text, the best first.
        whose, worth = columns[0].astype(np.intp), columns[1].copy()
        best: list[list[int]] = [[] for _ in turns]
        for _ in range(self.k):
            top = np.full(len(turns), -np.inf)
            np.maximum.at(top, whose, worth)
            for j in np.flatnonzero((worth == top[whose]) & (worth > -np.inf)).tolist():
                best[whose[j]].append(j)
                worth[j] = -np.inf
        out = {}
        for i, t in enumerate(turns):
            a, b = ends[i] - sizes[i], ends[i]
            out[t[0]] = (
                tokens[at[a] : at[b - 1] + count[b - 1]], count[a:b], float(before[b - 1] + log_p[b - 1]),
                [(float(columns[1][j]), int(columns[2][j]), int(columns[3][j]), float(columns[4][j]), (int(columns[5][j]),)) for j in best[i][: self.k]],
            )
        return out

    def run(self) -> list[list[tuple[np.ndarray, float, float]]]:
        """Per text its samples in order: ids, log-probability, log of the inclusion probability."""
        full = [i for i, w in enumerate(self.words) if len(w)]
        found: list[list[_Path]] = [[] for _ in self.words]
        open_: list[list] = [[] for _ in self.words]
        turns = []
        for i in full:
            u = (int(_mix(self.seeds[i : i + 1])[0] >> np.uint64(11)) + 0.5) / 2**53
            turns.append((i, 0, 0, int(self.net.start[self.words[i][0]]), 0.0, float(-np.log(-np.log(u)))))
        prefix: dict[int, tuple] = {}
        for number in range(self.k):
            if not turns:
                break
            done = self.descend(turns)
            for i, _, word, _, _, value in turns:
                tokens, count, log_p, sets = done[i]
                if number:
                    kept, starts = prefix[i]
                    within = len(kept) - starts[word]
                    count = count.copy()
                    count[0] += within
                    tokens = np.concatenate([kept, tokens])
                    starts = np.concatenate([starts[:word], starts[word] + np.cumsum(count) - count])
                else:
                    starts = np.cumsum(count) - count
                found[i].append(_Path(tokens, starts, log_p, value))
                for s in sets:
                    heapq.heappush(open_[i], (-s[0], *s[1:], number))
            turns = []
            if number + 1 == self.k:
                break
            for i in full:
                if open_[i]:
                    turns.append(self._turn(i, number + 1, open_[i], found[i], prefix))
        out = []
        for i, paths in enumerate(found):
            threshold = -open_[i][0][0] if open_[i] else -np.inf
            out.append([(self._spell(p.tokens), p.log_p, _log_inclusion(p.log_p - threshold)) for p in paths] or [(np.empty(0, np.int64), 0.0, 0.0)])
        return out

    def _turn(self, i: int, number: int, heap: list, paths: list[_Path], prefix: dict) -> tuple:
        """Open the best set of a text: the arc that its path takes, and the set that is left without it."""
        net = self.net
        minus, word, node, here, gone, parent = heapq.heappop(heap)
        arcs = np.arange(net.first[node], net.first[node + 1])
        arcs = arcs[[a not in gone for a in arcs.tolist()]]
        p = np.exp(net.arc_log[arcs])
        share = p / p.sum()
        draw = _mix(self.seeds[i : i + 1] + np.array([number], np.uint64) * _ODD + np.uint64(7))[0]
        u = (int(draw >> np.uint64(32)) + 0.5) / 2**32
        pick = min(int(np.searchsorted(np.cumsum(share), u)), len(arcs) - 1)
        arc = int(arcs[pick])
        if len(arcs) > 1:
            rest = here + float(np.log(max(np.delete(p, pick).sum(), 1e-300)))
            low = (int(draw & np.uint64(0xFFFFFFFF)) + 0.5) / 2**32
            heapq.heappush(heap, (-float(rest - np.log(np.exp(rest + minus) - np.log(low))), word, node, here, (*gone, arc), parent))
        # The tokens of the parent's path up to this node, then the arc.
        old = paths[parent]
        at, reached = old.starts[word], net.start[self.words[i][word]]
        while reached < node:
            reached += self._length(int(old.tokens[at]))
            at += 1
        prefix[i] = (np.append(old.tokens[:at], net.token[arc]), old.starts)
        return (i, number, word, node + int(net.span[arc]), here + float(net.arc_log[arc]), -minus)

    def _length(self, token: int) -> int:
        return self.lengths[token] if token < self.pieces else 1

    def _spell(self, tokens: np.ndarray) -> np.ndarray:
        if not len(tokens) or tokens.max() < self.pieces:
            return tokens
        return np.array([x for t in tokens.tolist() for x in (self.net.spelled[t - self.pieces] if t >= self.pieces else (t,))])


def sampler(vocabulary: Vocabulary, k: int):
    """Function from texts and seeds to samples: for each text (ids, log-probability, log-inclusion) of each path."""
    words = _Words(_Lookup(vocabulary))
    lengths = [len(p) if p else 1 for p in vocabulary.pieces]

    def sample(texts: list[str], seeds: list[int]):
        search = _Search(texts, seeds, k, words)
        search.lengths = lengths
        return search.run()

    return sample


def decoder(vocabulary: Vocabulary):
    """Function from ids to text; the space that encoding puts in front goes again."""
    raw = vocabulary.raw()
    return lambda ids: b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, key: str, text: str, vocabulary: Vocabulary, keep: list[str], k: int = 2, seed: int = 0, batch_chars: int = 250_000) -> DataFrame:
    """The ``keep`` columns, ``samples``, an array of (ids, log_prob, log_inclusion), and ``round_trip``.

    Samples depend on the row's key, its text and ``seed``. ``round_trip`` says whether every sample decodes
    to the text. Texts are searched together up to ``batch_chars`` characters, which bounds a task's memory
    but for the length of a single text.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the pieces of a vocabulary file
    kind = pa.list_(pa.struct([("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()), ("log_inclusion", pa.float64())]))

    def start():
        sample, spell = sampler(shipped.value, k), spelling(shipped.value.raw())

        def batches(texts):
            begin, chars = 0, 0
            for i, x in enumerate(texts):
                chars += len(x)
                if chars >= batch_chars:
                    yield slice(begin, i + 1)
                    begin, chars = i + 1, 0
            yield slice(begin, len(texts))

        def encoded(found):
            texts, seeds = ([x[c] for x in found if x["text"] is not None] for c in ("text", "seed"))
            samples = [s for part in batches(texts) for s in (sample(texts[part], seeds[part]) if texts[part] else [])]
            spaced = (f" {x}".encode() if x else b"" for x in texts)
            same = iter([all(spell(s[0]).tobytes() == x for s in row) for x, row in zip(spaced, samples, strict=True)])
            flat = [s for row in samples for s in row]
            ids = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum([len(s[0]) for s in flat], dtype=np.int64)), pa.int32()),
                pa.array(np.concatenate([s[0] for s in flat]).astype(np.int32) if flat else [], pa.int32()),
            )
            each = pa.StructArray.from_arrays([ids, pa.array([s[1] for s in flat], pa.float64()), pa.array([s[2] for s in flat], pa.float64())], fields=list(kind.value_type))
            there = [x["text"] is not None for x in found]
            sizes = iter([len(row) for row in samples])
            ends = np.append(0, np.cumsum([next(sizes) if t else 0 for t in there]))
            offsets = pa.array([int(e) if t else None for e, t in zip(ends, [*there, True], strict=True)], pa.int32())
            return pa.ListArray.from_arrays(offsets, each).cast(kind), [next(same) if t else None for t in there]

        return encoded

    given = docs.withColumn("_given", F.struct(F.col(text).alias("text"), F.xxhash64(F.col(key), F.lit(seed)).alias("seed")))
    added = "samples array<struct<ids: array<int>, log_prob: double, log_inclusion: double>>, round_trip boolean"
    return map_texts(given, "_given", keep, added, start)


def decode(rows: DataFrame, ids: str, vocabulary: Vocabulary, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``text``, decoded from an array of ids; NULL stays NULL."""
    shipped = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        back = decoder(shipped.value)
        return lambda found: ([None if x is None else back(x) for x in found],)

    return map_texts(rows, ids, keep, "text string", start)
