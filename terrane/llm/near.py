"""Near-duplicate documents by ProbMinHash signatures of weighted shingles, banding and verification.

A text's shingles of ``SHINGLE`` words are weighted by how often they occur. Each shingle is a Poisson
process at the rate of its weight, whose arrivals fall on random registers; a register keeps the shingle that
arrives first. Arrivals are drawn in order, and a shingle stops as soon as its next arrival is later than
the latest register. Registers of two texts agree with the chance of their probability Jaccard likeness, which for
shingles that occur once is the ordinary one.

Equal texts become one node first. Registers in bands give buckets; nodes in one bucket are candidates.
Of buckets with the same members one is kept. A bucket of fewer than ``CROWD`` members meets in one task (see ``_links`` and
``_joined``), the pairs that look most alike first; a pair in one component by then is not compared. A larger bucket is
spread and never becomes all its pairs (see ``_remaining`` and ``_prefixes``): its members are compared with a leader, links that hold join
components, and only members that are still outside their bucket's largest component are compared further,
with the members of other components. So a bucket of copies costs one comparison each, and no link between
candidates of different components stays unseen. Verification computes the likeness from all shingles of both texts.

Edge cases: NULL texts are alone, each with its own key as class; texts without a word are only copies
of equal ones; a text of fewer than ``SHINGLE`` words has one shingle of all of them; repeated rows are
copies; a NULL key has the class of its text's other rows, or NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import stage
from .common import Memo, map_texts
from .components import components, rooted

SHINGLE, BANDS, ROWS = 5, 25, 5
LEADERS, TURNS, TIES = 4096, 64, (4, 16, 64)
CROWD, APART = 2048, 16
WIDE, EARLIER = 32, 16
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def word_hashes() -> Memo:
    return Memo(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "replace")), most=300_000)


def shingles(text: str | None, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs."""
    found = (text or "").lower().split()
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(memo.of(found), np.uint64, len(found))
    n = max(1, len(hashes) - SHINGLE + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(hashes))):
        rolled = rolled * _ODD[0] + hashes[k : k + n]
    return np.unique(_mix(rolled), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """For each weighted set, none of them empty, the shingle that arrives first at each register.

    All sets are drawn together, each shingle until its next arrival is later than its set's latest register.
    """
    if not sets:
        return np.empty((0, registers), np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    shingle, rate = np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]).astype(np.float64)
    clock = np.zeros(len(shingle))
    first = np.full(len(sets) * registers, np.inf)
    winner = np.zeros(len(first), np.uint64)
    active, drawn = np.arange(len(shingle)), 0
    while len(active):
        # Several arrivals at once when few shingles are left, which saves rounds for short texts.
        n = max(1, min(64, 8192 // len(active)))
        seed = _mix(shingle[active][:, None] + (np.arange(drawn + 1, drawn + n + 1, dtype=np.uint64) * _ODD[0])[None])
        drawn += n
        wait = -np.log(((seed >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32) / rate[active][:, None]
        time = clock[active][:, None] + np.cumsum(wait, 1)
        clock[active] = time[:, -1]
        place = ((seed & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.intp) + (owner[active] * registers)[:, None]
        flat, place = time.ravel(), place.ravel()
        sooner = flat < first[place]
        flat, place, who = flat[sooner], place[sooner], np.repeat(active, n)[sooner]
        np.minimum.at(first, place, flat)
        best = flat == first[place]
        winner[place[best]] = shingle[who[best]]
        latest = first.reshape(len(sets), registers).max(1)
        active = active[clock[active] < latest[owner[active]]]
    return winner.reshape(len(sets), registers)


def buckets(won: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """For each signature one 64-bit number per band of registers."""
    parts = won[:, : bands * rows].reshape(len(won), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        out = _mix(out + parts[:, :, k] * _ODD[k % len(_ODD)])
    return out.view(np.int64)


def sketches(won: np.ndarray) -> np.ndarray:
    """For each signature the low two bits of all registers, 32 registers in a number."""
    parts = (won & np.uint64(3)).reshape(len(won), won.shape[1] // 32, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(parts, 2).view(np.int64)


def _most_differ(numbers: int, least: float) -> int:
    """How many registers of texts alike by ``least`` differ in their two bits at most: five standard deviations above the mean.

    Registers that differ show it in their two bits three times out of four.
    """
    differ, n = (1 - least) * 0.75, 32 * numbers
    return int(n * differ + 5 * (n * differ * (1 - differ)) ** 0.5)


def _may_be_alike(a: str, b: str, numbers: int, least: float) -> Column:
    """False if too many registers differ for a likeness of ``least``."""
    most = _most_differ(numbers, least)
    def pairs(k: int) -> Column:
        x = F.get(F.col(a), F.lit(k)).bitwiseXOR(F.get(F.col(b), F.lit(k)))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return sum((pairs(k) for k in range(1, numbers)), pairs(0)) <= most


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard likeness of two weighted sets of shingles.

    The sum over shared shingles i of 1 / sum_j max(x_j / x_i, y_j / y_i). With the shingles in the order
    of x / y, the maximum is the first term from i on and the second before it.
    """
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])] = a[1]
    y[np.searchsorted(every, b[0])] = b[1]
    if not len(every):
        return 0.0
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    start = np.searchsorted(ratio, ratio)
    above = np.append(np.cumsum(x[::-1])[::-1], 0.0)[start]
    below = np.append(0.0, np.cumsum(y))[start]
    shared = (x > 0) & (y > 0)
    return float((1 / (above[shared] / x[shared] + below[shared] / y[shared])).sum())


def _verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose texts are alike by ``least`` or more."""
    both = (
        pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("_u")), "u")
        .join(texts.select(F.col("node").alias("v"), F.col("text").alias("_v")), "v")
        .select("u", "v", F.struct("u", "_u", "_v").alias("_both"))
    )

    def start():
        memo = word_hashes()
        last = [None, None]  # pairs of one leader often follow each other

        def alike(rows):
            out = []
            for row in rows:
                if row["u"] != last[0]:
                    last[:] = row["u"], shingles(row["_u"], memo)
                out.append(likeness(last[1], shingles(row["_v"], memo)))
            return (out,)

        return alike

    return map_texts(both, "_both", ["u", "v"], "likeness double", start).where(F.col("likeness") >= least).select("u", "v")


def _met(n: int, owner: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether two of ``n`` members have one of these buckets in common; ``owner`` names the member that has a bucket."""
    met = np.zeros((n, n), bool)
    order = np.argsort(bucket, kind="stable")
    owner, cuts = owner[order], np.flatnonzero(np.diff(bucket[order])) + 1
    for both in np.split(owner, cuts):
        if len(both) > 1:
            met[np.ix_(both, both)] = True
    return met


def _joined(sketch: np.ndarray, met: np.ndarray, likeness_of: Callable[[int, int], float], least: float) -> list[tuple[int, int]]:
    """Links that tie the members of one bucket together as all its pairs would, but for those that have ``met``.

    ``sketch`` has a row for each member. Pairs that look most alike come first, and what is in one component already needs
    no comparison, so a family alike by more than ``least`` costs little more than one comparison for each member.
    """
    n, most = len(sketch), _most_differ(sketch.shape[1], least)
    block, found = max(1, (1 << 15) // n), []
    for a in range(0, n - 1, block):
        x = sketch[a : a + block, None] ^ sketch[None, a + 1 :]
        differ = np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(2, dtype=np.int32)
        i, j = np.nonzero((differ <= most) & ~met[a : a + block, a + 1 :] & (np.arange(len(x))[:, None] <= np.arange(x.shape[1])[None]))
        found.append((differ[i, j].astype(np.int16), (i + a).astype(np.int32), (j + a + 1).astype(np.int32)))
    differ, i, j = map(np.concatenate, zip(*found, strict=True))
    order = np.argsort(differ, kind="stable")
    i, j, label, links = i[order], j[order], np.arange(n), []
    while len(i):
        for a, b in zip(i[:n].tolist(), j[:n].tolist(), strict=True):
            if label[a] != label[b] and likeness_of(a, b) >= least:
                links.append((a, b))
                label[label == label[b]] = label[a]
        i, j = i[n:], j[n:]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return links


def _links(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (u, v) that tie together what the pairs of each bucket would; ``members`` has ``bucket`` and ``node``.

    The rows of a bucket meet in one task with their shingles, so ``CROWD`` bounds what a task holds. Two members are compared
    in the first of the buckets that both are in.
    """
    lists = members.groupBy("node").agg(F.collect_list("bucket").alias("all"))
    rows = lists.join(sets, "node").select(F.explode("all").alias("bucket"), "node", "all", "shingle", "times", "sketch")

    def whole(batch: pa.RecordBatch, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The links of the buckets between these cuts of sorted rows."""
        bucket = batch.column("bucket").to_numpy()
        flat = {c: (batch.column(c).flatten().to_numpy(), np.append(0, np.cumsum(batch.column(c).value_lengths().to_numpy()))) for c in ("all", "shingle", "times", "sketch")}
        (every, each), (shingle, at), (times, _) = flat["all"], flat["shingle"], flat["times"]
        sketch = flat["sketch"][0].view(np.uint64).reshape(-1, WIDE)
        shingle = shingle.view(np.uint64)
        left, right = [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            owner, others = np.repeat(np.arange(b - a), np.diff(each[a : b + 1])), every[each[a] : each[b]]
            before = others < bucket[a]

            def alike(i: int, j: int) -> float:
                return likeness(*[(shingle[at[k] : at[k + 1]], times[at[k] : at[k + 1]]) for k in (a + i, a + j)])

            for i, j in _joined(sketch[a:b], _met(b - a, owner[before], others[before]), alike, least):
                left.append(a + i)
                right.append(a + j)
        node = batch.column("node")
        yield pa.RecordBatch.from_arrays([node.take(pa.array(x, pa.int64())) for x in (left, right)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # its end may go on in the next batch
        for batch in batches:
            batch = pa.concat_batches([last, batch]) if last is not None else batch
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(batch.column("bucket").to_numpy())) + 1])
            yield from whole(batch, cuts)
            last = batch.slice(cuts[-1])
        if last is not None and last.num_rows:
            yield from whole(last, np.array([0, last.num_rows]))

    return rows.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "u binary, v binary")


def _node(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def node_classes(docs: DataFrame, key: str, text: str, least: float = 0.8, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``node`` (digest of a text), ``key`` (the least of its documents), ``class_id`` and ``first`` (true for one of each class), one row per distinct text.

    The class is the least key among all documents that links of ``least`` or more tie together.
    """
    numbers = -(-bands * rows // 32)

    def start():
        memo = word_hashes()

        def banded(texts):
            found = [shingles(x, memo) for x in texts]
            won = signatures([x for x in found if len(x[0])], 32 * numbers)
            rows_ = iter(zip(buckets(won, bands, rows).tolist(), sketches(won).tolist(), strict=True))
            return zip(*[next(rows_) if len(x[0]) else ([], []) for x in found], strict=True)

        return banded

    given = docs.where(F.col(text).isNotNull()).select(_node(F.col(text)).alias("node"), F.col(key).alias("key"), F.col(text).alias("text"))
    signed = stage(map_texts(given, "text", ["node", "key"], "buckets array<bigint>, sketch array<bigint>", start))
    nodes = stage(signed.groupBy("node").agg(F.min("key").alias("key"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")))
    each = nodes.select("node", F.explode("buckets").alias("bucket"))
    sizes = each.groupBy("bucket").agg(F.count("*").alias("n"), *[F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (0, 1)]).where(F.col("n") > 1)
    # Of buckets with the same members one is enough.
    shared = sizes.groupBy("n", "x0", "x1").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = stage(each.join(shared, "bucket").select("bucket", "node", "n"))
    # Texts of the candidates only, one for each node. Copies are told apart by their key before they meet.
    doc = F.struct("node", "key").alias("doc")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(doc)
    texts = given.withColumn("doc", doc).join(wanted, "doc", "left_semi").dropDuplicates(["doc"]).select("node", "text")
    crowded = F.col("n") >= min(CROWD, TURNS**2)
    spread = members.where(crowded).select("bucket", "node")
    alone = spread.isEmpty()
    links = stage(_links(members.where(~crowded), _sets(texts if alone else (texts := stage(texts))), least))
    if not alone:
        tied = _spread(spread, nodes.select("node", "sketch"), numbers, texts, least)
        links = links.unionByName(tied.select(F.col("label").alias("u"), F.col("node").alias("v")))
    labels = components(links)

    named = nodes.select("node", "key").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least_key = named.groupBy("label").agg(F.min("key").alias("class_id"), F.min_by("node", F.struct(F.col("key").isNull(), "key", "node")).alias("first"))
    return named.join(least_key, "label").select("node", "key", "class_id", (F.col("node") == F.col("first")).alias("first"))


def _spread(members: DataFrame, sketched: DataFrame, numbers: int, texts: DataFrame, least: float) -> DataFrame:
    """``node`` and ``label``, its component, by the links of buckets whose members don't meet in one task."""
    # Each node first meets the leader with which it shares most buckets.
    led = members.join(members.groupBy("bucket").agg(F.min("node").alias("leader")), "bucket")
    star = led.where(F.col("node") != F.col("leader")).groupBy(F.col("leader").alias("u"), F.col("node").alias("v")).agg(F.count("*").alias("n"))
    nearest = stage(star.groupBy("v").agg(F.max_by("u", F.struct("n", "u")).alias("u")).select("u", "v"))
    labels = rooted(stage(_verify(nearest, texts, least)))
    return _remaining(members, labels, nearest, sketched, numbers, texts, least)


def classes(docs: DataFrame, key: str, text: str, **how) -> DataFrame:
    """``docs`` with ``class_id``; ``how`` goes to ``node_classes``."""
    found = node_classes(docs, key, text, **how)
    return docs.join(found, _node(docs[text]) == found["node"], "left").select(
        *[docs[c] for c in docs.columns], F.when(docs[text].isNull(), docs[key]).otherwise(found["class_id"]).alias("class_id"),
    )


def keep_one(docs: DataFrame, key: str, text: str, **how) -> DataFrame:
    """``docs`` without all but one of each class: the least key, then the least node; NULL texts stay."""
    chosen = node_classes(docs, key, text, **how).where("first")
    # A struct, because structs with a NULL inside are equal where bare NULLs are not.
    kept = chosen.select(F.struct("node", F.col("key").alias("key")).alias("_terrane_doc"))
    there = docs.where(F.col(text).isNotNull()).withColumn("_terrane_doc", F.struct(_node(F.col(text)).alias("node"), F.col(key).alias("key")))
    once = there.join(kept, "_terrane_doc", "left_semi").dropDuplicates(["_terrane_doc"]).drop("_terrane_doc")
    return once.unionByName(docs.where(F.col(text).isNull()))


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of a node; a node without links is one of its own."""
    return rows.join(labels.select(F.col("node").alias(node), F.col("label").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))


def _sets(texts: DataFrame) -> DataFrame:
    """``node``, its shingles, ``times`` that each occurs, and a sketch of ``32 * WIDE`` registers."""
    def start():
        memo = word_hashes()

        def listed(rows):
            found = [shingles(x, memo) for x in rows]
            wide = iter(sketches(signatures([x for x in found if len(x[0])], 32 * WIDE)).tolist())
            ends = pa.array(np.append(0, np.cumsum([len(s) for s, _ in found])), pa.int32())
            hashes, counts = (np.concatenate([x[k] for x in found]) if found else np.empty(0) for k in (0, 1))
            return pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())), [next(wide) if len(s) else [] for s, _ in found]

        return listed

    return map_texts(texts, "text", ["node"], "shingle array<bigint>, times array<bigint>, sketch array<bigint>", start)


def _shares(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node``, its shingles, the share of its weight that each has, and a sketch of ``32 * WIDE`` registers."""
    sets = _sets(texts.join(nodes, "node", "left_semi"))
    total = F.aggregate("times", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return sets.select("node", "shingle", F.transform("times", lambda x: x / total).alias("share"), "sketch")


def _prefixes(nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    return _rarest(stage(_shares(nodes, texts)), least)


def _rarest(shares: DataFrame, least: float) -> DataFrame:
    """``bucket`` (a shingle), ``node`` and ``before``: the rarest shingles of each node of ``shares`` that a second one has too.

    All shingles have one order, the rarest among these nodes first; ``before`` is the share of a node's weight that
    comes before this one. Of the shingles that two nodes share, take the first: neither shares what it has before it, and two
    nodes can't be alike by more than the share of either one that both have. So nodes alike by ``least`` meet at a shingle
    before which each has ``1 - least`` of its weight at most. Shingles are counted in a shuffle by themselves,
    combined on the map side; only the order within one text is made in one task.
    """
    each = shares.select("node", F.explode(F.arrays_zip("shingle", "share")).alias("x")).select("node", "x.shingle", "x.share")
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    ranked = each.join(often, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    earlier = Window.partitionBy("node").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    first = ranked.withColumn("before", F.coalesce(F.sum("share").over(earlier), F.lit(0.0)))
    return first.where((F.col("n") > 1) & (F.col("before") <= F.lit(1 - least + 1e-9))).select(F.col("shingle").alias("bucket"), "node", "before")


def _within(p: Column, q: Column, least: float) -> Column:
    """False if nodes that do not share p and q of their weight can't be alike by ``least``.

    Whatever the shared shingles are, the likeness is at most (1 - p)(1 - q) / (1 - pq).
    """
    return (1 - p) * (1 - q) >= F.lit(least) * (1 - p * q) - F.lit(1e-9)


def _possible(members: DataFrame, labels: DataFrame, sketched: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """``bucket``, ``node``, ``before``, ``earlier`` and ``sketch`` of the members that may be alike to another one of their bucket.

    Buckets of ``CROWD`` components or more, or with ``APART`` members or more outside the largest, are split: their nodes
    meet at their rarest shingles instead (see ``_rarest``), where every pair that is alike by ``least`` still meets, and a
    node leaves a shingle if the share it has before it and the least one there rule it out. ``earlier`` has the first
    shingles of a node's prefix that come before this one, ``EARLIER`` at most: two nodes that have one of them in common
    have met there, so they are compared at the first shingle they share, not at each. In the other buckets that share
    counts as nothing. A family of texts that all lie a little under ``least`` so leaves without a comparison of its members.
    """
    sizes = _labelled(members, labels, "node", "label").groupBy("bucket", "label").agg(F.count("*").alias("n"))
    apart = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), (F.sum("n") - F.max("n")).alias("outside"))
    crowded = stage(apart.where((F.col("parts") >= CROWD) | (F.col("outside") >= APART)).select("bucket"))
    there = members.join(crowded, "bucket", "left_semi").select("node").distinct()
    shares = stage(_shares(there, texts))
    order = Window.partitionBy("node").orderBy("before")
    nth = _rarest(shares, least).withColumn("nth", F.row_number().over(order))
    earlier = F.collect_list(F.when(F.col("nth") <= EARLIER, F.col("bucket"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    met = stage(nth.withColumn("earlier", earlier).drop("nth"))
    least_there = met.groupBy("bucket").agg(F.min("before").alias("least_before"), F.count("*").alias("n")).where(F.col("n") > 1)
    stays = met.join(least_there, "bucket").where(_within(F.col("before"), F.col("least_before"), least)).join(shares, "node")
    others = members.join(crowded, "bucket", "left_anti").join(sketched, "node").withColumn("before", F.lit(0.0)).withColumn("earlier", F.array().cast("array<bigint>"))
    columns = ["bucket", "node", "before", "earlier", "sketch"]
    return stage(stays.select(columns).unionByName(others.select(columns)))


def _meet(mixed: DataFrame, leaders: DataFrame, numbers: int, least: float) -> DataFrame:
    """The pairs (u, v) of a leader and a member of another component of its bucket that may be alike.

    Of two members outside the largest component the lesser one is the leader, and neither a shingle before this
    one brought them together: rows of split buckets name each pair once, those of the others once a bucket.
    """
    of_main = (F.col("label") == F.col("main")) | (F.col("a") == F.col("main"))
    once = (of_main | (F.col("u") < F.col("node"))) & ~F.arrays_overlap("e", "earlier")
    # The members of one bucket have sketches of one size.
    alike = F.when(F.size("b") == numbers, _may_be_alike("b", "sketch", numbers, least)).otherwise(_may_be_alike("b", "sketch", WIDE, least))
    found = mixed.join(leaders, "bucket").where((F.col("a") != F.col("label")) & _within(F.col("p"), F.col("before"), least) & alike & once)
    return found.select(F.least("u", "node").alias("u"), F.greatest("u", "node").alias("v"))


def _first(members: DataFrame, most: int, *order: Column) -> DataFrame:
    """The first ``most`` of ``members`` in each bucket, with their place ``nth`` and the names that ``_meet`` gives to leaders."""
    nth = members.withColumn("nth", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).where(F.col("nth") <= most)
    return nth.select("bucket", F.col("node").alias("u"), F.col("label").alias("a"), F.col("sketch").alias("b"), F.col("before").alias("p"), F.col("earlier").alias("e"), "nth")


def _remaining(members: DataFrame, labels: DataFrame, tested: DataFrame, sketched: DataFrame, numbers: int, texts: DataFrame, least: float) -> DataFrame:
    """Compare what is outside the largest component of its bucket with the members of other components.

    Each round takes some such members of every bucket, ``TURNS`` at first and eight times as many in each further
    round, ``LEADERS`` at most; what is in one component needs no comparison any more. Components only ever join, so once
    every member outside has had its turn, any two members of one bucket are in one component or have been compared. A
    member that has had its turn has met all of its bucket and meets nobody again, and of two members outside, the lesser
    one meets the other. While a bucket has more members outside than have their turn, rounds come first in which
    those outside meet members of the largest component, drawn by a hash, as many as ``TIES`` says: most that belong
    to a large group join it by a few comparisons each, and have no turn any more. Shares of weight that can't be shared and
    registers that differ too often rule a pair out while the bucket's members meet; the texts of the others are compared.
    """
    members = _possible(members, labels, sketched, texts, least)
    known, most, ties = tested, min(LEADERS, TURNS), list(TIES)
    while True:
        placed = _labelled(members, labels, "node", "label")
        sizes = placed.groupBy("bucket", "label").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts")).where(F.col("parts") > 1)
        mixed = stage(placed.join(largest, "bucket").select("bucket", "node", "before", "earlier", "label", "main", "sketch"))
        outside = mixed.where(F.col("label") != F.col("main"))
        turns = stage(_first(outside, most + 1, F.col("node")))
        more = not turns.where(F.col("nth") > most).isEmpty()
        tying = ties.pop(0) if more and ties else 0
        drawn = F.xxhash64("node", F.lit(tying))
        leaders = stage(_first(mixed.where(F.col("label") == F.col("main")), tying, drawn, F.col("node"))) if tying else turns.where(F.col("nth") <= most)
        pairs = _meet(mixed, leaders, numbers, least).distinct()
        pairs = stage(pairs.join(known, ["u", "v"], "left_anti"))
        links = stage(_verify(pairs, texts, least))
        if not links.isEmpty():
            crossing = _labelled(_labelled(links, labels, "u", "a"), labels, "v", "b").select(F.col("a").alias("u"), F.col("b").alias("v"))
            moved = components(crossing).select(F.col("node").alias("label"), F.col("label").alias("to"))
            # The nodes of a component that joins another move with it, its root as well.
            everyone = labels.unionByName(moved.select(F.col("label").alias("node"), "label"))
            labels = stage(everyone.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))
        if not more:
            return labels
        known = stage(known.unionByName(pairs))
        # A bucket that is in one component stays so: only the others go on, without those that have had their turn.
        members = mixed.drop("label", "main")
        if not tying:
            members, most = members.join(leaders.select("bucket", F.col("u").alias("node")), ["bucket", "node"], "left_anti"), min(LEADERS, 8 * most)
