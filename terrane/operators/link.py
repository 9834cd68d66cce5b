"""Linking of free-form keys or texts to a catalogue by normalised containment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalized
from ..sources.scratch import stage, stage_measured

# A lookup side is broadcast only when both limits hold; beyond them the joins shuffle, salted.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

# Characters of normalised text, roughly from rare to common in prose; any order gives the same links.
RARE_FIRST = "0123456789xqjwkzyvbfpghmcduloatrsine"


def link_entities(
    facts: DataFrame,
    fact_key: str,
    lookup: DataFrame,
    lookup_id: str,
    lookup_text: str,
    min_len: int = 1,
    text: str | None = None,
    gram: int = 16,
    salts: int = 8,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    block: int = 4096,
) -> DataFrame:
    """Best catalogue entry per fact key: columns ``fact_key``, ``lookup_id``; unlinked keys are absent.

    A fact links to a title when its normalised text contains the normalised title, which must have
    at least ``min_len`` characters (an empty title never matches). Of several titles the one that
    sorts last wins; of equal titles the smallest ``lookup_id``. The fact text is ``fact_key``
    itself, or the column ``text``, in which case ``fact_key`` must identify a row.

    Containment is turned into equi-joins. A title can only start where the fact text has the
    title's first characters, its probe. So: cut the fact text at every position into probe-sized
    grams, look the gram up to learn which title lengths may start there, cut out pieces of
    exactly those lengths and look the pieces up among the titles. Work and rows per position are
    bounded by the number of distinct title lengths, never by how many titles share a probe, and
    a piece that is found is a match without further checks. Titles shorter than ``gram`` go
    through the same steps in classes of doubling length, each with its own shorter probe.

    A text is normalised once and cut into blocks of ``block`` characters, each with as much of what follows
    as the longest title needs, so a place is looked at in its block and work grows with the length.
    """
    # Read several times below, so computed once; its measures decide how it is joined.
    size = F.length("_title")
    lows = [1 << k for k in range(gram.bit_length()) if 1 << k < gram] + [gram]
    ranges = list(zip(lows, [*lows[1:], 1 << 31], strict=True))
    titles, stats = stage_measured(
        lookup.select(normalized(lookup_text).alias("_title"), F.col(lookup_id))
        .where(size >= max(min_len, 1))
        .groupBy("_title")
        .agg(F.min(lookup_id).alias(lookup_id)),
        {
            "rows": F.count("*"),
            "chars": F.sum(size),
            "longest": F.max(size),
            **{f"from {low}": F.min(F.when((size >= low) & (size < high), size)) for low, high in ranges},
        },
    )
    small = stats["rows"] <= broadcast_rows and (stats["chars"] or 0) <= broadcast_bytes
    classes = [
        (titles.where((size >= low) & (size < high)), stats[f"from {low}"] if low < gram else gram)
        for low, high in ranges if stats[f"from {low}"] is not None
    ] or [(titles, gram)]

    if text is None:
        keys = facts.select(fact_key).dropna().distinct()
        body = normalized(fact_key)
    else:
        keys = facts.select(fact_key, normalized(text).alias("_text")).dropna()
        keys = _blocks(_texts_with_anchor(keys, fact_key, F.col("_text"), classes, small, salts), fact_key, block, stats["longest"] or 1)
        body = F.col("_text")

    unit = [fact_key] if text is None else [fact_key, "_block"]

    def pieces(part: DataFrame, probe: int) -> DataFrame:
        """(fact_key, _piece) for each place where a title of ``part`` may start."""
        lengths = part.groupBy(F.xxhash64(F.substring("_title", 1, probe)).alias("_probe")).agg(
            F.collect_set(size).alias("_lengths")
        )
        cuts = F.regexp_extract_all(body, F.lit(f"(?=(.{{{probe}}}))"), F.lit(1))
        grams = keys.select(*unit, F.posexplode(cuts).alias("_at", "_gram")).select(
            *unit, "_at", F.xxhash64("_gram").alias("_probe")
        )
        places = _lookup_join(grams, lengths, "_probe", small, salts, [*unit, "_at"]).select(
            *unit, "_at", F.explode("_lengths").alias("_len")
        )
        if text is not None:
            places = places.join(keys, on=unit)
        piece = F.substring(body, F.col("_at") + 1, F.col("_len"))
        return places.select(fact_key, piece.alias("_title"))

    found = reduce(DataFrame.unionByName, [pieces(part, probe) for part, probe in classes])
    return (
        _lookup_join(found, titles, "_title", small, salts, [fact_key])
        .groupBy(fact_key)
        .agg(F.max_by(lookup_id, "_title").alias(lookup_id))
    )


def _blocks(keys: DataFrame, fact_key: str, block: int, longest: int) -> DataFrame:
    """Staged blocks of normalised texts; each has its successors' beginning, one short of the longest title."""
    block = max(block, longest)
    cut = F.regexp_extract_all("_text", F.lit(f"(.{{1,{block}}})"), F.lit(1))
    parts = keys.select(fact_key, F.transform(F.array(cut), lambda x: F.transform(
        x, lambda part, i: F.concat(part, F.coalesce(F.left(F.get(x, i + 1), F.lit(longest - 1)), F.lit(""))),
    ))[0].alias("_parts"))
    return stage(parts.select(fact_key, F.posexplode("_parts").alias("_block", "_text")))


def _texts_with_anchor(
    keys: DataFrame, fact_key: str, body: Column, classes: list[tuple[DataFrame, int]], small: bool, salts: int
) -> DataFrame:
    """The texts that may contain a title, as a staged table: a cheap test before the exact search.

    Cutting every position of a long text is costly, and its text must not travel with the grams.
    A text that contains a title contains each of the title's grams, also the one that starts at
    the title's rarest letter, its anchor. So only the grams that start with an anchor letter are
    cut and looked up. The ids found are few and are staged, so the planner knows their size when
    they select the texts.
    """
    found = []
    for part, probe in classes:
        starts = F.substring("_title", F.lit(1), F.length("_title") - (probe - 1))
        at = F.coalesce(*[F.nullif(F.instr(starts, letter), F.lit(0)) for letter in RARE_FIRST])
        anchors = part.select(F.substring("_title", at, F.lit(probe)).alias("_gram"))
        letters = anchors.agg(F.array_sort(F.collect_set(F.substring("_gram", 1, 1)))).first()[0]
        start = "".join(letters) or "a"
        cuts = F.regexp_extract_all(body, F.lit(f"(?=([{start}].{{{probe - 1}}}))"), F.lit(1))
        grams = keys.select(fact_key, F.explode(cuts).alias("_gram"))
        hashed = grams.select(fact_key, F.xxhash64("_gram").alias("_probe"))
        probes = anchors.select(F.xxhash64("_gram").alias("_probe")).distinct()
        found.append(_lookup_join(hashed, probes, "_probe", small, salts, [fact_key]).select(fact_key))
    ids = stage(reduce(DataFrame.unionByName, found).distinct())
    return stage(keys.join(ids, on=fact_key, how="left_semi"))


def _lookup_join(
    rows: DataFrame, lookup: DataFrame, on: str, small: bool, salts: int, spread_by: list[str]
) -> DataFrame:
    """Inner join with a side unique per ``on``: broadcast when small, else salted against hot values."""
    if small:
        return rows.join(F.broadcast(lookup), on=on)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, on=[on, "_salt"]).drop("_salt")
