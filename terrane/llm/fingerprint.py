"""Document fingerprints by one-permutation MinHash with optimal densification, in built-in expressions.

Each shingle of ``SHINGLE`` words is hashed once; the top bits of the hash name one of ``bins`` bins, and a
bin keeps its least hash. An empty bin takes the value of another: a hash of its own number fixes, for
all texts alike, the order in which it tries all bins until one is not empty. The low ``BITS`` bits of the
values, packed as hex digits, are the fingerprint. Two unlike bins agree by chance once in 2^BITS, and
the likeness of two fingerprints is corrected for that.

Words are what white space separates, in lower case. Edge cases: a text of fewer than ``SHINGLE`` words
has one shingle of all its words; NULL and empty texts and those of white space have one empty shingle,
so they are equal to each other and like nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE, BINS, BITS = 5, 128, 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " ")), " ")


def shingles(text: Column) -> Column:
    """One hash per run of ``SHINGLE`` words."""
    return _let(words(text), lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, SHINGLE)),
    ))


def _bin(value: Column, bins: int) -> Column:
    return F.shiftrightunsigned(value, 65 - bins.bit_length()).cast("int")


def _densified(value: Column, bins: int) -> Column:
    """``value`` (one or NULL per bin, not all NULL) with each NULL replaced by the first bin tried.

    Bin i tries the bins from a hashed start in hashed odd steps, which meets every bin once.
    """
    def tried(i: Column, s: Column | int) -> Column:
        start, step = F.xxhash64(i, F.lit(1)), F.shiftleft(F.xxhash64(i, F.lit(2)).bitwiseAND(F.lit(bins - 1)), 1) + 1
        return F.get(value, (start.bitwiseAND(F.lit(bins - 1)) + step * s).bitwiseAND(F.lit(bins - 1)).cast("int"))

    def rest(i: Column) -> Column:
        return F.get(F.filter(F.transform(F.sequence(F.lit(6), F.lit(bins - 1)), lambda s: tried(i, s)), lambda x: x.isNotNull()), F.lit(0))

    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.get(value, i), *[tried(i, F.lit(s)) for s in range(6)], rest(i)))


def fingerprint(text: Column, bins: int = BINS) -> Column:
    """Hex digits of the packed low bits of all bins, two a bin. ``bins`` is a power of two."""
    def firsts(ordered: Column) -> Column:
        return F.filter(ordered, lambda h, i: (i == 0) | (_bin(h, bins) != _bin(F.get(ordered, i - 1), bins)))

    def by_bin(least: Column) -> Column:
        named = F.map_from_arrays(F.transform(least, lambda h: _bin(h, bins)), least)
        return _let(named, lambda m: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.try_element_at(m, i)))

    def packed(value: Column) -> Column:
        return F.lower(F.array_join(F.transform(_densified(value, bins), lambda h: F.lpad(F.hex(h.bitwiseAND(F.lit(255))), 2, "0")), ""))

    return _let(F.sort_array(shingles(text)), lambda s: _let(firsts(s), lambda x: _let(by_bin(x), packed)))


def likeness(a: Column, b: Column, bins: int = BINS) -> Column:
    """Estimated Jaccard likeness, 0 to 1, of the shingles behind two fingerprints."""
    places = F.sequence(F.lit(1), F.lit(2 * bins - 1), F.lit(2))
    agree = F.size(F.filter(places, lambda i: F.substring(a, i, 2) == F.substring(b, i, 2))) / F.lit(float(bins))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))


def _bucket(key: Column, bounds: list, low: int = 0) -> Column:
    """How many of the ascending ``bounds`` lie below the key, by bisection."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key <= F.lit(bounds[mid]), _bucket(key, bounds[:mid], low)).otherwise(_bucket(key, bounds[mid + 1:], low + mid + 1))


def with_next(rows: DataFrame, key: str, tie: Column, carried: dict[str, str], buckets: int) -> DataFrame:
    """``rows`` with columns of the next row in descending order of ``key``; after the last comes the first.

    The key's approximate quantiles, which are keys themselves, cut the order into ``buckets`` ranges,
    each sorted in one task. The row at a range's end is sent to the range before it too, so no order of
    all rows is needed. NULL keys come last; equal keys are ordered by ``tie``. If all keys are NULL, the
    last row has no next one.
    """
    edges = rows.agg(F.percentile_approx(key, [(i + 1) / buckets for i in range(buckets - 1)], 10_000), F.max(key)).first()
    top = edges[1]
    bounds = sorted({x for x in edges[0] or [] if x is not None and x != top})
    place, mine = _bucket(F.col(key), bounds), F.coalesce(F.col(key), F.lit(bounds[0] if bounds else top))
    copies = [
        F.struct(F.when(F.col(key).isNull(), F.lit(0)).otherwise(place).alias("at"), F.lit(False).alias("ghost")),
        # The row on the upper edge of a range follows the range above.
        F.when(mine.isin(bounds) & F.col(key).isNotNull(), F.struct((place + 1).alias("at"), F.lit(True).alias("ghost"))) if bounds else None,
        F.when(F.col(key) == F.lit(top), F.struct(F.lit(0).alias("at"), F.lit(True).alias("ghost"))) if top is not None else None,
    ]
    spread = rows.withColumn("_copy", F.explode(F.filter(F.array(*[c for c in copies if c is not None]), lambda c: c.isNotNull())))
    order = Window.partitionBy("_copy.at").orderBy(F.col("_copy.ghost"), F.col(key).desc_nulls_last(), tie)
    return spread.select("*", *[F.lead(c).over(order).alias(name) for c, name in carried.items()]).where(~F.col("_copy.ghost")).drop("_copy")


def fingerprints_with_edits(docs: DataFrame, key: str, text: str, bins: int = BINS, buckets: int | None = None) -> DataFrame:
    """Fingerprint of each text and of its edited text: its last third replaced by as much of the next text.

    Columns: the key, n_chars, edited (the text), fingerprint, edited_fingerprint, near_edited, near_next.
    """
    buckets = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_print", fingerprint(F.col("_text"), bins))
    paired = with_next(rows, key, F.xxhash64("_text"), {"_text": "_next_text", "_print": "_next_print"}, buckets)
    n = F.char_length("_text")
    m = F.floor(n / 3).cast("int")
    edited = F.concat(F.left(F.col("_text"), n - m), F.left(F.coalesce(F.col("_next_text"), F.lit("")), m))
    return (
        paired.select(key, n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("_print").alias("fingerprint"), "_next_print")
        .withColumn("edited_fingerprint", fingerprint(F.col("edited"), bins))
        .withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint"), bins))
        .withColumn("near_next", F.coalesce(likeness(F.col("fingerprint"), F.col("_next_print"), bins), F.lit(0.0)))
        .drop("_next_print")
    )
