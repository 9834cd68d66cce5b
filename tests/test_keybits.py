import random

import pytest
from pyspark.sql import functions as F

from terrane import operators as ops
from terrane.operators import keybits
from terrane.plans import silver
from terrane.plans.known import KnownKeys

from .helpers import rows, ts

TABLE = "silver.seen"


def keys_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_bits_are_those_of_the_hashes(spark):
    known = keys_of(spark, [f"k{n}" for n in range(500)] * 2 + [None])
    slots = 4 * keybits.BUCKET_SLOTS
    want = {r[0] for r in known.where("k IS NOT NULL").select(F.pmod(F.xxhash64("k"), F.lit(slots))).collect()}
    have = set()
    for bucket, bits in ops.key_bits(known, ["k"], slots).collect():
        have |= {bucket * keybits.BUCKET_SLOTS + 8 * i + j for i, byte in enumerate(bits) for j in range(8) if byte >> j & 1}
    assert have == want


def test_marks_are_those_of_the_slots(spark):
    known, asked = [f"k{n}" for n in range(3000)], [f"q{n}" for n in range(5000)] + ["k7", None]
    slots = keybits.BUCKET_SLOTS
    taken = {r[0] for r in keys_of(spark, known).select(F.pmod(F.xxhash64("k"), F.lit(slots))).collect()}
    marked = ops.mark_possible(keys_of(spark, asked), ["k"], ops.key_bits(keys_of(spark, known), ["k"], slots), slots)
    found = marked.withColumn("slot", F.pmod(F.xxhash64("k"), F.lit(slots))).collect()
    assert len(found) == len(asked)
    assert all(r["_possible"] == (r["k"] is not None and r["slot"] in taken) for r in found)
    hits = sum(r["_possible"] for r in found)
    assert 1 < hits < 1000


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_the_anti_join_with_forced_collisions(spark, seed):
    """One bucket for up to 30,000 keys: a good half of the new keys meets a set bit."""
    rand = random.Random(seed)
    known = [f"a{rand.randrange(40_000)}" for _ in range(30_000)] + [None]
    asked = [f"a{rand.randrange(80_000)}" for _ in range(4_000)] + [None, None]
    target, df = keys_of(spark, known), keys_of(spark, asked).withColumn("x", F.lit(1))
    slots = keybits.BUCKET_SLOTS
    bits = ops.key_bits(target, ["k"], slots)
    false = ops.mark_possible(df, ["k"], bits, slots).where("_possible").join(target, "k", "left_anti").count()
    assert false > 200
    assert sorted(map(str, rows(ops.new_rows_by_bits(df, target, ["k"], bits, slots)))) == sorted(map(str, rows(ops.new_rows_only(df, target, ["k"]))))


def test_several_keys_notes_of_many_batches_and_empty_tables(frame):
    target = frame("a int, b string", *[(n, str(n % 3)) for n in range(50)], (None, "0"))
    df = frame("b string, a int, v int", ("0", 3, 1), ("1", 3, 2), ("0", None, 3), ("0", 3, 4))
    slots = ops.slots_for(51)
    parts = [ops.key_bits(target.where(F.col("a") % 2 == n), ["a", "b"], slots) for n in (0, 1)]
    found = ops.new_rows_by_bits(df, target, ["a", "b"], parts[0].unionByName(parts[1]), slots)
    assert sorted(r["v"] for r in found.collect()) == [2, 3]
    none = target.where("false")
    assert ops.new_rows_by_bits(df, none, ["a", "b"], ops.key_bits(none, ["a", "b"], slots), slots).count() == 4
    assert ops.new_rows_by_bits(df.where("false"), target, ["a", "b"], parts[0], slots).count() == 0


def test_a_table_without_a_possible_key_is_not_read(spark):
    known = keys_of(spark, ["a", "b"])
    slots = ops.slots_for(2)
    broken = known.withColumn("k", F.raise_error(F.lit("read")).cast("string"))
    asked = keys_of(spark, ["c", "d"])
    assert ops.new_rows_by_bits(asked, broken, ["k"], ops.key_bits(known, ["k"], slots), slots).count() == 2


def test_kept_bits_grow_with_the_table(lake, frame, monkeypatch):
    monkeypatch.setattr(KnownKeys, "MOST_NOTES", 3)
    known, want = KnownKeys(lake, TABLE, ["k"]), set()
    lake.append(TABLE, frame("k string", ("k0",)))
    for batch in range(6):
        came = frame("k string", *[(f"k{n}",) for n in range(batch * 5, batch * 5 + 9)])
        new = known.new_rows(came)
        expected = rows(ops.new_rows_only(came, lake.load(TABLE), ["k"]))
        assert rows(new) == expected
        known.append(frame("k string", *expected))
        want |= {k for k, in expected}
    assert lake.load(TABLE).count() == len(want) + 1
    assert lake.load(known.bits_table).where("bucket = -1").count() <= 5
    assert known.new_rows(lake.load(TABLE)).count() == 0


def test_rebuilt_after_a_failed_append_and_after_rows_written_by_another_way(lake, frame, monkeypatch):
    known = KnownKeys(lake, TABLE, ["k"])
    lake.append(TABLE, frame("k string", ("a",)))
    known.append(frame("k string", ("b",)))
    append = lake.append

    def fails(table, df):
        if table == TABLE:
            raise OSError("disk")
        append(table, df)

    with monkeypatch.context() as m:
        m.setattr(lake, "append", fails)
        with pytest.raises(OSError, match="disk"):
            known.append(frame("k string", ("c",)))
    # The bits of c are there, its row is not: c is still new, and the bits are made anew.
    assert rows(known.new_rows(frame("k string", ("a",), ("b",), ("c",)))) == [("c",)]
    assert rows(lake.load(known.bits_table).where("bucket = -1").select("known")) == [(2,)]
    lake.append(TABLE, frame("k string", ("z",)))
    assert rows(known.new_rows(frame("k string", ("z",), ("y",)))) == [("y",)]


def test_refresh_with_bits_equals_the_one_without(lake, frame):
    schema = "transaction_id string, event_ts timestamp, ingestion_ts timestamp, customer_id string, product_id string, quantity_purchased int, unit_price_at_sale double"
    links, made = frame("product_id string, anime_id string", ("p1", "a1")), {}
    for sent in (range(8), range(5, 12), range(12)):
        lake.append(silver.SALES, frame(schema, *[(f"t{n}", ts(f"2024-01-01 10:{n:02d}"), ts(f"2024-01-01 11:{n:02d}"), "c", f"p{n % 3}", 1, 2.0) for n in sent]))
        for bits in (False, True):
            table = f"silver.sales_{bits}".lower()
            lake.create(table, lake.tables["silver.silver_pos_transactions_clean"])
            silver.refresh_transactions(lake, silver.SALES, table, "transaction_id", "product_id", "transaction_ts", links, bits=bits)
            made[bits] = rows(lake.load(table))
        assert made[True] == made[False]
    assert len(made[True]) == 12
