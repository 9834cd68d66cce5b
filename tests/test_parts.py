"""Facts partitioned by date: only touched dates are rewritten, filters prune, results equal a whole publish."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from terrane.operators import replace_by_key
from terrane.plans import gold
from terrane.schemas import TABLES
from terrane.sources import Lake

from .helpers import rows, ts

FACTS = "gold.fact_screenings"


def day(n):
    return None if n is None else datetime.date(2024, 1, 1) + datetime.timedelta(n)


def facts(frame, *given):
    return frame(TABLES[FACTS], *[(i, s, "a", day(d), 1.0, c) for i, s, d, c in given])


def files(lake):
    """Partition value -> names of its files."""
    out = {}
    for r in lake.load(FACTS).select("calendar_date", F.input_file_name().alias("f")).distinct().collect():
        out.setdefault(r.calendar_date, set()).add(r.f)
    return out


def test_only_touched_dates_are_rewritten(lake, frame):
    lake.append(FACTS, facts(frame, *[(str(i), "s", i % 5 if i % 7 else None, 0.0) for i in range(70)]))
    before, old = files(lake), lake.load(FACTS).collect()
    assert set(before) == {day(d) for d in (0, 1, 2, 3, 4, None)}
    updates = facts(frame, ("1", "s", 1, 9.0), ("7", "s", None, 8.0), ("new", "s", 1, 7.0))
    assert sorted(lake.replace_rows(FACTS, updates, ["booking_id"]), key=str) == [day(1), None]
    after = files(lake)
    for d in before:
        assert (after[d] == before[d]) == (d not in (day(1), None))
    expected = replace_by_key(lake.spark.createDataFrame(old, TABLES[FACTS]), updates, ["booking_id"])
    assert rows(lake.load(FACTS)) == rows(expected)
    assert lake.replace_rows(FACTS, updates.limit(0), ["booking_id"]) == []
    assert files(lake) == after


def test_a_filter_on_the_date_prunes_also_through_a_join(lake, frame):
    lake.append(FACTS, facts(frame, *[(str(i), "s", i % 5, 0.0) for i in range(20)]))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    some = lake.load_parts(FACTS, [day(1), None])
    assert re.search(r"PartitionFilters: \[[^\]]*calendar_date", plan(some))
    assert {r.calendar_date for r in some.collect()} == {day(1)}
    other = frame("booking_id string, x int", ("1", 1))
    joined = lake.load(FACTS).join(other, "booking_id").where(F.col("calendar_date") == F.lit(day(1)))
    assert re.search(r"PartitionFilters: \[[^\]]*calendar_date", plan(joined))
    assert lake.load_parts(FACTS, []).isEmpty()


@pytest.mark.parametrize("buckets", [0, 3])
def test_random_refreshes_equal_whole_publishes(spark, tmp_path, frame, lake, buckets):
    lake = Lake(spark, str(tmp_path / "parts"), buckets=buckets)
    rng = random.Random(buckets)
    model = {str(i): (str(i), "s", i % 6 or None, 0.0) for i in range(40)}
    lake.append(FACTS, facts(frame, *model.values()))
    for step in range(3):
        changed = {k: (*model[k][:3], float(step + 1)) for k in rng.sample(sorted(model), 4)}
        model |= changed
        lake.replace_rows(FACTS, facts(frame, *changed.values()), ["booking_id"])
        assert rows(lake.load(FACTS)) == rows(facts(frame, *model.values()))
    lake.publish(FACTS, lake.load(FACTS).where("concession_revenue = 0"))
    assert rows(lake.load(FACTS)) == rows(facts(frame, *[m for m in model.values() if not m[3]]))
    lake.append(FACTS, facts(frame, ("x", "s", 2, 5.0)))
    assert lake.load(FACTS).count() == sum(not m[3] for m in model.values()) + 1


def test_late_concessions_touch_their_dates_only(lake, frame):
    book = lambda i, s, d: (i, ts(f"2024-01-0{d} 10:00:00"), "c", s, 1, 5.0, "a")
    lake.publish(gold.BOOKINGS, frame(TABLES[gold.BOOKINGS], book("1", "s1", 1), book("2", "s2", 2), book("3", "s1", 3)))
    lake.publish(gold.CONCESSIONS, frame(TABLES[gold.CONCESSIONS], ("s1", 1, 1.0), ("s2", 1, 2.0)))
    gold.refresh_fact_screenings(lake)
    before = files(lake)
    gold.refresh_fact_screenings(lake)
    assert files(lake) == before
    lake.publish(gold.CONCESSIONS, frame(TABLES[gold.CONCESSIONS], ("s1", 1, 1.0), ("s2", 2, 9.0)))
    gold.refresh_fact_screenings(lake)
    after = files(lake)
    assert {d for d in before if after[d] != before[d]} == {datetime.date(2024, 1, 2)}
    assert rows(lake.load(FACTS), "booking_id", "concession_revenue") == [("1", 1.0), ("2", 9.0), ("3", 1.0)]


def test_a_failed_refresh_leaves_the_table(lake, frame):
    lake.append(FACTS, facts(frame, ("1", "s", 1, 0.0), ("2", "s", 2, 0.0)))
    before = files(lake)
    broken = facts(frame, ("1", "s", 1, 1.0)).withColumn("ticket_revenue", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        lake.overwrite_parts(FACTS, broken)
    assert files(lake) == before
