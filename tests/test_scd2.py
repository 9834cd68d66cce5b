import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrane import operators as ops
from terrane.functions import row_hash

from .helpers import rows, ts

DIM = (
    "id string, price double, tag string, effective_start_date timestamp, effective_end_date timestamp,"
    " is_current boolean"
)
NEW = "id string, price double, tag string, effective_start_date timestamp"
TRACKED = ["price", "tag"]
d0, d1, d2, d3 = (ts(f"2024-01-0{n} 00:00:00") for n in (1, 2, 3, 4))


@pytest.fixture
def dim(frame):
    return frame(
        DIM,
        ("p0", 0.5, None, d0, d1, False),
        ("p1", 1.0, None, d1, None, True),
        ("p2", 2.0, "x", d1, None, True),
        ("p3", 3.0, "z", d1, None, True),
    )


@pytest.fixture
def incoming(frame):
    return frame(NEW, ("p1", 1.0, None, d2), ("p2", 2.5, "x", d2), ("p4", 9.0, "n", d2), (None, 1.0, "q", d2))


EXPECTED = [
    ("p0", 0.5, None, d0, d1, False),
    ("p1", 1.0, None, d1, None, True),
    ("p2", 2.0, "x", d1, d2, False),
    ("p2", 2.5, "x", d2, None, True),
    ("p3", 3.0, "z", d1, None, True),
    ("p4", 9.0, "n", d2, None, True),
]


def invariants(df):
    """At most one current row per key and no overlap between the versions of a key."""
    by_key = {}
    for r in df.collect():
        assert r.id is not None
        by_key.setdefault(r.id, []).append(r)
    for versions in by_key.values():
        assert sum(v.is_current for v in versions) <= 1
        versions.sort(key=lambda v: v.effective_start_date)
        for first, second in zip(versions, versions[1:]):
            assert first.effective_end_date is not None
            assert first.effective_end_date <= second.effective_start_date


def test_incremental_form(dim, incoming):
    changes = ops.scd2_apply(dim, incoming, "id", TRACKED)
    assert rows(changes, "id", "scd_action") == [("p2", "add"), ("p2", "close"), ("p4", "add")]
    merged = ops.scd2_merge(dim, changes, "id")
    assert rows(merged) == EXPECTED
    invariants(merged)
    assert ops.scd2_apply(merged, incoming, "id", TRACKED).isEmpty()


def test_late_version_is_set_aside(dim, frame):
    older = frame(NEW, ("p2", 7.0, "x", d0), ("p3", 3.0, "z", d0), ("p1", 8.0, None, d1))
    changes = ops.scd2_apply(dim, older, "id", TRACKED)
    assert rows(changes, "id", "scd_action") == [("p1", "late"), ("p2", "late")]
    assert rows(ops.scd2_merge(dim, changes, "id")) == rows(dim)


def test_open_end_is_a_parameter(dim, incoming):
    cols = ops.Scd2Columns(open_end="9999-12-31 23:59:59")
    added = ops.scd2_apply(dim, incoming, "id", TRACKED, cols).where("scd_action = 'add'")
    assert {r.effective_end_date for r in added.collect()} == {ts("9999-12-31 23:59:59")}


def test_snapshot_form(dim, incoming):
    once = ops.scd2_snapshot(dim, incoming, "id", TRACKED, d3)
    assert rows(once) == EXPECTED
    invariants(once)
    assert rows(ops.scd2_snapshot(once, incoming, "id", TRACKED, d3)) == EXPECTED


def test_snapshot_may_close_missing_keys(dim, incoming):
    closed = ops.scd2_snapshot(dim, incoming, "id", TRACKED, d3, on_missing="close")
    assert ("p3", 3.0, "z", d1, d3, False) in rows(closed)
    assert len(rows(closed)) == len(EXPECTED)
    with pytest.raises(ValueError):
        ops.scd2_snapshot(dim, incoming, "id", TRACKED, d3, on_missing="drop")


def test_snapshot_change_without_a_later_start_begins_at_as_of(dim, frame):
    result = ops.scd2_snapshot(dim, frame(NEW, ("p1", 1.5, None, d1)), "id", TRACKED, d3)
    assert [r for r in rows(result) if r[0] == "p1"] == [
        ("p1", 1.0, None, d1, d3, False), ("p1", 1.5, None, d3, None, True),
    ]


def test_snapshot_plans_its_join_once(dim, incoming):
    plan = ops.scd2_snapshot(dim, incoming, "id", TRACKED, d3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1


def test_first_load(spark, incoming):
    empty = spark.createDataFrame([], DIM)
    assert len(rows(ops.scd2_snapshot(empty, incoming, "id", TRACKED, d3))) == 3
    assert rows(ops.scd2_apply(empty, incoming, "id", TRACKED), "scd_action") == [("add",)] * 3


states = st.lists(
    st.tuples(st.sampled_from("abc"), st.sampled_from([1.0, 2.0, None]), st.integers(1, 9)),
    min_size=1, max_size=3, unique_by=lambda r: r[0],
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(states, min_size=1, max_size=3))
def test_any_sequence_keeps_the_invariants(spark, sequence):
    dim = spark.createDataFrame([], DIM)
    for state in sequence:
        incoming = spark.createDataFrame([(k, p, "t", ts(f"2024-02-0{d} 00:00:00")) for k, p, d in state], NEW)
        before = rows(dim.where("not is_current"))
        once = ops.scd2_merge(dim, ops.scd2_apply(dim, incoming, "id", TRACKED), "id")
        assert rows(ops.scd2_merge(once, ops.scd2_apply(once, incoming, "id", TRACKED), "id")) == rows(once)
        invariants(once)
        dim = spark.createDataFrame(once.collect(), DIM)
        assert set(before) <= set(rows(dim.where("not is_current")))


def test_hash_forms(frame):
    schema = "id string, tag string, effective_start_date timestamp, effective_end_date timestamp, is_current boolean"
    target = frame(schema, ("a", "x", d0, None, True), ("b", None, d0, None, True)).withColumn(
        "record_hash", row_hash(["id", "tag"])
    )
    incoming = frame(
        schema, ("a", "x", d0, d1, False), ("a", "y", d1, None, True), ("b", "", d0, None, True)
    )
    args = ("id", ["id", "tag"])
    assert rows(ops.hash_diff_append(target, incoming, *args, "effective_start_date"), "id", "tag") == [("a", "y")]
    assert rows(ops.closure_updates(target, incoming, *args), "id", "effective_end_date") == [("a", d1)]
    refreshed = ops.hash_diff_refresh(target, incoming, *args)
    assert rows(refreshed, "id", "tag", "is_current") == [("a", "x", False), ("a", "y", True), ("b", "", True)]
    assert ops.hash_diff_append(refreshed, incoming, *args, "effective_start_date").isEmpty()


def test_a_version_of_unknown_start_can_be_followed(frame):
    schema = "id string, v string, effective_start_date timestamp"
    dim = frame(f"{schema}, effective_end_date timestamp, is_current boolean", ("k", "old", None, None, True))
    new = frame(schema, ("k", "new", ts("2024-01-01 00:00:00")))
    merged = ops.scd2_merge(dim, ops.scd2_apply(dim, new, "id", ["v"]), "id")
    assert {(r.v, r.is_current) for r in merged.collect()} == {("old", False), ("new", True)}
    history = ops.scd2_history(dim.select("id", "v", "effective_start_date").unionByName(new), "id", ["v"])
    assert {(r.v, r.is_current) for r in history.collect()} == {("old", False), ("new", True)}


def test_hash_does_not_depend_on_the_zone(spark, frame):
    versions = frame("id string, at timestamp", ("k", ts("2024-01-01 00:00:00")))
    before, found = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.add(ops.scd2.with_row_hash(versions, ["id", "at"]).first().record_hash)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(found) == 1
