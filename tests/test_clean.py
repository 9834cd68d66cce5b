from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrane import operators as ops

from .helpers import rows, ts

EVENTS = "id string, ingestion_ts timestamp, price double"
ten, later = ts("2024-01-01 10:00:00"), ts("2024-01-01 10:05:00")


def test_dedupe_keeps_latest_arrival_and_drops_null_keys(frame):
    df = frame(EVENTS, ("a", ten, 1.0), ("a", later, 2.0), ("b", ten, 3.0), (None, ten, 4.0))
    assert rows(ops.dedupe_latest(df, ["id"], ["ingestion_ts"]), "id", "price") == [("a", 2.0), ("b", 3.0)]


def test_dedupe_breaks_ties_by_the_other_columns_whatever_the_input_order(frame):
    data = [("a", ten, 1.0), ("a", ten, 7.0), ("a", ten, None)]
    for order in (data, data[::-1]):
        assert rows(ops.dedupe_latest(frame(EVENTS, *order), ["id"], ["ingestion_ts"]), "price") == [(7.0,)]


def test_dedupe_sends_one_row_per_key_and_task(frame):
    plan = ops.dedupe_latest(frame(EVENTS, ("a", ten, 1.0)), ["id"], ["ingestion_ts"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_latest_by_key_renames_its_clock(frame):
    df = frame(EVENTS, ("a", ten, 1.0), ("a", later, 2.0))
    latest = ops.latest_by_key(df, "id", "ingestion_ts", ts_as="last_update")
    assert latest.columns == ["id", "last_update", "price"]
    assert rows(latest, "price") == [(2.0,)]


def test_new_rows_only(frame):
    target, incoming = frame("k int, v string", (1, "a"), (2, "b")), frame("k int, v string", (2, "x"), (3, "y"))
    for small in (False, True):
        assert rows(ops.new_rows_only(incoming, target, ["k"], small)) == [(3, "y")]


def test_replace_by_key_and_twice(frame):
    target = frame("k int, v string", (1, "a"), (2, "b"))
    updates = frame("v string, k int", ("B", 2), ("C", 3))
    once = ops.replace_by_key(target, updates, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(ops.replace_by_key(once, updates, ["k"])) == rows(once)


def test_clean_transactions(frame):
    events = frame(
        "transaction_id string, event_ts timestamp, ingestion_ts timestamp, customer_id string,"
        " product_id string, quantity_purchased int, unit_price_at_sale double",
        ("1", ten, ten, "c", "p", 3, 14.99),
        ("1", ten, later, "c", "p", 4, 14.99),
        ("2", ten, ten, None, "q", 1, 1.005),
        ("3", ten, ten, "c", None, 1, 1.0),
        (None, ten, ten, "c", "p", 1, 1.0),
    )
    links = frame("product_id string, anime_id string", ("p", "t1"))
    cleaned = ops.clean_transactions(events, "transaction_id", "product_id", links, "anime_id", "transaction_ts")
    assert rows(cleaned, "transaction_id", "total_price", "linked_anime_id") == [("1", 59.96, "t1"), ("2", 1.01, None)]
    assert cleaned.columns == [
        "transaction_id", "transaction_ts", "customer_id", "product_id", "quantity_purchased", "total_price",
        "linked_anime_id",
    ]


def test_customer_master_cleans_ids(frame):
    df = frame(
        "registration_id string, customer_id string, name string, email string",
        ("r1", " C1 ", "old", "e"), ("r2", "c1", "new", "e"), ("r3", None, "x", "e"), ("r4", "C2", "y", "e"),
    )
    assert rows(ops.customer_master(df), "customer_id", "name") == [("c1", "new"), ("c2", "y")]


def test_revenue_summary_counts_a_repeated_purchase_once(frame):
    df = frame(
        "purchase_id string, ingestion_ts timestamp, screening_id string, item_quantity int, item_unit_price double",
        ("1", ten, "s", 2, 0.1), ("1", later, "s", 3, 0.1), ("2", ten, "s", 1, 0.2), ("3", ten, "t", 1, None),
    )
    summary = ops.revenue_summary(df, "screening_id", "item_quantity", "item_unit_price", "purchase_id")
    assert rows(summary) == [("s", 4, 0.5), ("t", 1, None)]


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) as k")
    dim = spark.range(40).selectExpr("id as k", "id * 10 as v")
    plain, salted = (ops.salted_left_join(facts, dim, ["k"], ["id"], n) for n in (1, 7))
    assert rows(plain, "id", "k", "v") == rows(salted, "id", "k", "v")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 40), st.integers(-9, 9)), min_size=1, max_size=40))
def test_running_by_chunk_equals_a_plain_loop(spark, data):
    df = spark.createDataFrame(
        [(k, i, m, v) for i, (k, m, v) in enumerate(data)], "k string, id int, m int, v int"
    ).selectExpr("k", "id", "timestamp '2024-01-01' + make_dt_interval(0, 0, m * 17) as at", "cast(v as bigint) v")
    from pyspark.sql import functions as F

    order = [F.col("at").asc(), F.col("id").asc()]
    got_sum = {r.id: r.out for r in ops.running_by_chunk(df, ["k"], "at", order, "v", "out").collect()}
    got_max = {
        r.id: r.out
        for r in ops.running_by_chunk(df, ["k"], "at", order, "v", "out", "max", include_current=False).collect()
    }
    for key in "xyz":
        total, peak = 0, None
        for m, i, v in sorted((m, i, v) for i, (k, m, v) in enumerate(data) if k == key):
            total += v
            assert got_sum[i] == total
            assert got_max[i] == peak
            peak = v if peak is None else max(peak, v)
