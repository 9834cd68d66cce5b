from itertools import product

from pyspark.sql import functions as F

from terrane import operators as ops
from terrane.functions import exact_sum, money, normalized, token

from .helpers import rows, ts

t1, t2, t3 = (ts(f"2024-01-0{n} 10:00:00") for n in (1, 2, 3))
SALES = (
    "transaction_id string, event_ts timestamp, ingestion_ts timestamp, product_id string, customer_id string,"
    " quantity_purchased int, unit_price_at_sale double"
)
DELIVERIES = (
    "delivery_id string, event_ts timestamp, ingestion_ts timestamp, supplier_id string, product_id string,"
    " quantity_delivered int, unit_cost double"
)


def test_text_functions(frame):
    df = frame("t string", ("T_mug_1",), ("CONC004",), ("Ab-ç 9",), (None,))
    assert rows(df, token("t", 1)) == [("mug",), (None,), (None,), (None,)]
    assert rows(df, normalized("t")) == [("ab9",), ("conc004",), ("tmug1",), (None,)]


def test_exact_sum_does_not_depend_on_order(spark):
    cents = spark.range(1000).selectExpr("cast(id % 7 as double) / 100 + 0.1 as x")
    results = {
        cents.repartition(n).agg(exact_sum("x")).first()[0] for n in (1, 3, 8)
    }
    assert results == {129.97}
    assert spark.range(1).select(money(F.lit(2.675))).first()[0] == 2.68


def test_product_master_keeps_products_of_either_side(frame):
    sales = frame(SALES, ("1", t1, t1, "both_mug_1", "c", 1, 5.0), ("2", t1, t2, "both_mug_1", "c", 1, 6.0),
                  ("3", t1, t1, "sold_cup_2", "c", 1, 7.0))
    deliveries = frame(DELIVERIES, ("1", t1, t1, "s1", "both_mug_1", 1, 2.0), ("2", t1, t3, "s2", "come_x_3", 1, 3.0))
    links = frame("product_id string, anime_id string", ("both_mug_1", "a"), ("sold_cup_2", "b"), ("come_x_3", "c"))
    got = ops.product_master(deliveries, sales, links)
    assert rows(got, "product_id", "supplier_id", "current_unit_cost", "current_unit_price", "category", "linked_anime_id") == [
        ("both_mug_1", "s1", 2.0, 6.0, "mug", "a"),
        ("come_x_3", "s2", 3.0, None, "x", "c"),
        ("sold_cup_2", None, None, 7.0, "cup", "b"),
    ]


def test_inventory_position_and_ledger(frame):
    sales = frame(SALES, ("1", t2, t2, "p", "c", 30, 1.0))
    deliveries = frame(DELIVERIES, ("1", t1, t1, "s1", "p", 50, 1.0), ("2", t2, t2, "s2", "p", 20, 1.0))
    links = frame("product_id string, anime_id string", ("p", "a"))
    position = ops.inventory_position(sales, deliveries, links)
    assert rows(position) == [("p", "a", 40, t2, "s2")]
    ledger = ops.movement_ledger(sales, deliveries)
    assert rows(ledger, "movement_type", "quantity_change") == [("DELIVERY", 20), ("DELIVERY", 50), ("SALE", -30)]
    assert ledger.agg(F.sum("quantity_change")).first()[0] == 40


def test_level_at_sale_counts_deliveries_of_the_same_time_first(frame):
    ledger = frame(
        "product_id string, movement_ts timestamp, quantity_change bigint, movement_type string, movement_id string",
        ("p", t1, 10, "DELIVERY", "d1"), ("p", t2, -3, "SALE", "s1"), ("p", t2, 5, "DELIVERY", "d2"),
        ("p", t3, -4, "SALE", "s3"), ("p", t3, -2, "SALE", "s2"), ("q", None, -1, "SALE", "s4"),
    )
    for chunk in ("hour", "month", "year"):
        assert rows(ops.level_at_sale(ledger, chunk)) == [("s1", "p", 12), ("s2", "p", 10), ("s3", "p", 6), ("s4", "q", -1)]


def test_inventory_status_bounds(frame):
    stock = frame("product_id string, current_quantity bigint, last_update_ts timestamp",
                  *[(str(n), q, t1) for n, q in enumerate((29, 30, 50, 51, None))])
    assert [r[1] for r in rows(ops.inventory_status(stock), "product_id", "status")] == [
        "Low Stock – Reorder Needed", "Low Stock – Monitor", "Low Stock – Monitor", "Stock OK", "Stock OK",
    ]


def test_segment_table(frame):
    cells = list(product((1, 2, 4), (1, 2, 4)))
    customers = frame("customer_id string, name string, email string",
                      *[(f"c{p}{t}", "n", "e") for p, t in cells], ("idle", "n", "e"))
    bought = frame("customer_id string", *[(f" C{p}{t}",) for p, t in cells for _ in range(p)])
    booked = frame("customer_id string", *[(f"c{p}{t}",) for p, t in cells for _ in range(t)])
    counts = ops.activity_counts(bought, booked)
    assert ("c14", 1, 4) in rows(counts)
    assert dict(rows(ops.segment_customers(customers, counts), "customer_id", "segment")) == {
        "c11": "Low Spender", "c12": "Moderate - Tickets", "c14": "Heavy - Tickets",
        "c21": "Moderate - Products", "c22": "Moderate - Both", "c24": "Low Spender",
        "c41": "Heavy - Products", "c42": "Low Spender", "c44": "Top Customer", "idle": "Low Spender",
    }


def test_activity_counts_has_zero_for_one_sided_customers(frame):
    counts = ops.activity_counts(frame("customer_id string", ("a",)), frame("customer_id string", ("b",), (None,)))
    assert rows(counts) == [("a", 1, 0), ("b", 0, 1)]


def test_segment_summary_of_unknown_segment(frame):
    dim = frame("customer_id string, segment string", ("1", "Top Customer"), ("2", "Top Customer"), ("3", "Odd"))
    assert rows(ops.segment_summary(dim)) == [
        ("Odd", 1, "Uncategorized"), ("Top Customer", 2, "Buys more than 3 in both products and tickets"),
    ]


def test_top_entities_breaks_ties_by_id(frame):
    dim = frame("anime_id string, title string", *[(f"a{n}", f"t{n}") for n in range(1, 8)])
    sales = frame("linked_anime_id string, total_price double", ("a1", 9.0), ("a2", 8.0), ("a3", 7.0), ("a4", 6.0),
                  ("a6", 5.0), ("a5", 2.0), ("a5", 3.0), (None, 99.0))
    bookings = frame("linked_anime_id string, total_price double, quantity_purchased int", ("a7", 50.0, 4))
    top = ops.top_entities(dim, sales, bookings)
    assert [r.anime_id for r in top.collect()] == ["a1", "a2", "a3", "a4", "a5"]
    first = ops.top_entities(dim, sales, bookings, n=1, measure="total").first()
    assert (first.anime_id, first.total_sales, first.total_attendance) == ("a7", 50.0, 4)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_fact_sales_both_levels(frame):
    sales = frame(
        "transaction_id string, transaction_ts timestamp, customer_id string, product_id string,"
        " quantity_purchased int, total_price double, linked_anime_id string",
        ("1", t1, "c", "p", 2, 3.0, None), ("2", t1, "c", "q", 2, 3.0, None),
    )
    stock = frame("product_id string, current_quantity bigint", ("p", 7))
    for salts in (1, 3):
        assert rows(ops.fact_sales(sales, stock, salts=salts), "sale_id", "inventory_level_at_sale") == [("1", 7), ("2", None)]
    levels = frame("transaction_id string, level bigint", ("1", 5), ("2", 6))
    assert rows(ops.fact_sales(sales, stock, levels), "sale_id", "inventory_level_at_sale") == [("1", 5), ("2", 6)]


def test_concession_revenue_counts_once_per_screening(frame):
    bookings = frame(
        "booking_id string, booking_ts timestamp, screening_id string, total_price double, linked_anime_id string",
        ("1", t1, "s1", 10.0, "a"), ("2", t1, "s1", 20.0, "a"), ("3", t1, "s2", 5.0, "a"),
    )
    concessions = frame("screening_id string, total_revenue double", ("s1", 100.0))
    facts = ops.fact_screenings(bookings, concessions)
    assert rows(facts, "booking_id", "concession_revenue") == [("1", 100.0), ("2", 100.0), ("3", None)]
    [row] = ops.screening_rollup(facts).collect()
    assert (row.sales_from_tickets, row.sales_from_concessions) == (35.0, 100.0)
    assert abs(row.avg_views - 35 / 3) < 1e-12


def test_title_features(frame):
    dim = frame("anime_id string, title string, season string, genre string, release_date timestamp",
                ("a", "Alpha", "s", "g", t1), ("b", "Beta", "s", "g", t3))
    sales = frame("product_id string, revenue double", ("p", 1.5), ("p", 2.5), ("x", 9.0))
    screenings = frame(
        "booking_id string, screening_id string, anime_id string, ticket_revenue double, concession_revenue double",
        ("1", "s1", "a", 10.0, 4.0),
    )
    products = frame("product_id string, name string", ("p", "Alpha"))
    got = ops.title_features(dim, sales, screenings, products)
    assert rows(got, "anime_id", "historical_sales", "avg_views") == [("a", 18.0, 10.0), ("b", 0.0, 0.0)]
    upcoming = ops.title_features(dim, sales, screenings, products, F.lit(t2))
    assert rows(upcoming, "anime_id") == [("b",)]
