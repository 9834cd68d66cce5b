"""Shape of the physical plans: no pairwise joins, no Python, scans pruned, hot keys split."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from terrane import operators as ops
from terrane.plans import catalogue

from .helpers import rows

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ml_features", "fact_sales", "level_at_sale", "scd2_full_outer", "late_events", "dq_report"])
def test_only_built_in_operators(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for bad in ("NestedLoop", "Cartesian", "Python", "Pandas", "ArrowEval"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalogue.line_total(spark, SF_DIR))
    [scan] = [line for line in text.splitlines() if "FileScan" in line and "l_linestatus" in line]
    assert "EqualTo(l_linestatus,F)" in scan
    assert "l_tax" not in scan and "l_returnflag" not in scan


@pytest.fixture
def eager_skew(spark):
    """Thresholds at which the test data's hot key counts as skewed, and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


HOT_SALES = (
    "string(id) as transaction_id", "timestamp '2024-01-01' + make_dt_interval(0, 0, id % 9000) as event_ts",
    "timestamp '2024-01-02' as ingestion_ts", "string(id % 70) as customer_id",
    "if(id % 3 = 0, 'hot_x_0', concat('cold_x_', id % 500)) as product_id", "1 as quantity_purchased",
    "2.5D as unit_price_at_sale",
)


def test_hot_product_is_split_in_the_fact_join(spark, eager_skew):
    """A third of the sales are of one product: its join partition is cut by the adaptive planner."""
    sales = spark.range(0, 60000, 1, 4).selectExpr(*HOT_SALES).withColumn("transaction_ts", F.col("event_ts"))
    sales = sales.withColumn("total_price", F.lit(2.5)).repartition(16)
    stock = spark.range(500).selectExpr("concat('cold_x_', id) as product_id", "id as current_quantity")
    facts = ops.fact_sales(sales, stock)
    assert len(facts.collect()) == 60000
    assert "isSkew=true" in plan(facts) or "SortMergeJoin(skew=true)" in plan(facts)


def test_hot_product_levels_equal_a_plain_window(spark):
    """A third of the ledger is one product; the chunks give the same levels as one window per product."""
    sales = spark.range(0, 20000, 1, 4).selectExpr(*HOT_SALES)
    deliveries = spark.range(0, 300).selectExpr(
        "string(id) as delivery_id", "timestamp '2024-01-01' + make_dt_interval(0, 0, id) as event_ts",
        "timestamp '2024-01-02' as ingestion_ts", "'s' as supplier_id",
        "if(id % 3 = 0, 'hot_x_0', concat('cold_x_', id)) as product_id", "50 as quantity_delivered", "1.0D as unit_cost",
    )
    ledger = ops.movement_ledger(sales, deliveries)
    ledger.createOrReplaceTempView("ledger")
    expected = spark.sql("""
        SELECT movement_id, product_id, level FROM (
          SELECT *, sum(quantity_change) OVER (PARTITION BY product_id
            ORDER BY movement_ts, movement_type, movement_id ROWS UNBOUNDED PRECEDING) AS level FROM ledger)
        WHERE movement_type = 'SALE'""")
    assert rows(ops.level_at_sale(ledger)) == rows(expected)
    window = [line for line in plan(ops.level_at_sale(ledger)).splitlines() if "Window [sum" in line]
    assert any("_chunk" in line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in window)
