import pytest
from pyspark.sql import functions as F

from terrane.schemas import TABLES
from terrane.session import scratch_root
from terrane.sources import Lake, read_csv, stage, stage_measured

from .helpers import rows

SEGMENTS = "gold.customer_segments"


def test_create_all_and_keep_rows(lake, frame):
    lake.create()
    assert all(lake.exists(t) for t in TABLES)
    lake.append(SEGMENTS, frame("segment string, customer_count int, description string", ("a", 1, "d")))
    lake.create()
    assert lake.load(SEGMENTS).count() == 1


def test_append_matches_names_and_casts(lake, frame):
    lake.append(SEGMENTS, frame("description string, segment string, customer_count int", ("d", "a", 1)))
    assert rows(lake.load(SEGMENTS)) == [("a", 1, "d")]
    assert dict(lake.load(SEGMENTS).dtypes)["customer_count"] == "bigint"


def test_append_of_other_columns_fails(lake, frame):
    with pytest.raises(Exception, match="customer_count"):
        lake.append(SEGMENTS, frame("segment string, customer_count string, description string", ("a", "x", "d")))


def test_publish_replaces_a_table_it_reads(lake, frame):
    lake.publish(SEGMENTS, frame("segment string, customer_count int, description string", ("a", 1, "d"), ("b", 2, "d")))
    for n in (2, 4):
        lake.publish(SEGMENTS, lake.load(SEGMENTS).withColumn("customer_count", F.col("customer_count") * 2))
        assert rows(lake.load(SEGMENTS), "customer_count") == [(n,), (2 * n,)]
    lake.append(SEGMENTS, frame("segment string, customer_count int, description string", ("c", 9, "d")))
    assert lake.load(SEGMENTS).count() == 3


def test_failed_publish_leaves_the_old_version(lake, frame):
    schema = "segment string, customer_count int, description string"
    lake.publish(SEGMENTS, frame(schema, ("a", 1, "d")))
    broken = frame(schema, ("b", 2, "d")).withColumn("customer_count", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        lake.publish(SEGMENTS, broken)
    assert rows(lake.load(SEGMENTS)) == [("a", 1, "d")]


def test_missing_tables(lake, caplog):
    assert lake.load("gold.dim_customer") is None
    assert "does not exist" in caplog.text
    empty = lake.load_or_empty("gold.dim_customer")
    assert empty.columns == ["customer_id", "name", "segment", "email"] and empty.isEmpty()


def test_inspection(lake, frame):
    lake.append(SEGMENTS, frame("segment string, customer_count int, description string", *[(str(n), n, "d") for n in range(12)]))
    assert lake.preview(SEGMENTS).count() == 10
    assert rows(lake.describe(SEGMENTS), "col_name") == [("customer_count",), ("description",), ("segment",)]
    lake.drop(SEGMENTS)
    assert not lake.exists(SEGMENTS)


def test_parquet_lake(spark, lake, tmp_path, frame):
    other = Lake(spark, str(tmp_path / "p"), fmt="parquet")
    other.publish(SEGMENTS, frame("segment string, customer_count int, description string", ("a", 1, "d")))
    assert other.load(SEGMENTS).count() == 1


def test_csv_cells_that_do_not_fit_become_null(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,n,at\nx,1,2020-12-07 00:00:00\nNULL,NULL,NULL\ny,z,never\n")
    df = read_csv(spark, str(path), "a STRING, n INT, at STRING", ["at"], "loaded_at")
    assert rows(df.selectExpr("a", "n", "at is null", "loaded_at is null")) == [
        ("NULL", None, True, False), ("x", 1, False, False), ("y", None, True, False),
    ]


def test_stage_cuts_the_plan_and_keeps_the_schema(spark, frame):
    staged = stage(frame("a int, b string", (1, "x")).withColumn("c", F.col("a") + 1))
    assert rows(staged) == [(1, "x", 2)]
    assert "LogicalRDD" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert scratch_root(spark) + "/terrane/" in staged.inputFiles()[0]


def test_command_line_jobs(lake, tmp_path, capfd):
    from terrane.__main__ import main

    root = ["--root", str(tmp_path / "cli")]
    (tmp_path / "c.csv").write_text("registration_id,customer_id,name,email\nr1,501,Ann,a@x\nr2,502,Bo,b@x\n")
    main([*root, "create-tables"])
    main([*root, "load-customers", str(tmp_path / "c.csv")])
    main([*root, "preview", "bronze.bronze_customer_registration_events"])
    assert lake.load("bronze.bronze_customer_registration_events").count() == 2
    assert "Ann" in capfd.readouterr().out


def test_stage_measures_while_it_writes(spark):
    staged, seen = stage_measured(
        spark.range(100).repartition(7), {"n": F.count("*"), "odd": F.count_if(F.col("id") % 2 == 1)}
    )
    assert seen == {"n": 100, "odd": 50} and staged.count() == 100
    _, none = stage_measured(spark.range(0), {"n": F.count("*"), "top": F.max("id")})
    assert none == {"n": 0, "top": None}


def test_append_to_an_undeclared_table_is_by_name(lake, frame):
    lake.append("bronze.own", frame("a string, b string", ("1", "2")))
    lake.append("bronze.own", frame("b string, a string", ("4", "3")))
    lake.append("bronze.own", frame("a string", ("5",)))
    assert rows(lake.load("bronze.own"), "a", "b") == [("1", "2"), ("3", "4"), ("5", None)]
