import pytest
from pyspark.sql import functions as F

from terrane import operators as ops

from .helpers import rows


@pytest.fixture
def bad(frame):
    return frame(
        "id string, qty int, price double",
        ("a", 1, 1.0), ("a", 2, float("nan")), ("b", 0, 2.0), (None, -1, 3.0), ("c", None, 4.0),
    )


def test_report(bad):
    report = ops.dq_report(bad, ["id"], ["id", "price"], ["qty"])
    assert rows(report) == [
        ("not_null", "id", 1), ("not_null", "price", 1), ("positive", "qty", 2), ("rows", "*", 5), ("unique", "id", 1),
    ]
    assert not ops.passed(report)


def test_report_reads_its_input_once(bad):
    plan = ops.dq_report(bad, ["id"], ["id", "price"], ["qty"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_report_of_clean_and_of_empty_data(bad):
    clean = ops.dedupe_latest(bad, ["id"], ["qty"]).dropna().where("qty > 0 and not isnan(price)")
    assert ops.passed(ops.dq_report(clean, ["id"], ["id", "price"], ["qty"]))
    empty = ops.dq_report(bad.where("false"), ["id"], ["id"])
    assert rows(empty) == [("not_null", "id", 0), ("rows", "*", 0), ("unique", "id", 0)]


def test_gates(bad):
    assert ops.gate_non_empty(bad) and not ops.gate_non_empty(bad.where("false"))
    assert not ops.gate_no_nulls(bad, ["id"]) and not ops.gate_no_nulls(bad, ["price"])
    assert ops.gate_no_nulls(bad.dropna(), ["id", "qty"])


def test_duplicate_keys(bad):
    assert rows(ops.duplicate_keys(bad, ["id"])) == [("a", 2)]


def test_policies(bad, caplog):
    report = ops.dq_report(bad, ["id"])
    with pytest.raises(ops.QualityError, match="unique id: 1"):
        ops.enforce(report, "t")
    assert ops.enforce(report, "t", "warn") is False
    assert "unique id: 1" in caplog.text
    assert ops.warn_checks(bad, "t", {"qty not positive": F.col("qty") <= 0}) == {"qty not positive": 2}
    assert "qty not positive: 2" in caplog.text


def test_quarantine_splits_rows_without_loss(bad):
    good, rest = ops.quarantine(bad, {"key": F.col("id").isNotNull(), "sold": F.col("qty") > 0})
    assert good.columns == bad.columns
    assert rows(good, "id", "qty") == [("a", 1), ("a", 2)]
    assert rows(rest, "qty", "failed_rules") == [(-1, ["key", "sold"]), (0, ["sold"]), (None, ["sold"])]
