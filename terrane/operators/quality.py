"""Data-quality gates, reports and quarantine."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

log = logging.getLogger(__name__)


class QualityError(ValueError):
    """A batch failed a gate whose policy is to abort."""


def _missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the column can hold one."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        missing = missing | F.isnan(name)
    return missing


def gate_non_empty(df: DataFrame) -> bool:
    """True when ``df`` has a row; reads at most one."""
    return not df.isEmpty()


def gate_no_nulls(df: DataFrame, cols: Sequence[str]) -> bool:
    """True when no listed column is NULL or NaN in any row; stops at the first bad row."""
    bad = F.lit(False)
    for name in cols:
        bad = bad | _missing(df, name)
    return df.where(bad).isEmpty()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def dq_report(
    df: DataFrame,
    key_cols: Sequence[str] = (),
    non_null_cols: Sequence[str] = (),
    positive_cols: Sequence[str] = (),
) -> DataFrame:
    """Rows (``check``, ``column``, ``violations``) from one pass over ``df``.

    Checks: ``rows`` (the row count, not a violation), ``not_null`` (NULL or NaN), ``positive``
    (value <= 0), ``unique`` (number of key values that occur more than once). The counts per
    column are first combined per key value, then over all keys, so the input is read once.
    """
    parts = [F.count("*").alias("n")]
    parts += [F.count_if(_missing(df, c)).alias(f"null_{c}") for c in non_null_cols]
    parts += [F.count_if(F.col(c) <= 0).alias(f"low_{c}") for c in positive_cols]
    grouped = df.groupBy(*key_cols).agg(*parts)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    rows = [_line("rows", "*", total(F.col("n")))]
    rows += [_line("not_null", c, total(F.col(f"null_{c}"))) for c in non_null_cols]
    rows += [_line("positive", c, total(F.col(f"low_{c}"))) for c in positive_cols]
    if key_cols:
        rows.append(_line("unique", ",".join(key_cols), F.count_if(F.col("n") > 1)))
    return grouped.agg(F.array(*rows).alias("lines")).select(F.inline("lines"))


def _line(check: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(column).alias("column"),
        violations.cast("bigint").alias("violations"),
    )


def passed(report: DataFrame) -> bool:
    """True when no check of a report has violations."""
    return report.where((F.col("check") != "rows") & (F.col("violations") > 0)).isEmpty()


def enforce(report: DataFrame, name: str, on_fail: str = "abort") -> bool:
    """Apply a policy to a report: raise (``abort``) or log (``warn``); returns whether it passed."""
    failures = report.where((F.col("check") != "rows") & (F.col("violations") > 0)).collect()
    return enforce_counts({f"{r['check']} {r['column']}": r["violations"] for r in failures}, name, on_fail)


def enforce_counts(violations: Mapping[str, int], name: str, on_fail: str = "abort") -> bool:
    """The same for counted violations."""
    text = "; ".join(f"{rule}: {count}" for rule, count in violations.items() if count)
    if text and on_fail == "abort":
        raise QualityError(f"{name}: {text}")
    if text:
        log.warning("%s: %s", name, text)
    return not text


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Aggregates that count NULL or NaN per column, for a pass that is made anyway."""
    return {f"not_null {c}": F.count_if(_missing(df, c)) for c in cols}


def warn_checks(df: DataFrame, name: str, rules: Mapping[str, Column]) -> dict[str, int]:
    """Count the rows that meet each suspicious condition, in one pass, and log what is found."""
    counts = df.agg(*[F.count_if(cond).alias(rule) for rule, cond in rules.items()]).first().asDict()
    enforce_counts(counts, name, "warn")
    return counts


def tag_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` plus ``failed_rules``: names of the rules a row does not meet; NULL does not meet."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("failed_rules", F.array_compact(F.array(*failed)))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``failed_rules``): bad rows are set aside, the batch goes on."""
    tagged = tag_rows(df, rules)
    good = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    return good, tagged.where(F.size("failed_rules") > 0)
