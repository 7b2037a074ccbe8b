"""Data-quality gate over the feature table.

Every statistic the gate needs comes from ONE aggregate job over the feature
table; the per-check rows are then produced from that single row with
``inline`` (no join, no second scan).  ``count_distinct(id)`` is exact and is
planned as a two-level aggregate (partial per task, then per ``id``), so no
group is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.features import DEFAULT_HORIZON, FEATURE_COLUMNS

REQUIRED_COLUMNS = ["id", "d", "sales", "d_num", "is_test"]
NOT_NULL_COLUMNS = ["id", "d", "sales", "is_test"]
CHECK_ORDER = ["required_columns", "not_empty", "test_size", "engineered_columns", "test_nulls"]


def _missing(df: DataFrame, cols: list[str]) -> list[str]:
    return sorted(set(cols) - set(df.columns))


def dq_stats(features: DataFrame, horizon: int = DEFAULT_HORIZON, null_columns: list[str] | None = None) -> DataFrame:
    """One row: ``n_rows, n_series, n_test, horizon, expected_test`` and the
    NULL count within test rows of each of ``null_columns`` (default: the
    five engineered features) as ``na_<feature>``."""
    h = int(horizon)
    cols = FEATURE_COLUMNS if null_columns is None else null_columns
    is_test = F.col("is_test")
    agg = features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_series"),
        F.count_if(is_test).alias("n_test"),
        *[F.count_if(is_test & F.col(c).isNull()).alias(f"na_{c}") for c in cols],
    )
    return agg.select(
        "n_rows",
        "n_series",
        "n_test",
        F.lit(h).cast("bigint").alias("horizon"),
        (F.col("n_series") * h).alias("expected_test"),
        *[f"na_{c}" for c in cols],
    )


def dq_summary(features: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """A2-A4 and D3's inputs: ``n_rows, n_series, n_test, horizon, expected_test``."""
    return dq_stats(features, horizon, null_columns=[])


def test_null_counts(features: DataFrame) -> DataFrame:
    """A5: NULL count of each engineered feature within test rows, one row
    per feature (``column_name, n_null``)."""
    is_test = F.col("is_test")
    agg = features.agg(*[F.count_if(is_test & F.col(c).isNull()).alias(c) for c in FEATURE_COLUMNS])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in FEATURE_COLUMNS
    ])))


def _check(name: str, passed: Column, observed: Column, expected: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        passed.alias("passed"),
        observed.cast("bigint").alias("observed"),
        expected.cast("bigint").alias("expected"),
    )


def dq_report(features: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """D1-D5 as rows ``(check, passed, observed, expected)`` in gate order.

    * required_columns: observed = number of missing required columns, expected 0
    * not_empty: observed = rows, expected = 1 (the minimum)
    * test_size: observed = test rows, expected = series x horizon
    * engineered_columns: observed = number of missing feature columns, expected 0
    * test_nulls: observed = NULL feature cells in test rows, expected 0

    A table without the required columns yields only the failing first row
    (the later checks cannot be evaluated), from metadata alone.
    """
    missing_req = _missing(features, REQUIRED_COLUMNS)
    if missing_req:
        spark = features.sparkSession
        return spark.range(1).select(F.inline(F.array(
            _check("required_columns", F.lit(False), F.lit(len(missing_req)), F.lit(0))
        )))
    missing_feat = _missing(features, FEATURE_COLUMNS)
    if missing_feat:
        stats = dq_summary(features, horizon).select("*", F.lit(None).cast("bigint").alias("na_total"))
    else:
        stats = dq_stats(features, horizon).select(
            "*", sum((F.col(f"na_{c}") for c in FEATURE_COLUMNS), F.lit(0).cast("bigint")).alias("na_total")
        )
    checks = [
        _check("required_columns", F.lit(True), F.lit(0), F.lit(0)),
        _check("not_empty", F.col("n_rows") > 0, F.col("n_rows"), F.lit(1)),
        _check("test_size", F.col("n_test") == F.col("expected_test"), F.col("n_test"), F.col("expected_test")),
        _check("engineered_columns", F.lit(not missing_feat), F.lit(len(missing_feat)), F.lit(0)),
        _check("test_nulls", F.coalesce(F.col("na_total") == 0, F.lit(False)), F.col("na_total"), F.lit(0)),
    ]
    return stats.select(F.inline(F.array(*checks)))


class DataQualityError(ValueError):
    pass


def run_gate(features: DataFrame, horizon: int = DEFAULT_HORIZON, enforce: bool = True) -> dict:
    """Evaluate the gate (one aggregate job), fail fast in check order.

    Returns the success report (``n_rows, n_series, horizon, n_test,
    expected_test, test_na_counts``) plus the per-check rows.  With
    ``enforce`` the first failing check raises ``DataQualityError``.
    """
    missing_req = _missing(features, REQUIRED_COLUMNS)
    if missing_req:
        if enforce:
            raise DataQualityError(f"Missing required columns: {missing_req}")
        return {"status": "failed", "failed_check": "required_columns", "missing": missing_req}
    missing_feat = _missing(features, FEATURE_COLUMNS)
    row = (dq_summary if missing_feat else dq_stats)(features, horizon).first().asDict()
    checks = [
        ("required_columns", True, 0, 0),
        ("not_empty", row["n_rows"] > 0, row["n_rows"], 1),
        ("test_size", row["n_test"] == row["expected_test"], row["n_test"], row["expected_test"]),
        ("engineered_columns", not missing_feat, len(missing_feat), 0),
    ]
    na = {} if missing_feat else {c: int(row[f"na_{c}"]) for c in FEATURE_COLUMNS}
    if not missing_feat:
        checks.append(("test_nulls", sum(na.values()) == 0, sum(na.values()), 0))
    failed = next((c for c in checks if not c[1]), None)
    if failed and enforce:
        name, _, observed, expected = failed
        raise DataQualityError(f"DQ fail: {name} (observed={observed}, expected={expected}); test NULLs {na}")
    return {
        "status": "failed" if failed else "ok",
        "failed_check": failed[0] if failed else None,
        "n_rows": int(row["n_rows"]),
        "n_series": int(row["n_series"]),
        "horizon": int(row["horizon"]),
        "n_test": int(row["n_test"]),
        "expected_test": int(row["expected_test"]),
        "test_na_counts": na,
        "checks": [dict(zip(["check", "passed", "observed", "expected"], c, strict=True)) for c in checks],
    }


def not_null_tests(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count per column (zero expected), rows ``(column_name, n_null, passed)``."""
    cols = columns or NOT_NULL_COLUMNS
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"), (F.col(c) == 0).alias("passed"))
        for c in cols
    ])))


def duplicate_series_days(sales: DataFrame) -> DataFrame:
    """(``id``, ``d``) keys that occur more than once, with their count.

    Row-based lags over duplicated days would depend on row order, so the
    feature job refuses such input.  One grouped count with map-side partial
    aggregation: a hot key is pre-counted in every task before the shuffle.
    """
    return (
        sales.groupBy("id", "d")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
