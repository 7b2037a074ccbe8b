"""DQ gate rows and fail-fast order on hand-made feature tables."""

import pytest

from shelfcast.operators.quality import DataQualityError, dq_report, not_null_tests, run_gate

SCHEMA = ("id string, d string, sales int, d_num bigint, is_test boolean, lag_1 double, lag_7 double, "
          "lag_28 double, roll_mean_7 double, roll_mean_28 double")


def _feats(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_report_passes_and_counts(spark):
    rows = [("A", f"d_{i}", 1, i, i > 3, 1.0, 1.0, 1.0, 1.0, 1.0) for i in range(1, 6)]
    rep = {r["check"]: (r["passed"], r["observed"], r["expected"]) for r in dq_report(_feats(spark, rows), 2).collect()}
    assert rep == {"required_columns": (True, 0, 0), "not_empty": (True, 5, 1), "test_size": (True, 2, 2),
                   "engineered_columns": (True, 0, 0), "test_nulls": (True, 0, 0)}


def test_test_nulls_fail(spark):
    rows = [("A", "d_1", 1, 1, False, None, None, None, None, None),
            ("A", "d_2", 1, 2, True, 1.0, None, None, None, None)]
    feats = _feats(spark, rows)
    rep = {r["check"]: (r["passed"], r["observed"]) for r in dq_report(feats, 1).collect()}
    assert rep["test_nulls"] == (False, 4) and rep["test_size"] == (True, 1)
    with pytest.raises(DataQualityError, match="test_nulls"):
        run_gate(feats, 1)
    assert run_gate(feats, 1, enforce=False)["test_na_counts"]["lag_7"] == 1


def test_missing_columns_fail_fast(spark):
    rows = [("A", "d_1", 1, 1, True, 1.0, 1.0, 1.0, 1.0, 1.0)]
    feats = _feats(spark, rows)
    rep = [tuple(r) for r in dq_report(feats.drop("is_test"), 1).collect()]
    assert rep == [("required_columns", False, 1, 0)]
    with pytest.raises(DataQualityError, match="is_test"):
        run_gate(feats.drop("is_test"), 1)
    rep = {r["check"]: r["passed"] for r in dq_report(feats.drop("lag_28"), 1).collect()}
    assert rep["engineered_columns"] is False and rep["test_nulls"] is False
    with pytest.raises(DataQualityError, match="engineered_columns"):
        run_gate(feats.drop("lag_28"), 1)


def test_empty_table_fails_not_empty(spark):
    feats = _feats(spark, [])
    with pytest.raises(DataQualityError, match="not_empty"):
        run_gate(feats, 1)


def test_not_null_tests(spark):
    feats = _feats(spark, [("A", None, 1, 1, True, 1.0, 1.0, 1.0, 1.0, 1.0)])
    got = {r["column_name"]: (r["n_null"], r["passed"]) for r in not_null_tests(feats).collect()}
    assert got == {"id": (0, True), "d": (1, False), "sales": (0, True), "is_test": (0, True)}
