"""Ridge against the closed form, and the golden smoke fixture."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import evaluate as ev
from shelfcast.operators import model as md
from shelfcast.operators.quality import DataQualityError, run_gate


def _closed_form(train: pd.DataFrame, alpha: float = 1.0):
    cols = []
    names = []
    for c in md.NUMERIC_FEATURES:
        cols.append(train[c].astype(float).to_numpy())
        names.append(c)
    for c in md.CATEGORICAL_FEATURES:
        for lev in sorted(train[c].unique()):
            cols.append((train[c] == lev).astype(float).to_numpy())
            names.append(f"{c}={lev}")
    X = np.column_stack(cols)
    y = train["label"].to_numpy(float)
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    return dict(zip(names, w, strict=True)), ym - xm @ w


def test_ridge_matches_closed_form(spark, sf_small):
    from shelfcast.plans.catalog import features

    train = md.train_set(features(spark, sf_small))
    model = md.fit_ridge(train)
    got = dict(map(tuple, md.coefficients(model).collect()))
    w, b = _closed_form(train.toPandas())
    for name, val in w.items():
        key = name if name in got else name.split("=")[0] + "=*"
        assert got[key] == pytest.approx(val, rel=1e-6, abs=1e-8), name
    assert got["(intercept)"] == pytest.approx(b, rel=1e-6, abs=1e-6)


def _smoke_fixture(spark):
    rows = []
    for i in range(60):
        rows.append(("FOO_1_CA_1", f"d_{i + 1}", 10.0 + i % 5, i + 1, i >= 50, "FOO_1", "FOO", "FOO", "CA_1", "CA",
                     10.0, 10.0, 10.0, 10.0, 10.0, 11111, 1, 1, 2016, 0, 0, 0))
    schema = ("id string, d string, sales double, d_num bigint, is_test boolean, item_id string, dept_id string, "
              "cat_id string, store_id string, state_id string, lag_1 double, lag_7 double, lag_28 double, "
              "roll_mean_7 double, roll_mean_28 double, wm_yr_wk int, wday smallint, month smallint, "
              "year smallint, snap_CA tinyint, snap_TX tinyint, snap_WI tinyint")
    return spark.createDataFrame(rows, schema)


def test_smoke_fixture_goldens(spark):
    feats = _smoke_fixture(spark)
    model = md.fit_ridge(md.train_set(feats))
    coef = dict(map(tuple, md.coefficients(model).collect()))
    assert coef["d_num"] == pytest.approx(0.00960291928746, rel=1e-9)
    assert coef["(intercept)"] == pytest.approx(11.7551255581697, rel=1e-9)
    assert all(v == 0.0 for k, v in coef.items() if k not in ("d_num", "(intercept)"))
    preds = md.predict(model, md.test_set(feats))
    m = ev.regression_metrics(preds).first()
    assert m["mae"] == pytest.approx(1.24609401257982, rel=1e-9)
    assert m["rmse"] == pytest.approx(1.43015508190300, rel=1e-9)
    assert m["r2"] == pytest.approx(-0.02267177914655, rel=1e-8)
    assert md.train_summary(feats, 10).first().asDict() == {"n_rows": 60, "n_train_used": 50, "horizon": 10}


def test_smoke_fixture_dq(spark):
    feats = _smoke_fixture(spark)
    assert run_gate(feats, horizon=10)["status"] == "ok"
    with pytest.raises(DataQualityError, match="test_size"):
        run_gate(feats, horizon=28)
    assert run_gate(feats, horizon=28, enforce=False)["failed_check"] == "test_size"


def test_unseen_category_predicts_finite(spark):
    feats = _smoke_fixture(spark)
    model = md.fit_ridge(md.train_set(feats))
    other = feats.where("is_test").replace("FOO_1_CA_1", "NEW_SERIES", subset=["id"])
    preds = md.predict(model, md.test_set(other)).collect()
    assert len(preds) == 10 and all(np.isfinite(r["y_pred"]) for r in preds)


def test_constant_label_r2(spark):
    df = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "y_true double, y_pred double")
    assert ev.regression_metrics(df).first()["r2"] == 1.0
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 3.0)], "y_true double, y_pred double")
    assert ev.regression_metrics(df).first()["r2"] == 0.0


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=500), [0.3] * 20, rng.integers(-5, 5, 100)])
    df = spark.createDataFrame([(float(v),) for v in vals], "residual double")
    got = ev.residual_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=50)
    assert [r["n"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["bin_lo"] for r in got], edges[:-1], rtol=1e-12)
    assert got[-1]["bin_hi"] == edges[-1]


def test_histogram_constant_values(spark):
    df = spark.createDataFrame([(2.0,)] * 7, "residual double")
    got = ev.residual_histogram(df).collect()
    counts, _ = np.histogram([2.0] * 7, bins=50)
    assert sorted((r["bin"], r["n"]) for r in got) == [(i + 1, int(c)) for i, c in enumerate(counts)]
    assert sum(1 for r in got if r["n"]) == 1


def test_levels_across_series_match_closed_form(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        sid = f"S{i % 7}"
        lags = rng.normal(5, 2, 5)
        y = 3 + 0.5 * lags[0] - 0.2 * lags[3] + (i % 7) * 0.3 + rng.normal(0, 0.5)
        rows.append((sid, f"d_{i}", float(y), i, False, f"I{i % 3}", "D", "C", f"T{i % 2}", "ST",
                     *[float(v) for v in lags], 11101 + i // 7, i % 7 + 1, i % 12 + 1, 2011 + i // 365,
                     i % 2, 0, i % 3 == 0))
    schema = ("id string, d string, sales double, d_num bigint, is_test boolean, item_id string, "
              "dept_id string, cat_id string, store_id string, state_id string, lag_1 double, lag_7 double, "
              "lag_28 double, roll_mean_7 double, roll_mean_28 double, wm_yr_wk int, wday int, month int, "
              "year int, snap_CA int, snap_TX int, snap_WI boolean")
    feats = spark.createDataFrame(rows, schema).withColumn("snap_WI", F.col("snap_WI").cast("int"))
    train = md.train_set(feats)
    exp_w, exp_b = _closed_form(train.toPandas())
    model = md.fit_ridge(train)
    got = dict(map(tuple, md.coefficients(model).collect()))
    for name, val in exp_w.items():
        key = name if name in got else name.split("=")[0] + "=*"
        assert got[key] == pytest.approx(val, rel=1e-7, abs=1e-9), name
    assert got["(intercept)"] == pytest.approx(exp_b, rel=1e-7)
    left = md.normal_residual(model, train, digits=8).collect()
    assert all(r["residual"] == 0 for r in left) and len(left) == 14 + 7 + 3 + 1 + 1 + 2 + 1


SCHEMA = ("id string, d string, sales double, d_num bigint, is_test boolean, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
          "lag_1 double, lag_7 double, lag_28 double, roll_mean_7 double, roll_mean_28 double, wm_yr_wk int, wday int, month int, year int, snap_CA int, snap_TX int, snap_WI int")


@pytest.mark.parametrize("shared", [False, True])
def test_levels_that_series_share(spark, shared):
    """Levels of a series may change, and NULL is no level."""
    from shelfcast.session import scratch_path

    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        k = i % 30
        item = "I1" if shared and k == 0 and i > 400 else f"I{k // 2}"
        lags = rng.normal(5, 2, 5)
        y = 3 + 0.5 * lags[0] + k * 0.1 + rng.normal(0, 0.5)
        rows.append((f"S{k}", f"d_{i}", float(y), i, i >= 870, item, f"D{k // 10}", "C", f"T{k % 2}", "ST", *[float(v) for v in lags], 11101 + i // 7, i % 7 + 1, i % 12 + 1, 2011 + i // 365, i % 2, 0, 1))
    feats = spark.createDataFrame(rows, SCHEMA)
    train = md.train_set(feats)
    exp_w, exp_b = _closed_form(train.toPandas())
    model = md.fit_ridge(train)
    assert model.levels.where("column = 'item_id'").count() == 15
    got = dict(map(tuple, md.coefficients(model).collect()))
    for name, val in exp_w.items():
        key = name if name in got else name.split("=")[0] + "=*"
        assert got[key] == pytest.approx(val, rel=1e-7, abs=1e-9), name
    assert got["(intercept)"] == pytest.approx(exp_b, rel=1e-7)
    assert all(r["residual"] == 0 for r in md.normal_residual(model, train, digits=8).collect())
    path = scratch_path(spark, "ridge_levels_saved")
    md.save_model(model, path)
    a, b = (sorted(map(tuple, md.predict(m, md.test_set(feats)).collect())) for m in (model, md.load_model(path)))
    assert len(a) == 30 and [r[:3] for r in a] == [r[:3] for r in b]
    assert [r[3] for r in a] == pytest.approx([r[3] for r in b], rel=1e-12)
    with pytest.raises(FileExistsError):
        md.save_model(model, path)
    # the coefficients alone predict the same
    c = sorted(map(tuple, md.predict_by_coefficients(md.coefficients(model), md.test_set(feats)).collect()))
    assert [r[:2] for r in c] == [r[:2] for r in a] and [r[2] for r in c] == pytest.approx([r[3] for r in a], rel=1e-9)


def test_twenty_thousand_stores(spark):
    """More levels than a dense system on one machine could have."""
    n = 20_000
    rows = spark.range(3 * n).select(
        F.expr(f"concat('S', id % {n})").alias("id"), F.expr("concat('d_', id)").alias("d"),
        F.expr(f"cast(2 + (id % {n}) * 0.0001 + (id % 11) * 0.3 + (xxhash64(id) % 1000) / 1000 as double)").alias("sales"), F.expr(f"id div {n} + 1").alias("d_num"), F.lit(False).alias("is_test"),
        F.expr(f"concat('I', (id % {n}) % 11)").alias("item_id"), F.expr(f"concat('D', (id % {n}) % 3)").alias("dept_id"), F.lit("C").alias("cat_id"),
        F.expr(f"concat('T', id % {n})").alias("store_id"), F.expr(f"concat('ST', (id % {n}) % 7)").alias("state_id"),
        *[F.expr(f"cast(xxhash64(id, {k}) % 100 as double) / 50").alias(c) for k, c in enumerate(md.NUMERIC_FEATURES[:5])],
        F.lit(11101).alias("wm_yr_wk"), F.expr("cast(id % 7 as int)").alias("wday"), F.lit(1).alias("month"), F.lit(2011).alias("year"), F.lit(0).alias("snap_CA"), F.lit(0).alias("snap_TX"), F.lit(1).alias("snap_WI"))
    train = md.train_set(spark.createDataFrame(rows.toPandas()))
    model = md.fit_ridge(train)
    assert model.levels.groupBy("column").count().where("column = 'store_id'").first()["count"] == n
    left = md.normal_residual(model, train, digits=9).where("abs(residual) > 1e-9").count()
    assert left == 0


def test_a_system_that_does_not_converge_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(md, "MAX_STEPS", 1)
    rows = [(f"S{i % 6}", f"d_{i}", float(i % 5), i, False, f"I{i % 2}", f"D{i % 3}", "C", "T", "ST", *[float((i * k) % 7) for k in range(1, 6)], 11101, 1, 1, 2011, 0, 0, 1) for i in range(60)]
    with pytest.raises(ArithmeticError, match="1 steps"):
        md.fit_ridge(md.train_set(spark.createDataFrame(rows, SCHEMA)))


def test_saved_model_predicts_the_same(spark):
    from shelfcast.session import scratch_path
    from shelfcast.sources.files import is_committed

    feats = _smoke_fixture(spark)
    model = md.fit_ridge(md.train_set(feats))
    path = scratch_path(spark, "ridge_saved")
    md.save_model(model, path)
    assert is_committed(spark, path)
    a, b = (sorted(map(tuple, md.predict(m, md.test_set(feats)).collect())) for m in (model, md.load_model(path)))
    assert a == b


def test_null_calendar_feature_fails_fit(spark):
    """Q8: a training row whose day had no calendar match keeps NULL time
    features; assembling them is an error, as the original model rejects NaN."""
    feats = _smoke_fixture(spark).withColumn(
        "wm_yr_wk", F.when(F.col("d") == "d_3", F.lit(None).cast("int")).otherwise(F.col("wm_yr_wk"))
    )
    with pytest.raises(Exception, match="(?i)null|nan|invalid"):
        md.fit_ridge(md.train_set(feats))


def test_train_checks_existing_model_before_fitting(spark, monkeypatch):
    """Q13: an existing model without force is refused before any fit runs."""
    from shelfcast.plans import jobs
    from shelfcast.plans.lake import Lake
    from shelfcast.session import scratch_path

    lk = Lake(scratch_path(spark, "train_guard"))
    md.save_model(md.fit_ridge(md.train_set(_smoke_fixture(spark))), lk.model)
    monkeypatch.setattr(md, "fit_ridge", lambda *a, **k: pytest.fail("fit ran before the exists check"))
    with pytest.raises(FileExistsError):
        jobs.run_train(spark, lk)
