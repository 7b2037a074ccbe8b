"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from shelfcast.operators.quality import duplicate_series_days
from shelfcast.plans import retail_fixture as rf


def _plan(df) -> str:
    df.collect()  # finalise the adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_lineitem_scan_is_pruned_and_preaggregated(spark, sf_small):
    df = rf.store_daily(spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    schema = scan.split("ReadSchema: ")[1]
    assert schema.count(":") == 5  # partkey, suppkey, quantity, extendedprice, shipdate
    # the (item, supplier, day) pre-aggregate sits below the supplier join
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = optimized.index("Join Inner")
    assert "Aggregate [item_id" in optimized[join_at:]


def test_duplicate_days_detected(spark):
    df = spark.createDataFrame([("A", "d_1", 1), ("A", "d_1", 2), ("A", "d_2", 1)], "id string, d string, sales int")
    assert [tuple(r) for r in duplicate_series_days(df).collect()] == [("A", "d_1", 2)]


def test_dense_sales_has_no_cartesian_product(spark, sf_small):
    plan = _plan(rf.dense_sales(spark, sf_small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Generate explode(sequence(" in plan


def test_stored_features_filter_pushdown_and_pruning(spark, sf_small):
    from shelfcast.operators import model as md
    from shelfcast.operators.features import read_features
    from shelfcast.operators.quality import dq_summary
    from shelfcast.plans.catalog import lake

    feats = read_features(spark, lake(spark, sf_small, "features").features)
    plan = md.test_set(feats)._jdf.queryExecution().executedPlan().toString()
    assert "is_test" in plan.split("PartitionFilters: [")[1].split("]")[0]
    summary_plan = dq_summary(feats)._jdf.queryExecution().executedPlan().toString()
    read_schema = summary_plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read_schema == "struct<id:string>"


def test_evaluation_reads_the_test_folder_alone(spark, sf_small):
    from shelfcast.plans import catalog

    for name in ("test_set", "residuals", "eval_metrics", "residual_histogram"):
        plan = catalog.queries()[name](spark, sf_small)._jdf.queryExecution().toString()
        physical = plan[plan.index("== Physical Plan =="):]
        scans = [x for x in physical.split("\n") if "FileScan parquet" in x or "Scan parquet" in x]
        assert scans and all("PartitionFilters: [" in x and "is_test" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans if "is_test" in x), name


def test_histogram_runs_nothing_at_plan_time(spark, sf_small):
    from shelfcast.operators import evaluate as ev

    df = spark.range(10).select(F.raise_error(F.lit("ran")).cast("double").alias("residual"))
    ev.residual_histogram(df)  # would raise if it ran a job
    same = ev.residual_histogram(spark.createDataFrame([(2.0,), (2.0,)], "residual double"), bins=4).orderBy("bin").collect()
    assert [(r["bin_lo"], r["n"]) for r in same] == [(1.5, 0), (1.75, 0), (2.0, 2), (2.25, 0)]
    none = ev.residual_histogram(spark.createDataFrame([], "residual double"), bins=2).orderBy("bin").collect()
    assert [(r["bin_lo"], r["bin_hi"], r["n"]) for r in none] == [(0.0, 0.5, 0), (0.5, 1.0, 0)]
