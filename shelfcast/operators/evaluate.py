"""Evaluation: error metrics, residuals, residual histogram.

Metrics come from one aggregate pass: R^2's total sum of squares is
``var_pop(y) * n`` (Spark's central-moment aggregate merges partial results
with a numerically stable update), so no second pass over the predictions is
needed for the mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ["MAE", "RMSE", "R2"]
DEFAULT_BINS = 50


def residuals(predictions: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """``y_true - y_pred`` (P23) appended as ``residual``."""
    return predictions.withColumn("residual", F.col(y_true) - F.col(y_pred))


def regression_metrics(predictions: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row ``mae, rmse, r2``.

    R^2 = 1 - SS_res / SS_tot; a constant label (SS_tot = 0) gives 1.0 when
    the fit is perfect and 0.0 otherwise, never -inf/NaN.
    """
    err = F.col(y_true) - F.col(y_pred)
    agg = predictions.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sum(err * err).alias("ss_res"),
        (F.var_pop(y_true) * F.count(y_true)).alias("ss_tot"),
    )
    r2 = (
        F.when(F.col("ss_tot") > 0, F.lit(1.0) - F.col("ss_res") / F.col("ss_tot"))
        .when(F.col("ss_res") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return agg.select("mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def metrics_long(metrics: DataFrame, digits: int | None = None) -> DataFrame:
    """Wide metrics -> rows ``(metric, value)`` with upper-case names."""
    def val(c: str):
        v = F.col(c).cast("double")
        return F.round(v, digits) if digits is not None else v

    return metrics.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), val(m.lower()).alias("value")) for m in METRICS
    ])))


def residual_histogram(resid: DataFrame, column: str = "residual", bins: int = DEFAULT_BINS) -> DataFrame:
    """Equal-width histogram over [min, max] with numpy's bin rules.

    Output: ``bin`` (1..bins), ``bin_lo``, ``bin_hi``, ``n`` -- every bin,
    empty ones with 0.  Bin edges are ``lo + i * (hi - lo) / bins`` with the
    last edge exactly ``hi``; a value goes to ``floor((x - lo) * bins /
    (hi - lo))``, then is moved down/up one bin when it sits on the wrong side
    of an edge, and the last bin is closed.  A constant input widens the
    range to ``[v - 0.5, v + 0.5]``.

    One plan: the range is a scalar subquery (min and max in one aggregate)
    and the counts are a grouped count with map-side partial aggregation (a
    hot bin is pre-counted in every task); nothing runs before the caller's
    action.  ``resid`` is read for both, so it should be a stored table.  The
    bin axis (``range(1, bins + 1)``) is joined on ``bin`` with the counts
    broadcast: an equi-join of at most ``bins`` rows per side.
    """
    nb = int(bins)
    x = F.col(column).cast("double")
    spark = resid.sparkSession
    span = resid.select(F.struct(F.min(x).alias("mn"), F.max(x).alias("mx"))).scalar()
    mn, mx = F.col("span.mn"), F.col("span.mx")
    # no values: numpy's default [0, 1]; equal values: half a unit to each side
    lo = F.when(mn.isNull(), F.lit(0.0)).when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn.isNull(), F.lit(1.0)).when(mn == mx, mx + 0.5).otherwise(mx)

    def ranged(df: DataFrame, own: str) -> DataFrame:
        """``df`` with the range as columns, so that each step below names a
        column and the subquery stands in the plan once."""
        return df.withColumn("span", span).select(own, lo.alias("lo"), hi.alias("hi")).withColumn("step", (F.col("hi") - F.col("lo")) / nb)

    def edge(i):
        return F.when(i >= nb, F.col("hi")).otherwise(F.col("lo") + i * F.col("step"))

    x, i = F.col("x"), F.col("i")
    raw = F.floor((x - F.col("lo")) * (F.lit(float(nb)) / (F.col("hi") - F.col("lo"))))
    counts = (
        ranged(resid.select(F.col(column).cast("double").alias("x")).where(x.isNotNull()), "x")
        .withColumn("i", F.least(raw, F.lit(nb - 1)))
        .withColumn("i", F.when(x < edge(i), i - 1).otherwise(i))
        .withColumn("i", F.when((x >= edge(i + 1)) & (i != nb - 1), i + 1).otherwise(i))
        .select((i + 1).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bins_axis = spark.range(1, nb + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    axis = ranged(bins_axis, "bin").select("bin", edge(F.col("bin") - 1).alias("bin_lo"), edge(F.col("bin")).alias("bin_hi"))
    # counts holds at most ``bins`` rows by construction (bin is clamped to
    # 1..bins): a proven bound, so it is broadcast to the axis.
    return axis.join(F.broadcast(counts), "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )
