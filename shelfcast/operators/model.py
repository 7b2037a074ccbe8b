"""Ridge baseline.

Minimises ``||y - Xw - b||^2 + alpha ||w||^2`` with an unpenalised intercept
over 13 numeric features and the one-hot levels of six categorical columns, at
any number of levels.

Three blocks of the normal equations are treated each in its own way:

* the series column ``id``: given all else, the effect of a series with ``n``
  rows is ``(sum of its residuals) / (n + alpha)``.  The block is diagonal and
  is eliminated; effects come out as a table;
* the intercept and the numeric features, 14 numbers: their block is dense and
  small, and is eliminated by the driver;
* the levels of the other columns, any number of them: what is left is solved
  by conjugate gradients with a diagonal preconditioner.  Weights, residuals
  and directions are tables with one row a level, and so is everything that is
  known of a level beside them.

A step of the iteration multiplies by the level block without forming it.  The
training rows enter as sums for each series and combination of levels
(``groups``, made once).  With the direction joined to the levels of a group, a
group of series ``i`` has ``q`` = the sum over its levels, and every level gets
back, summed over its groups, ``n (q - sum_i(n q) / (n_i + alpha))``.  That is an
equi-join, one exchange by series and one by level; the scalars of a step are
aggregates.  The table of a step is written to the shared folder, so lineage
does not grow and a lost executor repeats one step.

The iteration ends when the residual has fallen by ``TOLERANCE``.  The residual
that counts is then computed anew from the solution; if it is above, the
iteration starts again from there, and a system that does not converge in
``MAX_STEPS`` is an error.

Numeric features are centred by their training means, and columns without
variance (a constant number, a single level) are left out; ridge gives them a
zero coefficient.  A NULL level is no level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import require_columns
from shelfcast.operators.features import FEATURE_COLUMNS
from shelfcast.operators.quality import REQUIRED_COLUMNS
from shelfcast.session import scratch_path
from shelfcast.sources.files import SAVED, create_marker, path_exists

# Fixed feature contract: 13 numeric (passed through unscaled) then 6 categorical.
NUMERIC_FEATURES = [
    "lag_1", "lag_7", "lag_28", "roll_mean_7", "roll_mean_28",
    "d_num", "wm_yr_wk", "wday", "month", "year", "snap_CA", "snap_TX", "snap_WI",
]
CATEGORICAL_FEATURES = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
DEFAULT_ALPHA = 1.0
SERIES = "id"
#: The columns whose levels are solved for by iteration.
LEVELED = [c for c in CATEGORICAL_FEATURES if c != SERIES]
TOLERANCE = 1e-12
MAX_STEPS = 2_000
INTERCEPT = "(intercept)"


def _split(features: DataFrame, test: bool) -> DataFrame:
    require_columns(features, REQUIRED_COLUMNS, "features")
    require_columns(features, MODEL_FEATURES, "features")
    flag = F.col("is_test") if test else ~F.col("is_test")
    return (
        features.where(flag)
        .dropna(subset=FEATURE_COLUMNS)
        .select("id", "d", *[c for c in MODEL_FEATURES if c != "id"], F.col("sales").cast("double").alias("label"))
    )


def train_set(features: DataFrame) -> DataFrame:
    """Rows not in the test horizon with all five lag features."""
    return _split(features, test=False)


def test_set(features: DataFrame) -> DataFrame:
    """Test-horizon rows with all five lag features."""
    return _split(features, test=True)



@dataclass(frozen=True)
class RidgeModel:
    """``weights`` of the intercept (of centred features) and of the numeric
    features that vary, whose training means are ``centers``; tables ``levels``
    (``column, level, weight``) and ``series`` (``id, effect``)."""

    weights: dict[str, float]
    centers: dict[str, float]
    levels: DataFrame
    series: DataFrame


def _centred(centers: dict[str, float]) -> dict[str, Column]:
    return {c: F.col(c).cast("double") - F.lit(m) for c, m in centers.items()}


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, "ridge", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dot(a: Column, b: list[float]) -> Column:
    return sum((F.element_at(a, i + 1) * F.lit(float(x)) for i, x in enumerate(b)), F.lit(0.0))


def _sums(column: Column, n: int, sign: Column | None = None) -> list[Column]:
    """Sums over the ``n`` entries of an array column."""
    return [F.sum(F.element_at(column, i + 1) * sign if sign is not None else F.element_at(column, i + 1)) for i in range(n)]


def _statistics(train: DataFrame) -> tuple[int, dict[str, float], list[str], bool]:
    """Rows, means of the numeric features that vary, the leveled columns with
    more than one level, and whether there are several series."""
    numbers = [F.count(F.lit(1)).alias("n")]
    for c in NUMERIC_FEATURES:
        numbers += [(F.max(c) > F.min(c)).alias(f"varies_{c}"), F.count(c).alias(f"known_{c}"), F.avg(c).alias(f"mean_{c}")]
    row = train.agg(*numbers).first()
    if not row["n"]:
        raise ValueError("no training rows: all rows lack lag features or belong to the test days")
    unknown = [c for c in NUMERIC_FEATURES if row[f"known_{c}"] < row["n"]]
    if unknown:
        raise ValueError(f"NULL values in the training rows' {unknown}")
    centers = {c: float(row[f"mean_{c}"]) for c in NUMERIC_FEATURES if row[f"varies_{c}"]}
    # minima of strings keep an aggregate from hashing: over distinct levels alone
    several = train.select(*CATEGORICAL_FEATURES).distinct().agg(*[(F.max(c) > F.min(c)).alias(c) for c in CATEGORICAL_FEATURES]).first()
    return int(row["n"]), centers, [c for c in LEVELED if several[c]], bool(several[SERIES])


class _Reduced:
    """The normal equations after the series are eliminated: ``groups`` (one
    row for each series, combination of levels and level), the ``dense`` block
    of the intercept and the numbers with its ``right`` side, and for each
    level its right side ``r0``, its ``diagonal`` and its products ``b`` with
    the dense block."""

    def __init__(self, train: DataFrame, alpha: float, x: dict[str, Column], leveled: list[str], n: int, several_series: bool):
        self.alpha, self.width = alpha, 1 + len(x)
        numeric = list(x.values())
        vector = lambda entries: F.array(*entries).cast("array<double>")
        sums = [F.count(F.lit(1)).cast("double").alias("n"), F.sum("label").alias("t"), *[F.sum(e).alias(f"s{i}") for i, e in enumerate(numeric)]]
        groups = train.groupBy(SERIES, *leveled).agg(*sums)
        groups = groups.select(SERIES, *leveled, "n", "t", vector([F.col("n"), *[F.col(f"s{i}") for i in range(len(x))]]).alias("v"))
        groups = _stored(groups.withColumn("g", F.monotonically_increasing_id()), "groups")
        share = F.lit(1.0) / (F.sum("n") + F.lit(float(alpha))) if several_series else F.lit(0.0)
        self.series = _stored(groups.groupBy(SERIES).agg(
            F.sum("n").alias("n"), F.sum("t").alias("total"), vector(_sums(F.col("v"), self.width)).alias("total_v"), share.alias("share")), "series")

        # products of the numbers over all rows, less what the series explain
        at = range(self.width)
        ones = [F.lit(1.0), *numeric]
        whole = train.agg(*[F.sum(ones[i] * ones[j]).alias(f"a{i}_{j}") for i in at for j in at if i <= j], *[F.sum(ones[i] * F.col("label")).alias(f"y{i}") for i in at]).first()
        total_v = lambda i: F.element_at("total_v", i + 1)
        told = self.series.agg(*[F.sum(total_v(i) * total_v(j) * F.col("share")).alias(f"a{i}_{j}") for i in at for j in at if i <= j],
                               *[F.sum(total_v(i) * F.col("total") * F.col("share")).alias(f"y{i}") for i in at]).first()
        self.dense = np.array([[whole[f"a{min(i, j)}_{max(i, j)}"] - told[f"a{min(i, j)}_{max(i, j)}"] for j in at] for i in at])
        self.dense += np.diag([0.0] + [float(alpha)] * len(x))
        self.right = np.array([whole[f"y{i}"] - told[f"y{i}"] for i in at])
        self.levels = None
        if not leveled:
            return
        level = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in leveled])).alias("l")
        of_series = groups.join(self.series.select(SERIES, "share", "total", "total_v"), SERIES)
        rows = of_series.select(SERIES, "g", "n", "t", "v", "share", "total", "total_v", level).where("l.level is not null").select("*", "l.column", "l.level").drop("l")
        own = F.col("n") * F.col("share")
        facts = rows.groupBy("column", "level").agg(
            F.sum(F.col("t") - own * F.col("total")).alias("r0"), (F.sum(F.col("n") * (F.lit(1.0) - own)) + F.lit(float(alpha))).alias("diagonal"),
            vector([F.sum(F.element_at("v", i + 1) - own * F.element_at("total_v", i + 1)) for i in at]).alias("b"))
        self.levels = _stored(facts, "levels")
        self.groups = _stored(rows.select(SERIES, "g", "n", "share", "column", "level"), "entries")

    def solve_dense(self, right: np.ndarray) -> np.ndarray:
        # scaled to a unit diagonal, as features differ by orders of magnitude
        scale = 1 / np.sqrt(np.maximum(np.diag(self.dense), 1e-300))
        return scale * np.linalg.solve(self.dense * scale[:, None] * scale[None, :], right * scale)

    def times(self, levels: DataFrame, column: str) -> tuple[DataFrame, dict[str, float]]:
        """``levels`` with ``product``, the level block times their ``column``
        before the dense block is eliminated, and sums over all levels: of
        ``column * product`` (``pp``) and of ``column`` times ``b``."""
        joined = self.groups.join(levels.select("column", "level", F.col(column).alias("p")), ["column", "level"])
        series = Window.partitionBy(SERIES)
        joined = joined.withColumn("q", F.sum("p").over(Window.partitionBy(SERIES, "g")))
        joined = joined.withColumn("all", F.sum(F.col("n") * F.col("p")).over(series))
        back = joined.groupBy("column", "level").agg(F.sum(F.col("n") * (F.col("q") - F.col("all") * F.col("share"))).alias("own"))
        out = levels.join(back, ["column", "level"]).withColumn("product", F.col("own") + F.lit(float(self.alpha)) * F.col(column)).drop("own")
        seen = Observation()
        b = [F.sum(F.col(column) * F.element_at("b", i + 1)).alias(f"b{i}") for i in range(self.width)]
        out = _stored(out.observe(seen, F.sum(F.col(column) * F.col("product")).alias("pp"), *b), "step")
        return out, seen.get

    def _sum_b(self, sums: dict[str, float]) -> np.ndarray:
        return np.array([sums[f"b{i}"] for i in range(self.width)])

    def residual(self, levels: DataFrame) -> DataFrame:
        """``levels`` with the residual ``r`` of their weights ``x``."""
        out, sums = self.times(levels, "x")
        dense = self.solve_dense(self.right - self._sum_b(sums))
        return out.withColumn("r", F.col("r0") - F.col("product") - _dot(F.col("b"), dense)).drop("product")

    def solve(self) -> tuple[np.ndarray, DataFrame | None]:
        """Weights of the dense block, and of the levels as a table."""
        if self.levels is None:
            return self.solve_dense(self.right), None
        size = lambda df: float(df.agg(F.sum(F.col("r") * F.col("r") / F.col("diagonal"))).first()[0] or 0.0)
        start = self.solve_dense(self.right)
        levels = _stored(self.levels.withColumn("x", F.lit(0.0)).withColumn("r", F.col("r0") - _dot(F.col("b"), start)), "start")
        # what the right side is made of, before it cancels
        scale = float(levels.agg(F.sum(F.col("r0") * F.col("r0") / F.col("diagonal"))).first()[0] or 0.0)
        goal, steps = TOLERANCE**2 * scale, 0
        now = size(levels)
        while now > goal:
            before, begun = None, now
            state = levels.withColumn("p", F.col("r") / F.col("diagonal"))
            while now > goal:
                steps += 1
                if steps > MAX_STEPS:
                    raise ArithmeticError(f"ridge: the residual is {(now / scale) ** 0.5:.1e} of the right side after {MAX_STEPS} steps")
                made, sums = self.times(state, "p")
                along = self.solve_dense(self._sum_b(sums))
                step = now / (sums["pp"] - float(self._sum_b(sums) @ along))
                made = made.withColumn("x", F.col("x") + F.lit(step) * F.col("p"))
                made = made.withColumn("r", F.col("r") - F.lit(step) * (F.col("product") - _dot(F.col("b"), along.tolist()))).drop("product")
                before, now = now, size(made)
                state = made.withColumn("p", F.col("r") / F.col("diagonal") + F.lit(now / before) * F.col("p"))
            # the residual of the solution itself, not of the recurrence
            levels = _stored(self.residual(state.drop("p", "r")), "solution")
            now = size(levels)
            if now > 0.25 * begun:
                if now > 1e4 * goal:
                    raise ArithmeticError(f"ridge: the residual stays at {(now / scale) ** 0.5:.1e} of the right side")
                break  # as far as double precision goes
        sums = levels.agg(*[F.sum(F.col("x") * F.element_at("b", i + 1)).alias(f"b{i}") for i in range(self.width)]).first().asDict()
        return self.solve_dense(self.right - self._sum_b(sums)), levels.select("column", "level", F.col("x").alias("weight"))


def fit_ridge(train: DataFrame, alpha: float = DEFAULT_ALPHA) -> RidgeModel:
    """Fit the ridge baseline (X5's core)."""
    n, centers, leveled, several_series = _statistics(train)
    x = _centred(centers)
    reduced = _Reduced(train, alpha, x, leveled, n, several_series)
    dense, levels = reduced.solve()
    effects = reduced.series
    dot = _dot(F.col("total_v"), dense.tolist())
    if levels is None:
        levels = train.sparkSession.createDataFrame([], "column string, level string, weight double")
    else:
        levels = _stored(levels, "weights")
        told = reduced.groups.join(levels, ["column", "level"]).groupBy(SERIES).agg(F.sum(F.col("n") * F.col("weight")).alias("told"))
        effects = effects.join(told, SERIES, "left")
        dot = dot + F.coalesce("told", F.lit(0.0))
    effects = _stored(effects.select(SERIES, ((F.col("total") - dot) * F.col("share")).alias("effect")), "effects")
    return RidgeModel(dict(zip([INTERCEPT, *x], dense.tolist(), strict=True)), centers, levels, effects)


def transform(model: RidgeModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``prediction`` (M4): equi-joins with the series' effects
    and with the weights of each column's levels; the planner broadcasts what
    is small.  Unseen levels and series count nothing."""
    out = rows.join(model.series, SERIES, "left")
    value = F.lit(model.weights[INTERCEPT]) + F.coalesce("effect", F.lit(0.0))
    for c, e in _centred(model.centers).items():
        value = value + F.lit(model.weights[c]) * e
    for c in LEVELED:
        own = model.levels.where(F.col("column") == c).select(F.col("level").alias(c), F.col("weight").alias(f"_w_{c}"))
        out = out.join(own, c, "left")
        value = value + F.coalesce(f"_w_{c}", F.lit(0.0))
    return out.withColumn("prediction", value).select(*rows.columns, "prediction")


def predict(model: RidgeModel, test: DataFrame) -> DataFrame:
    """M4 + M5: ``id, d, y_true, y_pred``."""
    return transform(model, test).select("id", "d", F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))


def coefficients(model: RidgeModel) -> DataFrame:
    """``feature, coefficient``: every numeric feature, ``column=level`` for
    every level, ``column=*`` with 0 for columns of a single level, and the
    ``(intercept)`` of the features as they are."""
    spark = model.series.sparkSession
    w = model.weights
    rows = [(c, w.get(c, 0.0)) for c in NUMERIC_FEATURES]
    rows.append((INTERCEPT, w[INTERCEPT] - sum(w[c] * m for c, m in model.centers.items())))
    own = spark.createDataFrame(rows, "feature string, coefficient double")
    leveled = model.levels.select(F.concat_ws("=", "column", "level").alias("feature"), F.col("weight").alias("coefficient"))
    single = spark.createDataFrame([(c,) for c in LEVELED], "column string").join(model.levels, "column", "left_anti")
    single = single.select(F.concat("column", F.lit("=*")).alias("feature"), F.lit(0.0).alias("coefficient"))
    series = model.series.select(F.concat(F.lit("id="), F.col(SERIES)).alias("feature"), F.col("effect").alias("coefficient"))
    return own.unionByName(leveled).unionByName(single).unionByName(series)


def predict_by_coefficients(table: DataFrame, rows: DataFrame) -> DataFrame:
    """M4 a second way: ``id, d, y_pred`` from the ``feature, coefficient``
    table alone.  Every row is unpivoted to its features and values, joined to
    the coefficients and summed."""
    one = lambda name, value: F.struct(name.alias("feature"), value.cast("double").alias("value"))
    entries = [one(F.lit(c), F.col(c)) for c in NUMERIC_FEATURES] + [one(F.concat(F.lit(f"{c}="), F.col(c)), F.lit(1.0)) for c in CATEGORICAL_FEATURES]
    entries.append(one(F.lit(INTERCEPT), F.lit(1.0)))
    long = rows.select("id", "d", F.inline(F.array(*entries)))
    # rows of one feature are many: both sides get an exchange for the join, which may split them
    return long.join(table, "feature").groupBy("id", "d").agg(F.sum(F.col("value") * F.col("coefficient")).alias("y_pred"))


def normal_residual(model: RidgeModel, train: DataFrame, alpha: float = DEFAULT_ALPHA, digits: int = 6) -> DataFrame:
    """``feature, residual``: the normal equations ``x'(y - Xw - b) - alpha w``
    of every feature per training row, rounded; all are 0 at the optimum."""
    fitted = transform(model, train).withColumn("r", F.col("label") - F.col("prediction"))
    x = {c: F.col(c).cast("double") - F.lit(m) for c, m in model.centers.items()}
    numeric = fitted.agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("r"), *[F.sum(F.col("r") * e).alias(c) for c, e in x.items()])
    w = model.weights
    values = {INTERCEPT: F.col("r")} | {c: F.col(c) - F.lit(alpha * w[c]) if c in x else F.lit(0.0) for c in NUMERIC_FEATURES}
    out = numeric.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (v / F.col("n")).alias("value")) for c, v in values.items()])).alias("f")).select("f.*")
    n = train.select(F.count(F.lit(1))).scalar()
    table = coefficients(model)
    for c in CATEGORICAL_FEATURES:
        sums = fitted.groupBy(F.concat(F.lit(f"{c}="), F.col(c)).alias("feature")).agg(F.sum("r").alias("r"))
        left = sums.join(table, "feature", "left")
        out = out.unionByName(left.select("feature", ((F.col("r") - alpha * F.coalesce("coefficient", F.lit(0.0))) / n).alias("value")))
    return out.select("feature", (F.round("value", digits) + F.lit(0.0)).alias("residual"))


def train_summary(features: DataFrame, horizon: int) -> DataFrame:
    """M6: ``n_rows, n_train_used, horizon`` in one aggregate."""
    usable = ~F.col("is_test")
    for c in FEATURE_COLUMNS:
        usable = usable & F.col(c).isNotNull()
    return features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(usable).alias("n_train_used"),
    ).select("n_rows", "n_train_used", F.lit(int(horizon)).cast("bigint").alias("horizon"))


def save_model(model: RidgeModel, path: str) -> None:
    """S15 sink: the weights, the levels' weights and the series' effects as
    Parquet, and a marker after them that says the model is whole.  A folder
    that is there already, whoever wrote it, is not touched."""
    spark = model.series.sparkSession
    base = path.rstrip("/")
    if path_exists(spark, base):
        raise FileExistsError(f"{base} is there already")
    rows = [(k, v, model.centers.get(k)) for k, v in model.weights.items()]
    spark.createDataFrame(rows, "feature string, weight double, center double").write.parquet(f"{base}/weights")
    model.levels.write.parquet(f"{base}/levels")
    model.series.write.parquet(f"{base}/series")
    create_marker(spark, f"{base}/{SAVED}")


def load_model(path: str, spark: SparkSession | None = None) -> RidgeModel:
    spark = spark or SparkSession.active()
    base = path.rstrip("/")
    rows = spark.read.parquet(f"{base}/weights").collect()  # one for each number
    centers = {r["feature"]: r["center"] for r in rows if r["center"] is not None}
    return RidgeModel({r["feature"]: r["weight"] for r in rows}, centers, spark.read.parquet(f"{base}/levels"), spark.read.parquet(f"{base}/series"))
