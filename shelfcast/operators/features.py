"""Per-series lag / rolling features, the last-horizon test split and the
calendar join (P14-P16, W1-W6, J1, L1).

Plan shape: ONE hash exchange on ``id`` and one sort on (``id``, ``d_num``)
feed every window below (all share the same partitioning and ordering).  The
calendar has a row per day whatever the data, so the planner finds it far below
its broadcast threshold and the window output is not reshuffled; there is no
hint, a calendar above the threshold would be joined by a shuffle.

A window partition holds one series, i.e. at most one row per day of the
calendar; its size is bounded by the calendar length whatever the data volume
(M5: 1,941 days; the test fixture: 2,499), so no series can grow into a
straggler task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.columns import day_number, require_columns
from shelfcast.sources.fs import path_exists
from shelfcast.sources.versions import Draft, current, version_folder

# Fixed values of the feature contract.
LAGS = [1, 7, 28]
ROLLING_WINDOWS = [7, 28]
FEATURE_COLUMNS = ["lag_1", "lag_7", "lag_28", "roll_mean_7", "roll_mean_28"]
CALENDAR_FEATURES = ["d", "wm_yr_wk", "wday", "month", "year", "snap_CA", "snap_TX", "snap_WI"]
SNAP_COLUMNS = ["snap_CA", "snap_TX", "snap_WI"]
TIME_COLUMNS = ["wm_yr_wk", "wday", "month", "year"]
DEFAULT_HORIZON = 28


def series_window() -> Window:
    return Window.partitionBy("id").orderBy("d_num")


def lag_feature(n: int, value: str = "sales") -> Column:
    """Value ``n`` rows earlier in the same series (row-based: gaps in
    ``d_num`` are not filled)."""
    return F.lag(value, n).over(series_window()).cast("double")


def rolling_mean_feature(n: int, value: str = "sales") -> Column:
    """Mean of the ``n`` PREVIOUS rows; NULL unless all ``n`` exist and are
    non-NULL (a pandas ``shift(1).rolling(n).mean()``)."""
    frame = series_window().rowsBetween(-n, -1)
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


#: Types whose sums over a whole series are exact in a bigint.
_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType)


def _add_running_sums(df: DataFrame, value: str = "sales") -> DataFrame:
    """``_before`` and ``_known``, sum and number of the non-NULL values of all
    rows before in the same series, and ``_last_day``; one step a row each."""
    before = series_window().rowsBetween(Window.unboundedPreceding, -1)
    whole = series_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        F.coalesce(F.sum(value).over(before), F.lit(0)).alias("_before"),
        F.count(value).over(before).alias("_known"),
        F.max("d_num").over(whole).alias("_last_day"),
    )


def _mean_of_running_sums(n: int) -> Column:
    """``rolling_mean_feature`` as a difference of two running sums: the work
    of a row does not grow with ``n``."""
    earlier = lambda c: F.lag(c, n).over(series_window())
    total = F.col("_before") - earlier("_before")
    return F.when(F.col("_known") - earlier("_known") == n, total.cast("double") / F.lit(float(n)))


def test_flag(horizon: int) -> Column:
    """Last ``horizon`` days of each series: ``d_num >= max(d_num) - (h - 1)``."""
    h = int(horizon)
    return F.col("d_num") >= F.max("d_num").over(Window.partitionBy("id")) - (h - 1)


def add_day_number(sales: DataFrame) -> DataFrame:
    return sales.withColumn("d_num", day_number("d"))


def once_per_day() -> Column:
    """``d_num``; the job fails on a day that its series has twice.

    The previous row comes from the windows' own partitioning and order, so
    the check costs no shuffle.
    """
    twice = F.lag("d_num").over(series_window()) == F.col("d_num")
    message = F.concat(F.lit("series "), F.col("id"), F.lit(" has two rows of day "), F.col("d"))
    return F.when(twice, F.raise_error(message).cast("bigint")).otherwise(F.col("d_num"))


def add_series_features(sales: DataFrame, horizon: int = DEFAULT_HORIZON, check_unique: bool = False) -> DataFrame:
    """W1-W6 on a long sales table with ``id, d, sales`` (any numeric sales).

    Lags count rows, so with a repeated day they would depend on the rows'
    order; ``check_unique`` makes such a table an error.  Rolling means of whole
    numbers are differences of running sums, which are exact; for other types a
    difference would round, and each mean is taken from its own rows.
    """
    require_columns(sales, ["id", "d", "sales"], "sales")
    df = add_day_number(sales)
    days = [once_per_day().alias("d_num") if check_unique and c == "d_num" else F.col(c) for c in df.columns]
    if isinstance(df.schema["sales"].dataType, _WHOLE_TYPES):
        df = _add_running_sums(df)
        mean, is_test = _mean_of_running_sums, F.col("d_num") >= F.col("_last_day") - (int(horizon) - 1)
    else:
        mean, is_test = rolling_mean_feature, test_flag(horizon)
    return df.select(
        *days,
        *[lag_feature(n).alias(f"lag_{n}") for n in LAGS],
        *[mean(n).alias(f"roll_mean_{n}") for n in ROLLING_WINDOWS],
        is_test.alias("is_test"),
    )


def calendar_features(calendar: DataFrame) -> DataFrame:
    """Those of the 8 calendar feature columns that exist; ``d`` is mandatory."""
    keep = [c for c in CALENDAR_FEATURES if c in calendar.columns]
    if "d" not in keep:
        raise ValueError("the calendar has no column 'd' to join the sales by")
    return calendar.select(*keep)


def build_features(
    sales: DataFrame,
    calendar: DataFrame,
    horizon: int = DEFAULT_HORIZON,
    check_unique: bool = False,
) -> DataFrame:
    """The feature table: long sales + ``d_num``, lags, rolling means,
    ``is_test`` and the calendar's time / SNAP columns (X4).

    The calendar join is a left equi-join on ``d`` (unmatched days keep NULL
    calendar columns).  Missing SNAP columns default to 0; missing time
    columns are an error.
    """
    feats = add_series_features(sales, horizon, check_unique)
    out = feats.join(calendar_features(calendar), "d", "left")
    missing_snap = {c: F.lit(0) for c in SNAP_COLUMNS if c not in out.columns}
    if missing_snap:
        out = out.withColumns(missing_snap)
    missing_time = [c for c in TIME_COLUMNS if c not in out.columns]
    if missing_time:
        raise ValueError(f"the calendar brought no {missing_time}")
    return out


def features_for_write(features: DataFrame, partitions: int | None = None) -> DataFrame:
    """Layout for the stored feature table: clustered by series and ordered by
    day within each file (L1) -- no global sort needed.  Rows that are already
    dealt into ``partitions`` by series stay where they are."""
    dealt = features.repartition(partitions, "id") if partitions else features.repartition("id")
    return dealt.sortWithinPartitions("id", "d_num")


def write_features(features: DataFrame, path: str, mode: str = "errorifexists", partitions: int | None = None) -> None:
    """Store the feature table in folders by ``is_test``: what reads the last
    ``horizon`` days of each series then reads only them."""
    features_for_write(features, partitions).write.mode(mode).partitionBy("is_test").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A stored feature table, published or a plain folder; filters on
    ``is_test`` select folders."""
    now = current(spark, path)
    if now is None:
        out = spark.read.parquet(path)
    else:
        by_version: dict[str, list[str]] = {}
        for part in now.parts:
            by_version.setdefault(version_folder(path, part), []).append(part)
        out = None
        for folder, parts in by_version.items():
            one = spark.read.option("basePath", folder).parquet(*parts)
            out = one if out is None else out.unionByName(one)
    return out.withColumn("is_test", F.col("is_test").cast("boolean"))


# --- new days ----------------------------------------------------------------------

STATE = "_state"


def last_rows(sales: DataFrame, n: int = max(LAGS + ROLLING_WINDOWS)) -> DataFrame:
    """The last ``n`` rows of each series: all that features of later days see."""
    place = Window.partitionBy("id").orderBy(F.desc("_day"))
    rows = sales.withColumn("_day", day_number("d")).withColumn("_nth", F.row_number().over(place))
    return rows.where(F.col("_nth") <= n).drop("_day", "_nth")


def last_stored_rows(stored: DataFrame, columns: list[str], n: int = max(LAGS + ROLLING_WINDOWS)) -> DataFrame:
    """``last_rows`` of a stored feature table, mostly from its test rows.

    Test rows are the last days of their series.  Where these are ``n`` rows or
    all that there are, the last ``n`` are among them; only of other series the
    rows before are read and sorted.
    """
    is_test = F.coalesce("is_test", F.lit(False))
    counts = stored.select("id", is_test.alias("t")).groupBy("id").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("t").alias("n_test"))
    short = counts.where((F.col("n_test") < n) & (F.col("n_test") < F.col("n_all"))).select(F.col("id").alias("_short"))
    rows = stored.where("is_test").select(*columns)
    if not short.isEmpty():
        rows = rows.unionByName(stored.where(~is_test).join(short, F.col("id").eqNullSafe(F.col("_short")), "left_semi").select(*columns))
    return last_rows(rows, n)


def new_features(state: DataFrame, new_sales: DataFrame, calendar: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """Features of ``new_sales``, given the last rows of each series.

    A new row must lie after all rows of its series, else lags would have to
    change that are stored already: an error.
    """
    both = state.withColumn("_new", F.lit(False)).unionByName(new_sales.select(*state.columns).withColumn("_new", F.lit(True)))
    out = build_features(both, calendar, horizon, check_unique=True)
    late = F.max(F.when(~F.col("_new"), F.col("d_num"))).over(Window.partitionBy("id")) > F.col("d_num")
    message = F.concat(F.lit("series "), F.col("id"), F.lit(": day "), F.col("d"), F.lit(" lies before stored days"))
    out = out.withColumn("d_num", F.when(F.col("_new") & late, F.raise_error(message).cast("bigint")).otherwise(F.col("d_num")))
    return out.where("_new").drop("_new")


def extend_features(spark: SparkSession, path: str, new_sales: DataFrame, calendar: DataFrame, horizon: int = DEFAULT_HORIZON) -> int:
    """Carry a published feature table forward by new days; returns the rows
    written.

    The version before keeps its training folders.  The new one adds the new
    rows and, as the last ``horizon`` days have moved, the rows that were test
    rows: some now belong to the training rows.  The last rows of each series
    are stored beside the data for the next time; the first time they are
    taken from the table.
    """
    before = current(spark, path)
    if before is None:
        raise FileNotFoundError(f"no published feature table at {path}")
    stored = read_features(spark, path)
    columns = [c for c in new_sales.columns if c in stored.columns]
    state_at = f"{before.parts[-1]}/{STATE}"
    state = spark.read.parquet(state_at) if path_exists(spark, state_at) else last_stored_rows(stored, columns)
    draft = Draft(spark, path)
    # the new state is written first and read by none of what follows
    last_rows(state.select(*columns).unionByName(new_sales.select(*columns))).write.parquet(f"{draft.folder}/{STATE}")
    added = new_features(state.select(*columns), new_sales, calendar, horizon)
    moving = stored.where("is_test").unionByName(added).drop("is_test").withColumn("is_test", test_flag(horizon)).select(*stored.columns)
    seen = Observation()
    write_features(moving.observe(seen, F.count(F.lit(1)).alias("n")), draft.folder, mode="append")
    train = [p if p.endswith("/is_test=false") else f"{p}/is_test=false" for p in before.parts]
    draft.publish(before.notes | {"horizon": horizon}, [p for p in train if path_exists(spark, p)])
    return int(seen.get["n"])
