"""DuckDB oracle SQL for the query catalog.

Each statement recomputes, from the raw test tables (pre-registered views
``lineitem part supplier nation region``), what the matching Spark query
computes -- the fixture derivation is repeated as CTEs, with the same fixed
values as ``retail_fixture``.  Every computed column carries an explicit
``AS`` alias equal to the Spark column name.
"""

from __future__ import annotations

from shelfcast.plans import retail_fixture as rf
from shelfcast.plans.lake import RAW_TABLES

_SIZED = ", ".join(f"'{x}'" for x in rf.SIZED_ITEMS)
_EVENT_NAME = " ".join(f"WHEN '{md}' THEN '{name}'" for md, name, _ in rf.EVENTS)
_EVENT_TYPE = " ".join(f"WHEN '{md}' THEN '{kind}'" for md, _, kind in rf.EVENTS)
_DAYN = f"date_diff('day', DATE '{rf.EPOCH}', {{x}})"


def _dayn(x: str) -> str:
    return _DAYN.format(x=x)


BASE = f"""
stores AS (
  SELECT s.s_suppkey AS l_suppkey, n.n_name AS store_id, r.r_name AS state_id
  FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
li AS (
  SELECT CASE WHEN p.p_partkey < {rf.PARTS_PER_ITEM} THEN p.p_type
              ELSE p.p_type || '_' || CAST(p.p_partkey // {rf.PARTS_PER_ITEM} AS VARCHAR) END AS item_id, st.store_id, st.state_id, CAST(l.l_shipdate AS DATE) AS dt,
         l.l_quantity AS qty, l.l_extendedprice / l.l_quantity AS unit_price
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN stores st ON l.l_suppkey = st.l_suppkey
),
observed AS (
  SELECT item_id, store_id, state_id, dt, CAST(sum(qty) AS INTEGER) AS sales
  FROM li GROUP BY item_id, store_id, state_id, dt
),
bounds AS (SELECT min(dt) AS lo, max(dt) AS hi FROM observed),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt FROM bounds),
series AS (SELECT DISTINCT item_id, store_id, state_id FROM observed),
dense_dt AS (
  SELECT s.item_id || '_' || s.store_id AS id,
         s.item_id AS item_id,
         CASE WHEN split_part(s.item_id, '_', 1) IN ({_SIZED}) THEN 'SIZED' ELSE 'RANGE' END AS dept_id,
         '{rf.CATEGORY}' AS cat_id,
         s.store_id AS store_id,
         s.state_id AS state_id,
         'd_' || CAST({_dayn('dd.dt')} AS VARCHAR) AS d,
         COALESCE(o.sales, 0) AS sales,
         dd.dt AS dt
  FROM series s
  CROSS JOIN days dd
  LEFT JOIN observed o
    ON o.item_id = s.item_id AND o.store_id = s.store_id AND o.state_id = s.state_id AND o.dt = dd.dt
),
dense AS (SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, sales FROM dense_dt),
calendar AS (
  SELECT dt AS "date",
         CAST({rf.FIRST_WEEK} + {_dayn('dt')} // 7 AS INTEGER) AS wm_yr_wk,
         dayname(dt) AS weekday,
         CAST((dayofweek(dt) + 1) % 7 + 1 AS SMALLINT) AS wday,
         CAST(month(dt) AS SMALLINT) AS "month",
         CAST(year(dt) AS SMALLINT) AS "year",
         'd_' || CAST({_dayn('dt')} AS VARCHAR) AS d,
         CASE strftime(dt, '%m-%d') {_EVENT_NAME} END AS event_name_1,
         CASE strftime(dt, '%m-%d') {_EVENT_TYPE} END AS event_type_1,
         CAST(NULL AS VARCHAR) AS event_name_2,
         CAST(NULL AS VARCHAR) AS event_type_2,
         CAST(CASE WHEN day(dt) <= 10 THEN 1 ELSE 0 END AS TINYINT) AS snap_CA,
         CAST(CASE WHEN day(dt) <= 15 AND day(dt) % 2 = 1 THEN 1 ELSE 0 END AS TINYINT) AS snap_TX,
         CAST(CASE WHEN day(dt) BETWEEN 2 AND 15 AND day(dt) % 3 <> 1 THEN 1 ELSE 0 END AS TINYINT) AS snap_WI
  FROM days
),
prices AS (
  SELECT store_id, item_id,
         CAST({rf.FIRST_WEEK} + {_dayn('dt')} // 7 AS INTEGER) AS wm_yr_wk,
         CAST(max(unit_price) AS FLOAT) AS sell_price
  FROM li GROUP BY ALL
)"""


def _features(horizon: int = 28, calendar: str = "calendar", snap: bool = True) -> str:
    w = "PARTITION BY id ORDER BY d_num"
    snap_cols = (
        "c.snap_CA AS snap_CA, c.snap_TX AS snap_TX, c.snap_WI AS snap_WI"
        if snap else "0 AS snap_CA, 0 AS snap_TX, 0 AS snap_WI"
    )
    return f"""
f0 AS (SELECT *, CAST(replace(d, 'd_', '') AS BIGINT) AS d_num FROM dense),
f1 AS (
  SELECT *,
    CAST(lag(sales, 1) OVER ({w}) AS DOUBLE) AS lag_1,
    CAST(lag(sales, 7) OVER ({w}) AS DOUBLE) AS lag_7,
    CAST(lag(sales, 28) OVER ({w}) AS DOUBLE) AS lag_28,
    CASE WHEN count(sales) OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
         THEN avg(sales) OVER ({w} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS roll_mean_7,
    CASE WHEN count(sales) OVER ({w} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) = 28
         THEN avg(sales) OVER ({w} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) END AS roll_mean_28,
    d_num >= max(d_num) OVER (PARTITION BY id) - {int(horizon) - 1} AS is_test
  FROM f0
),
features AS (
  SELECT f1.*, c.wm_yr_wk AS wm_yr_wk, c.wday AS wday, c."month" AS "month", c."year" AS "year",
         {snap_cols}
  FROM f1 LEFT JOIN {calendar} c ON f1.d = c.d
)"""


def with_base(*ctes: str) -> str:
    return "WITH " + ",".join([BASE, *ctes])


FEATURES = with_base(_features())

_LAGS = ["lag_1", "lag_7", "lag_28", "roll_mean_7", "roll_mean_28"]
_NUMERIC = _LAGS + ["d_num", "wm_yr_wk", "wday", "\"month\"", "\"year\"", "snap_CA", "snap_TX", "snap_WI"]
_CATEG = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
_ALL_LAGS_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in _LAGS)

_LAG7_PRED = f"""
preds AS (
  SELECT id, d, CAST(sales AS DOUBLE) AS y_true, lag_7 AS y_pred
  FROM features WHERE is_test AND {_ALL_LAGS_PRESENT}
)"""

_HIST = """
, st AS (SELECT min(r) AS mn, max(r) AS mx FROM resid),
rng AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
               CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM st),
b0 AS (SELECT r, lo, hi, (hi - lo) / 50 AS step,
              least(CAST(floor((r - lo) * (50.0 / (hi - lo))) AS BIGINT), 49) AS i0
       FROM resid, rng WHERE r IS NOT NULL),
b1 AS (SELECT r, lo, hi, step,
              CASE WHEN r < (CASE WHEN i0 >= 50 THEN hi ELSE lo + i0 * step END) THEN i0 - 1 ELSE i0 END AS i1
       FROM b0),
b2 AS (SELECT CASE WHEN r >= (CASE WHEN i1 + 1 >= 50 THEN hi ELSE lo + (i1 + 1) * step END) AND i1 <> 49
                   THEN i1 + 1 ELSE i1 END AS i2
       FROM b1),
cnt AS (SELECT CAST(i2 + 1 AS INTEGER) AS bin, count(*) AS n FROM b2 GROUP BY 1),
axis AS (SELECT CAST(g AS INTEGER) AS bin FROM generate_series(1, 50) t(g))
SELECT a.bin AS bin,
       CASE WHEN a.bin - 1 >= 50 THEN hi ELSE lo + (a.bin - 1) * ((hi - lo) / 50) END AS bin_lo,
       CASE WHEN a.bin >= 50 THEN hi ELSE lo + a.bin * ((hi - lo) / 50) END AS bin_hi,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM axis a CROSS JOIN rng LEFT JOIN cnt c ON a.bin = c.bin"""


def _dq_stats(h: int = 28) -> str:
    nas = ", ".join(f"count(*) FILTER (WHERE is_test AND {c} IS NULL) AS na_{c}" for c in _LAGS)
    return f"""
dq AS (
  SELECT count(*) AS n_rows, count(DISTINCT id) AS n_series,
         count(*) FILTER (WHERE is_test) AS n_test, {nas}
  FROM features
)"""


# The day range of the test tables' ship dates, d_1 to d_2499 at every scale.
_WIDE_DAYS = range(1, 2500)
_WIDE = """, listed AS (
  SELECT id, item_id, dept_id, cat_id, store_id, state_id,
         list(sales ORDER BY CAST(replace(d, 'd_', '') AS INTEGER)) AS s
  FROM dense GROUP BY ALL
)
SELECT id, item_id, dept_id, cat_id, store_id, state_id, """ + ", ".join(f"s[{i + 1}] AS d_{n}" for i, n in enumerate(_WIDE_DAYS)) + " FROM listed"


_SUB_COLS = ", ".join(
    f"CAST(max(sales) FILTER (WHERE n = mx - {rf.SUBMISSION_DAYS} + {k}) AS FLOAT) AS F{k}"
    for k in range(1, rf.SUBMISSION_DAYS + 1)
)

_CAL_INFERRED = """SELECT "date", wm_yr_wk, weekday, CAST(wday AS INTEGER) AS wday, CAST("month" AS INTEGER) AS "month",
  CAST("year" AS INTEGER) AS "year", d, event_name_1, event_type_1, event_name_2, event_type_2,
  CAST(snap_CA AS INTEGER) AS snap_CA, CAST(snap_TX AS INTEGER) AS snap_TX, CAST(snap_WI AS INTEGER) AS snap_WI
FROM calendar"""

_DIM_CAL = """SELECT *, COALESCE(weekday IN ('Saturday', 'Sunday'), false) AS is_weekend,
  event_name_1 IS NOT NULL AS is_event_day FROM calendar"""


def _fingerprint(table: str, sql: str, columns: list[str], floats: tuple[str, ...]) -> str:
    """The multiset hash of a table: sums of the halves of MD5s of canonical row texts."""

    def text(c: str) -> str:
        col = f'"{c}"'
        t = f"CAST({col} AS VARCHAR)"
        if c in floats:
            x = f"CAST({col} AS DOUBLE)"
            t = f"CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR) || '+' || CAST(CAST(floor(({x} - floor({x})) * 4503599627370496) AS BIGINT) AS VARCHAR)"
        return f"coalesce(length({t}) || ':' || {t}, '-')"

    half = lambda start: f"CAST(coalesce(sum(CAST(CAST('0x' || substr(h, {start}, 16) AS UBIGINT) AS HUGEINT)), 0) AS VARCHAR)"
    return (f"SELECT '{table}' AS table_name, count(*) AS n_rows, {half(1)} AS hash_hi, {half(17)} AS hash_lo "
            f"FROM (SELECT md5({' || '.join(map(text, columns))}) AS h FROM ({sql}))")


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    q["features"] = FEATURES + "\nSELECT * FROM features"
    q["lag_features"] = FEATURES + "\nSELECT id, d, d_num, sales, lag_1, lag_7, lag_28 FROM features"
    q["rolling_features"] = FEATURES + "\nSELECT id, d, d_num, roll_mean_7, roll_mean_28 FROM features"
    q["train_test_split"] = FEATURES + "\nSELECT id, d, d_num, is_test FROM features"
    q["day_number"] = with_base() + "\nSELECT id, d, CAST(replace(d, 'd_', '') AS BIGINT) AS d_num FROM dense"
    q["features_calendar_join"] = FEATURES + (
        '\nSELECT id, d, wm_yr_wk, wday, "month", "year", snap_CA, snap_TX, snap_WI FROM features'
    )
    q["features_missing_snap"] = with_base(_features(snap=False)) + (
        "\nSELECT id, d, snap_CA, snap_TX, snap_WI FROM features"
    )
    # data-quality gate
    q["dq_summary"] = with_base(_features(), _dq_stats()) + (
        "\nSELECT n_rows, n_series, n_test, CAST(28 AS BIGINT) AS horizon, n_series * 28 AS expected_test FROM dq"
    )
    q["dq_test_nulls"] = with_base(_features(), _dq_stats()) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, na_{c} AS n_null FROM dq" for c in _LAGS
    )
    na_total = " + ".join(f"na_{c}" for c in _LAGS)
    q["dq_report"] = with_base(_features(), _dq_stats()) + f"""
SELECT 'required_columns' AS "check", true AS passed, CAST(0 AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected FROM dq
UNION ALL SELECT 'not_empty', n_rows > 0, n_rows, 1 FROM dq
UNION ALL SELECT 'test_size', n_test = n_series * 28, n_test, n_series * 28 FROM dq
UNION ALL SELECT 'engineered_columns', true, 0, 0 FROM dq
UNION ALL SELECT 'test_nulls', ({na_total}) = 0, {na_total}, 0 FROM dq"""
    q["not_null_tests"] = FEATURES + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"count(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM features"
        for c in ["id", "d", "sales", "is_test"]
    )
    # gold
    q["dim_calendar"] = with_base() + "\n" + _DIM_CAL
    q["dim_series"] = with_base() + "\nSELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM dense"
    q["fact_sell_prices"] = with_base() + "\nSELECT store_id, item_id, wm_yr_wk, sell_price FROM prices"
    q["sales_long_full"] = with_base() + "\nSELECT * FROM dense"
    q["sales_long_sample"] = with_base() + """
, ids AS (SELECT DISTINCT id FROM dense ORDER BY id LIMIT 20),
  lastd AS (SELECT max(CAST(replace(d, 'd_', '') AS BIGINT)) AS mx FROM dense)
SELECT dense.* FROM dense JOIN ids USING (id), lastd
WHERE CAST(replace(d, 'd_', '') AS BIGINT) > mx - 365"""
    # silver
    q["silver_calendar"] = with_base() + "\nSELECT * FROM calendar"
    q["silver_sell_prices"] = q["fact_sell_prices"]
    q["silver_sales_wide"] = with_base() + _WIDE
    q["silver_sales_evaluation"] = q["silver_sales_wide"]
    q["bronze_sales_wide"] = q["silver_sales_wide"]
    q["bronze_sell_prices"] = with_base() + (
        "\nSELECT store_id, item_id, wm_yr_wk, sell_price FROM prices"
    )
    q["silver_submission"] = with_base() + f"""
, nd AS (SELECT id, CAST(replace(d, 'd_', '') AS INTEGER) AS n, sales FROM dense),
  m AS (SELECT max(n) AS mx FROM nd)
SELECT id, {_SUB_COLS} FROM nd, m WHERE n > mx - {rf.SUBMISSION_DAYS} GROUP BY id"""
    q["parse_date"] = with_base() + '\nSELECT d, "date" FROM calendar'
    # sources / sinks
    q["csv_scan"] = with_base() + "\n" + _CAL_INFERRED
    q["bronze_csv_to_parquet"] = q["csv_scan"]
    q["bronze_incremental"] = q["csv_scan"]
    q["guarded_write"] = q["dim_calendar"]
    q["guarded_write_fail"] = q["dim_calendar"]
    q["forced_write_survives_failure"] = q["silver_sell_prices"]
    q["silver_incremental"] = q["silver_sell_prices"]
    q["gold_incremental"] = q["sales_long_full"]
    q["sales_long_from_lines"] = q["sales_long_full"]
    q["features_extended"] = q["features"]
    q["first_rows_in_file_order"] = with_base() + "\nSELECT * FROM dense ORDER BY id, d LIMIT 1000"
    q["input_completeness"] = with_base() + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, 'ok' AS status, 'ok' AS overall_status FROM bounds" for t in RAW_TABLES
    )
    counts = """
, size AS (
  SELECT (SELECT count(*) FROM calendar) AS n_days, (SELECT count(*) FROM prices) AS n_prices,
         (SELECT count(*) FROM series) AS n_series, (SELECT count(*) FROM dense) AS n_long
)
"""
    raw = [("calendar", "n_days", "14"), ("sell_prices", "n_prices", "4"), ("sales_train_validation", "n_series", "n_days + 6"),
           ("sales_train_evaluation", "n_series", "n_days + 6"), ("sample_submission", "n_series", "29")]
    gold = [("dim_calendar", "n_days", "16"), ("dim_series", "n_series", "6"), ("fact_sell_prices", "n_prices", "4"), ("fact_sales_long", "n_long", "8")]
    stages = [("landing", t, "NULL", c) for t, _, c in raw] + [(stage, *t) for stage in ("bronze", "silver") for t in raw] + [("gold", *t) for t in gold]
    q["stage_audit"] = with_base() + counts + "\nUNION ALL\n".join(
        f"SELECT '{stage}' AS pipeline, '{t}' AS table_name, 'ok' AS status, CAST({n} AS BIGINT) AS n_rows, "
        f"CAST({c} AS INTEGER) AS n_columns FROM size" for stage, t, n, c in stages
    )
    raw_rows = " + ".join(n for _, n, _ in raw)
    gold_rows = " + ".join(n for _, n, _ in gold)
    runs = [("bronze", 5, raw_rows), ("silver", 5, raw_rows), ("gold", 4, gold_rows), ("features", 1, "n_long"), ("dq", 1, "n_long"),
            ("train", 1, "n_series * n_days"), ("eval", 1, "NULL")]
    q["medallion_run"] = with_base() + counts + "\nUNION ALL\n".join(
        f"SELECT '{stage}' AS stage, 'ok' AS status, {n} AS n_tables, CAST({rows} AS BIGINT) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM size"
        for stage, n, rows in runs
    )
    q["table_profile"] = with_base() + """
SELECT 'dim_calendar' AS table_name, count(*) AS n_rows, 16 AS n_columns FROM calendar
UNION ALL SELECT 'dim_series', count(*), 6 FROM (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM dense)
UNION ALL SELECT 'fact_sell_prices', count(*), 4 FROM prices
UNION ALL SELECT 'fact_sales_long', count(*), 8 FROM dense"""
    tables = {"dim_calendar": (_DIM_CAL, [*rf.CALENDAR_COLUMNS, "is_weekend", "is_event_day"], ()),
              "dim_series": ("SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM dense", rf.META_COLUMNS, ()),
              "fact_sell_prices": ("SELECT * FROM prices", ["store_id", "item_id", "wm_yr_wk", "sell_price"], ("sell_price",)),
              "fact_sales_long": ("SELECT * FROM dense", [*rf.META_COLUMNS, "d", "sales"], ())}
    q["table_fingerprint"] = with_base() + "\n" + "\nUNION ALL\n".join(_fingerprint(name, *t) for name, t in tables.items())
    q["stg_features_view"] = q["features"]
    # model inputs and evaluation
    num = ", ".join(_NUMERIC)
    cat = ", ".join(_CATEG)
    for name, cond in (("train_set", "NOT is_test"), ("test_set", "is_test")):
        q[name] = FEATURES + f"""
SELECT id, d, {num}, {cat}, CAST(sales AS DOUBLE) AS label
FROM features WHERE {cond} AND {_ALL_LAGS_PRESENT}"""
    q["train_summary"] = FEATURES + f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT is_test AND {_ALL_LAGS_PRESENT}) AS n_train_used,
       CAST(28 AS BIGINT) AS horizon FROM features"""
    plain = [c.strip('"') for c in _NUMERIC] + ["(intercept)"]
    q["ridge_normal_residual"] = FEATURES + "\n" + "\nUNION ALL\n".join(
        [f"SELECT '{c}' AS feature, CAST(0.0 AS DOUBLE) AS residual FROM bounds" for c in plain]
        + [f"SELECT DISTINCT '{c}=' || {c}, CAST(0.0 AS DOUBLE) FROM features WHERE NOT is_test AND {_ALL_LAGS_PRESENT}" for c in ["id", *_CATEG]]
    )
    q["prediction_difference"] = FEATURES + f"""
SELECT id, d, CAST(0.0 AS DOUBLE) AS difference FROM features WHERE is_test AND {_ALL_LAGS_PRESENT}"""
    q["predictions_csv"] = with_base(_features(), _LAG7_PRED) + "\nSELECT id, d, y_true, y_pred FROM preds"
    q["residuals"] = with_base(_features(), _LAG7_PRED) + (
        "\nSELECT id, d, y_true, y_pred, y_true - y_pred AS residual FROM preds"
    )
    q["eval_metrics"] = with_base(_features(), _LAG7_PRED) + """
, agg AS (
  SELECT avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
         sum((y_true - y_pred) * (y_true - y_pred)) AS ss_res, var_pop(y_true) * count(y_true) AS ss_tot
  FROM preds
),
m AS (
  SELECT mae, rmse,
         CASE WHEN ss_tot > 0 THEN 1.0 - ss_res / ss_tot WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END AS r2
  FROM agg
)
SELECT 'MAE' AS metric, round(mae, 6) AS value FROM m
UNION ALL SELECT 'RMSE', round(rmse, 6) FROM m
UNION ALL SELECT 'R2', round(r2, 6) FROM m"""
    q["residual_histogram"] = with_base(_features(), _LAG7_PRED, "resid AS (SELECT y_true - y_pred AS r FROM preds)") + (
        _HIST
    )
    return q
