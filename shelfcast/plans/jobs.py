"""Composed user-level jobs (X1-X7) over a ``Lake`` folder layout.

Each stage reads the previous stage's stored tables and writes its own, so a
stage boundary is also a lineage cut: a lost executor re-reads Parquet
instead of recomputing earlier stages.  Each stage returns its audit entries
(one per table) and appends them to the lake's audit log.

Outputs are published as versions (``shelfcast.sources.versions``): a stage
that dies leaves the last good tables, and what somebody else put at an
output's place is never replaced.  Silver and gold tables know the files that
they were made from; what arrived since is added, the rest is not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import evaluate as ev
from shelfcast.operators import gold as gd
from shelfcast.operators import model as md
from shelfcast.operators.audit import add_hashes, append_audit, audit_rows, fingerprint_text, observed_write, stored_bytes, utc_now
from shelfcast.operators.features import DEFAULT_HORIZON, build_features, extend_features, read_features, write_features
from shelfcast.operators.quality import run_gate
from shelfcast.operators.typing import type_table
from shelfcast.plans import retail_fixture as rf
from shelfcast.plans.lake import GOLD_TABLES, RAW_TABLES, Lake
from shelfcast.session import partitions_for
from shelfcast.sources.csv import csv_header, read_csv, wide_schema, write_csv
from shelfcast.sources.files import is_committed, is_input, overall_status
from shelfcast.sources.fs import path_exists
from shelfcast.sources.versions import Draft, current, data_files, increment, is_taken, location, publish, read_table, write_ledger
from shelfcast.streaming.landing import incremental_csv_to_parquet

# Bronze schemas: what CSV type inference yields for the raw M5 files, fixed
# up front so bronze never pays an inference pass.
BRONZE_CALENDAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("d", T.StringType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
    T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()),
    T.StructField("snap_WI", T.IntegerType()),
])
BRONZE_SELL_PRICES = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])


def bronze_schema(spark: SparkSession, table: str, csv_path: str) -> T.StructType:
    if table == "calendar":
        return BRONZE_CALENDAR
    if table == "sell_prices":
        return BRONZE_SELL_PRICES
    header = csv_header(spark, csv_path)
    if table == "sample_submission":
        schema = wide_schema(header, int_prefix="", float_prefix="F")
        return T.StructType([
            T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.FloatType) else f.dataType)
            for f in schema.fields
        ])
    return wide_schema(header, int_prefix="d_")


def _entry(table: str, status: str, path: str, n_rows=None, n_columns=None, started=None,
           fingerprint=None, nbytes=None, **notes) -> dict:
    return {
        "table_name": table,
        "status": status,
        "n_rows": n_rows,
        "n_columns": n_columns,
        "bytes": nbytes,
        "fingerprint": fingerprint,
        "path": path,
        "started_at_utc": started,
        "finished_at_utc": utc_now(),
        "notes": notes,
    }


def land_raw_tables(spark: SparkSession, sf_dir: str, lake: Lake, force: bool = False, tables: list[str] | None = None) -> list[dict]:
    """Write the raw M5-shaped CSV tables derived from the test tables into
    the landing zone (the role of the competition download + unzip): all of
    them, or those named in ``tables``."""
    make = {
        "calendar": rf.calendar,
        "sell_prices": rf.sell_prices,
        # the fixture's evaluation table equals the validation table
        "sales_train_validation": rf.sales_wide,
        "sales_train_evaluation": rf.sales_wide,
        "sample_submission": rf.submission,
    }
    out = []
    for name in make if tables is None else tables:
        started = utc_now()
        df = make[name](spark, sf_dir)
        path = lake.landing(name)
        status = "ok"
        if force or not path_exists(spark, path):
            write_csv(df, path, mode="overwrite" if force else "errorifexists")
        elif is_committed(spark, path):
            status = "exists"
        else:
            raise FileExistsError(f"{path} is there and not complete; pass force=True to replace it")
        out.append(_entry(name, status, path, n_columns=len(df.columns), started=started))
    append_audit(audit_rows(spark, "landing", out), lake.audit)
    return out


def _kept(spark: SparkSession, name: str, path: str, started: str) -> dict:
    """The entry of an output that a job leaves as it is, with its counts if
    it can be read (what somebody else put there may not be Parquet)."""
    try:
        df = read_table(spark, path)
        counts = df.count(), len(df.columns)
    except Exception as exc:
        return _entry(name, "exists", path, started=started, unreadable=str(exc).split("\n")[0])
    return _entry(name, "exists", path, *counts, started, nbytes=stored_bytes(spark, path))


def _carry(spark: SparkSession, stage: str, name: str, src: str, dst: str, make, started: str, force: bool,
           by_row: bool = True, notes: dict | None = None) -> dict:
    """Bring ``dst = make(src)`` up to date and return its entry.

    Where ``make`` works row by row, files that arrived in ``src`` since are
    read alone and become one more part of ``dst``; changed or removed files,
    other ``notes`` or ``force`` make the whole table again.
    """
    before = current(spark, dst)
    if before is None and is_taken(spark, dst) and not force:
        return _kept(spark, name, dst, started)
    lacks = increment(spark, src, dst, notes)
    if lacks.kind == "none" and not force:
        return _kept(spark, name, dst, started)
    added = lacks.kind == "new" and by_row and not force
    draft = Draft(spark, dst)
    # the ledger is written first and says which files are read
    write_ledger(lacks.files if added else data_files(spark, src), draft.folder)
    files = [r["path"] for r in spark.read.parquet(f"{draft.folder}/_ledger").select("path").collect()]
    whole = read_table(spark, src)
    df = make(spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0))
    hashes = observed_write(lambda d: d.write.mode("append").parquet(draft.folder), df, f"{stage}_{name}")
    if added:
        hashes = add_hashes(hashes, before.notes["hashes"])
    draft.publish((notes or {}) | {"hashes": hashes}, list(before.parts) if added else None)
    return _entry(name, "ok", dst, hashes["n_rows"], len(df.columns), started, fingerprint_text(hashes), stored_bytes(spark, dst), read_files=len(files))


def _checked(stage: str, entries: list[dict], strict: bool) -> list[dict]:
    """Note the completeness of a stage's inputs (S17); ``strict`` makes a
    missing one an error."""
    missing = [e["table_name"] for e in entries if e["status"] == "missing"]
    state = overall_status(len(entries) - len(missing), len(entries))
    for e in entries:
        e["notes"]["inputs"] = state
    if strict and missing:
        raise FileNotFoundError(f"{stage}: {state}, missing raw tables {missing}" if stage == "bronze" else f"{stage}: {state}, no input for {missing}")
    return entries


def run_bronze(
    spark: SparkSession,
    lake: Lake,
    force: bool = False,
    strict: bool = True,
    incremental: bool = False,
    tables: list[str] | None = None,
) -> list[dict]:
    """Every expected raw CSV table -> Parquet, skipping finished outputs;
    ``tables`` are those expected, all raw tables by default.

    A raw table is a CSV file or a folder of them.  Status per table: ``ok``
    (copied), ``exists`` (kept), ``missing``; the entries' notes say whether
    the inputs are ``ok``, ``partial`` or ``missing_input``.  Row counts come from an ``Observation`` on the copy itself.

    ``incremental`` runs each copy as an ``availableNow`` file stream with its
    checkpoint in the lake: every run appends only raw files not copied
    before (status ``ok``, rows = the table's size after the run), and an
    interrupted run resumes from its checkpoint.
    """
    out = []
    for name in RAW_TABLES if tables is None else tables:
        started = utc_now()
        src, dst = lake.landing(name), lake.bronze(name)
        if not is_input(spark, src):
            out.append(_entry(name, "missing", dst, started=started))
            continue
        if incremental:
            if is_taken(spark, dst) and not path_exists(spark, f"{dst}/_spark_metadata"):
                raise FileExistsError(f"{dst} was not filled by an incremental copy")
            incremental_csv_to_parquet(
                spark, src, dst, bronze_schema(spark, name, src), checkpoint=lake.checkpoint(f"bronze_{name}")
            )
            stored = spark.read.parquet(dst)
            out.append(_entry(name, "ok", dst, stored.count(), len(stored.columns), started,
                              nbytes=stored_bytes(spark, dst)))
            continue
        if is_taken(spark, dst) and not force:
            out.append(_kept(spark, name, dst, started))
            continue
        df = read_csv(spark, src, schema=bronze_schema(spark, name, src))
        draft = Draft(spark, dst)
        hashes = observed_write(lambda d: d.write.parquet(draft.folder), df, f"bronze_{name}")
        draft.publish({"hashes": hashes})
        out.append(_entry(name, "ok", dst, hashes["n_rows"], len(df.columns), started, fingerprint_text(hashes), stored_bytes(spark, dst),
                          input_bytes=stored_bytes(spark, src)))
    _checked("bronze", out, False)
    append_audit(audit_rows(spark, "bronze", out), lake.audit)
    return _checked("bronze", out, strict)


def run_silver(spark: SparkSession, lake: Lake, force: bool = False, strict: bool = True, tables: list[str] | None = None) -> list[dict]:
    """Type every bronze table, or those of ``tables``; files that arrived in bronze since the last
    run are typed alone.  A failing table is recorded as ``error`` and the
    others continue.  Errors surface at the write (Spark is lazy), so the
    ``try`` wraps the write action."""
    out = []
    for name in RAW_TABLES if tables is None else tables:
        started = utc_now()
        src, dst = lake.bronze(name), lake.silver(name)
        if not is_committed(spark, src):
            out.append(_entry(name, "missing", dst, started=started))
            continue
        try:
            out.append(_carry(spark, "silver", name, src, dst, lambda df, name=name: type_table(name, df), started, force))
        except Exception as exc:  # recorded per table, the stage goes on
            out.append(_entry(name, "error", dst, started=started, error=str(exc)))
    append_audit(audit_rows(spark, "silver", out), lake.audit)
    if strict and any(e["status"] in ("error", "missing") for e in out):
        bad = [(e["table_name"], e["status"]) for e in out if e["status"] in ("error", "missing")]
        raise RuntimeError(f"silver: failed tables {bad}")
    return out


GOLD_INPUTS = ["calendar", "sell_prices", "sales_train_validation"]


def _gold_rules(sample_n_series: int | None, sample_days: int | None) -> dict[str, tuple]:
    """Of each gold table: its silver table, what makes it, whether row by row,
    and the arguments that it depends on."""
    sampled = sample_n_series is not None
    return {
        "dim_calendar": ("calendar", gd.dim_calendar, True, {}),
        "dim_series": ("sales_train_validation", gd.dim_series, False, {}),
        "fact_sell_prices": ("sell_prices", gd.fact_sell_prices, True, {}),
        "fact_sales_long": ("sales_train_validation", lambda wide: gd.sales_long(wide, sample_n_series, sample_days), not sampled,
                            {"sample_n_series": sample_n_series, "sample_days": sample_days}),
    }


def gold_tables(
    spark: SparkSession,
    lake: Lake,
    sample_n_series: int | None = None,
    sample_days: int | None = None,
) -> dict[str, DataFrame]:
    """The four gold tables as DataFrames over the silver layer.

    Defaults keep ALL series and days; the sample arguments reproduce the
    small first-N-series / last-N-days extract.
    """
    rules = _gold_rules(sample_n_series, sample_days)
    return {name: make(read_table(spark, lake.silver(source))) for name, (source, make, *_) in rules.items()}


def run_gold(
    spark: SparkSession,
    lake: Lake,
    force: bool = False,
    sample_n_series: int | None = None,
    sample_days: int | None = None,
    strict: bool = True,
) -> list[dict]:
    """The gold tables.  What arrived in silver since the last run is added;
    other sample arguments than the last run's make the sales anew."""
    started = utc_now()
    absent = [t for t in GOLD_INPUTS if not is_committed(spark, lake.silver(t))]
    if absent:
        out = [_entry(t, "missing" if t in absent else "ok", lake.silver(t), started=started) for t in GOLD_INPUTS]
        _checked("gold", out, False)
        append_audit(audit_rows(spark, "gold", out), lake.audit)
        return _checked("gold", out, strict)
    out = []
    for name, (source, make, by_row, notes) in _gold_rules(sample_n_series, sample_days).items():
        out.append(_carry(spark, "gold", name, lake.silver(source), lake.gold(name), make, utc_now(), force, by_row, notes))
    append_audit(audit_rows(spark, "gold", out), lake.audit)
    return out


def _refuse_existing(spark: SparkSession, force: bool, *paths: str) -> None:
    """Before any work: outputs that are there are only replaced by force."""
    there = [] if force else [p for p in paths if is_taken(spark, p)]
    if there:
        raise FileExistsError(f"already there: {', '.join(there)}; pass force=True to publish anew")


def run_features(
    spark: SparkSession,
    lake: Lake,
    horizon: int = DEFAULT_HORIZON,
    force: bool = False,
    check_unique: bool = True,
) -> list[dict]:
    """Gold long sales + calendar -> stored feature table, clustered by
    series and ordered by day inside each file.  With ``check_unique`` a
    repeated (``id``, ``d``) is an error (it would make lags depend on row
    order)."""
    started = utc_now()
    _refuse_existing(spark, force, lake.features)
    sales = read_table(spark, lake.gold("fact_sales_long"))
    cal = read_table(spark, lake.gold("dim_calendar"))
    # one exchange for windows and files, by the rows (counted from Parquet
    # footers), so that what a task sorts is bounded
    partitions = partitions_for(spark, sales.count())
    feats = build_features(sales.repartition(partitions, "id"), cal, horizon, check_unique=check_unique)
    publish(spark, lake.features, lambda folder: write_features(feats, folder, partitions=partitions), force=True, notes={"horizon": horizon})
    stored = read_features(spark, lake.features)
    stats = stored.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).first()
    out = [_entry("fact_sales_features", "ok", lake.features, int(stats["n"]), len(stored.columns), started,
                  n_test=int(stats["t"]), horizon=horizon)]
    append_audit(audit_rows(spark, "build_features", out), lake.audit)
    return out


def run_extend_features(spark: SparkSession, lake: Lake, new_sales: DataFrame, horizon: int = DEFAULT_HORIZON) -> list[dict]:
    """X4 for new days: carry the stored feature table forward.

    ``new_sales`` has the columns of the gold sales fact and only days after
    those that a series has.  Read are the new rows, the last rows of each
    series and the test rows, not the history.
    """
    started = utc_now()
    cal = read_table(spark, lake.gold("dim_calendar"))
    n = extend_features(spark, lake.features, new_sales, cal, horizon)
    out = [_entry("fact_sales_features", "ok", lake.features, None, None, started, horizon=horizon, written_rows=n)]
    append_audit(audit_rows(spark, "extend_features", out), lake.audit)
    return out


def run_dq(spark: SparkSession, lake: Lake, horizon: int = DEFAULT_HORIZON, enforce: bool = True) -> dict:
    """Gate on the stored feature table."""
    started = utc_now()
    report = run_gate(read_features(spark, lake.features), horizon, enforce=enforce)
    append_audit(audit_rows(spark, "dq", [_entry("fact_sales_features", report["status"], lake.features,
                                                 report.get("n_rows"), None, started,
                                                 n_test=report.get("n_test"),
                                                 expected_test=report.get("expected_test"))]), lake.audit)
    return report


def run_train(spark: SparkSession, lake: Lake, horizon: int = DEFAULT_HORIZON, force: bool = False,
              alpha: float = md.DEFAULT_ALPHA) -> dict:
    """Fit the ridge baseline on the training rows and store the model.
    The output check happens BEFORE fitting."""
    started = utc_now()
    _refuse_existing(spark, force, lake.model)  # a half-written model is none
    feats = read_features(spark, lake.features)
    model = md.fit_ridge(md.train_set(feats), alpha)
    publish(spark, lake.model, lambda folder: md.save_model(model, folder), force=True)
    summary = md.train_summary(feats, horizon).first().asDict()
    append_audit(audit_rows(spark, "train", [_entry("model", "ok", lake.model, summary["n_train_used"], None,
                                                    started, total_rows=summary["n_rows"], horizon=horizon)]),
                 lake.audit)
    return summary


def run_eval(spark: SparkSession, lake: Lake, horizon: int = DEFAULT_HORIZON, force: bool = False) -> dict:
    """Predictions on test rows, metrics, residual histogram; all written
    by the executors (CSV for predictions and metrics).  All outputs are
    checked before any work."""
    started = utc_now()
    names = ("predictions.parquet", "eval_predictions.csv", "eval_metrics.csv", "residual_histogram.parquet")
    _refuse_existing(spark, force, *map(lake.output, names))
    feats = read_features(spark, lake.features)
    test = md.test_set(feats)
    if test.isEmpty():
        raise ValueError("After dropping NULL features the test set is empty")
    model = md.load_model(location(spark, lake.model))
    preds = md.predict(model, test)
    # all outputs are written before the first is published
    drafts = {name: Draft(spark, lake.output(name)) for name in names}
    preds.write.parquet(drafts["predictions.parquet"].folder)
    stored = spark.read.parquet(drafts["predictions.parquet"].folder)
    write_csv(stored, drafts["eval_predictions.csv"].folder)
    metrics = ev.regression_metrics(stored)
    write_csv(ev.metrics_long(metrics), drafts["eval_metrics.csv"].folder)
    ev.residual_histogram(ev.residuals(stored)).write.parquet(drafts["residual_histogram.parquet"].folder)
    for draft in drafts.values():
        draft.publish()
    m = metrics.first().asDict()
    counts = {"predictions.parquet": stored, "eval_predictions.csv": stored, "eval_metrics.csv": ev.metrics_long(metrics),
              "residual_histogram.parquet": spark.read.parquet(drafts["residual_histogram.parquet"].folder)}
    entries = [_entry(name.split(".")[0], "ok", lake.output(name), df.count(), len(df.columns), started,
                      nbytes=stored_bytes(spark, drafts[name].folder), **m) for name, df in counts.items()]
    append_audit(audit_rows(spark, "eval", entries), lake.audit)
    return m


STAGES = ["bronze", "silver", "gold", "features", "dq", "train", "eval"]


def run_medallion(
    spark: SparkSession,
    lake: Lake,
    through: str = "gold",
    force: bool = False,
    horizon: int = DEFAULT_HORIZON,
) -> DataFrame:
    """Stages in order up to ``through``; stop at the first failure, later
    stages ``skipped``.  Returns one summary row per stage:
    ``stage, status, n_tables, n_rows, error``."""
    last = STAGES.index(through)
    runners = {
        "bronze": lambda: run_bronze(spark, lake, force=force),
        "silver": lambda: run_silver(spark, lake, force=force),
        "gold": lambda: run_gold(spark, lake, force=force),
        "features": lambda: run_features(spark, lake, horizon, force=force),
        "dq": lambda: run_dq(spark, lake, horizon),
        "train": lambda: run_train(spark, lake, horizon, force=force),
        "eval": lambda: run_eval(spark, lake, horizon, force=force),
    }
    rows = []
    failed = False
    for stage in STAGES[: last + 1]:
        if failed:
            rows.append((stage, "skipped", None, None, None))
            continue
        try:
            res = runners[stage]()
            if isinstance(res, list):
                bad = [e for e in res if e["status"] not in ("ok", "exists")]
                n_rows = sum(int(e["n_rows"] or 0) for e in res)
                rows.append((stage, "failed" if bad else "ok", len(res), n_rows, None))
                failed = bool(bad)
            else:
                rows.append((stage, res.get("status", "ok"), 1, res.get("n_rows"), None))
                failed = res.get("status", "ok") not in ("ok", "exists")
        except Exception as exc:
            rows.append((stage, "failed", None, None, str(exc)))
            failed = True
    schema = "stage string, status string, n_tables int, n_rows bigint, error string"
    return spark.createDataFrame(rows, schema)


__all__ = [
    "GOLD_TABLES",
    "RAW_TABLES",
    "STAGES",
    "Lake",
    "bronze_schema",
    "gold_tables",
    "land_raw_tables",
    "run_bronze",
    "run_dq",
    "run_eval",
    "run_features",
    "run_gold",
    "run_medallion",
    "run_silver",
    "run_train",
]
