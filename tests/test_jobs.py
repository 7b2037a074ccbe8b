"""Stage-level behaviour of the composed jobs on small hand-made lakes."""

import datetime

from shelfcast.plans import jobs
from shelfcast.plans.lake import Lake
from shelfcast.session import scratch_path


def test_silver_records_failing_table_and_continues(spark):
    lk = Lake(scratch_path(spark, "jobs_silver"))
    cal = spark.createDataFrame(
        [(datetime.date(2016, 1, 1), 11101, "Friday", 7, 1, 2016, "d_1", None, None, None, None, 300, 0, 0)],
        jobs.BRONZE_CALENDAR,
    )
    cal.write.parquet(lk.bronze("calendar"))
    spark.createDataFrame([("S", "I", 11101, 1.5)], jobs.BRONZE_SELL_PRICES).write.parquet(lk.bronze("sell_prices"))
    out = {e["table_name"]: e for e in jobs.run_silver(spark, lk, strict=False)}
    assert out["calendar"]["status"] == "error"
    assert "CAST_OVERFLOW" in out["calendar"]["notes"]["error"] or "overflow" in out["calendar"]["notes"]["error"]
    assert out["sell_prices"]["status"] == "ok" and out["sell_prices"]["n_rows"] == 1
    assert out["sales_train_validation"]["status"] == "missing"
    # re-run: finished tables are kept, not rewritten
    again = {e["table_name"]: e["status"] for e in jobs.run_silver(spark, lk, strict=False)}
    assert again["sell_prices"] == "exists"


def test_medallion_stops_at_first_failure(spark):
    lk = Lake(scratch_path(spark, "jobs_empty"))
    rows = {r["stage"]: (r["status"], r["error"]) for r in jobs.run_medallion(spark, lk, through="eval").collect()}
    assert rows["bronze"][0] == "failed" and "missing raw tables" in rows["bronze"][1]
    assert all(rows[s][0] == "skipped" for s in ["silver", "gold", "features", "dq", "train", "eval"])


def test_incremental_bronze_picks_up_only_new_files(spark):
    import os

    from shelfcast.sources.csv import read_csv

    lk = Lake(scratch_path(spark, "jobs_incremental"))
    land = lk.landing("sell_prices")
    local = land[len("file:"):] if land.startswith("file:") else land
    os.makedirs(local)
    with open(os.path.join(local, "part-0.csv"), "w") as f:
        f.write("store_id,item_id,wm_yr_wk,sell_price\nS,I,11101,1.5\nS,J,11101,2.5\n")
    open(os.path.join(local, "_SUCCESS"), "w").close()
    first = {e["table_name"]: e for e in jobs.run_bronze(spark, lk, strict=False, incremental=True)}
    assert first["sell_prices"]["n_rows"] == 2 and first["calendar"]["status"] == "missing"
    with open(os.path.join(local, "part-1.csv"), "w") as f:
        f.write("store_id,item_id,wm_yr_wk,sell_price\nS,K,11102,3.0\n")
    second = {e["table_name"]: e for e in jobs.run_bronze(spark, lk, strict=False, incremental=True)}
    assert second["sell_prices"]["n_rows"] == 3
    got = sorted(tuple(r) for r in spark.read.parquet(lk.bronze("sell_prices")).collect())
    want = sorted(tuple(r) for r in read_csv(spark, land, schema=jobs.BRONZE_SELL_PRICES).collect())
    assert got == want
    # a third run with nothing new appends nothing
    third = {e["table_name"]: e for e in jobs.run_bronze(spark, lk, strict=False, incremental=True)}
    assert third["sell_prices"]["n_rows"] == 3


def _write(path, text):
    import os

    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        f.write(text)


def test_plain_files_are_raw_tables_and_rebuild_follows_them(spark):
    lk = Lake(scratch_path(spark, "jobs_plain"))
    _write(lk.landing("sell_prices"), "store_id,item_id,wm_yr_wk,sell_price\nS,I,11101,1.5\n")
    got = {e["table_name"]: e for e in jobs.run_bronze(spark, lk, strict=False)}
    assert got["sell_prices"]["status"] == "ok" and got["sell_prices"]["n_rows"] == 1
    assert {e["notes"]["inputs"] for e in got.values()} == {"partial"}
    silver = {e["table_name"]: e for e in jobs.run_silver(spark, lk, strict=False)}
    assert silver["sell_prices"]["status"] == "ok"
    kept = {e["table_name"]: e for e in jobs.run_silver(spark, lk, strict=False)}["sell_prices"]
    assert (kept["status"], kept["n_rows"], kept["n_columns"]) == ("exists", 1, 4) and kept["bytes"] > 0
    gold = jobs.run_gold(spark, lk, strict=False)
    assert {e["table_name"]: e["status"] for e in gold} == {"calendar": "missing", "sell_prices": "ok", "sales_train_validation": "missing"}
    _write(lk.landing("sell_prices"), "store_id,item_id,wm_yr_wk,sell_price\nS,I,11101,1.5\nS,J,11101,2.5\n")
    jobs.run_bronze(spark, lk, strict=False, force=True)
    assert {e["table_name"]: e for e in jobs.run_silver(spark, lk, strict=False)}["sell_prices"]["n_rows"] == 2


def _foreign(spark, path, n=9):
    """A folder that somebody else filled, without any commit record."""
    import os

    spark.range(n).write.parquet(path)
    os.remove(os.path.join(path[len("file:"):] if path.startswith("file:") else path, "_SUCCESS"))


def _landed_lake(spark, name):
    """A small whole lake: two series, 70 days."""
    lk = Lake(scratch_path(spark, name))
    days = range(1, 71)
    meta = "id,item_id,dept_id,cat_id,store_id,state_id"
    wide = "\n".join([f"{meta},{','.join(f'd_{n}' for n in days)}", *(f"{s}_1,{s},D,C,S{s},T,{','.join(str((n * k) % 7) for n in days)}" for s, k in (("A", 3), ("B", 5)))])
    for table in ("sales_train_validation", "sales_train_evaluation"):
        _write(lk.landing(table), wide + "\n")
    _write(lk.landing("sample_submission"), "id,F1\nA_1,0\n")
    _write(lk.landing("sell_prices"), "store_id,item_id,wm_yr_wk,sell_price\nSA,A,11101,1.5\n")
    first = datetime.date(2016, 1, 1)
    rows = [f"{first + datetime.timedelta(n - 1)},{11101 + n // 7},Friday,{n % 7 + 1},{n % 12 + 1},2016,d_{n},,,,,{n % 2},0,1" for n in days]
    _write(lk.landing("calendar"), "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI\n" + "\n".join(rows) + "\n")
    return lk


def test_no_job_replaces_a_foreign_folder(spark):
    import pytest

    from shelfcast.sources.versions import current, read_table

    lk = _landed_lake(spark, "jobs_foreign")
    outputs = [lk.bronze("sell_prices"), lk.silver("calendar"), lk.gold("dim_series"), lk.features, lk.model, lk.output("eval_metrics.csv")]
    for path in outputs:
        _foreign(spark, path)
    untouched = lambda: all(spark.read.parquet(p).count() == 9 for p in outputs)
    # bronze, silver and gold keep it
    bronze = {e["table_name"]: e["status"] for e in jobs.run_bronze(spark, lk)}
    assert bronze["sell_prices"] == "exists" and bronze["calendar"] == "ok" and untouched()
    silver = {e["table_name"]: e["status"] for e in jobs.run_silver(spark, lk, strict=False)}
    assert silver["calendar"] == "exists" and silver["sales_train_validation"] == "ok" and silver["sell_prices"] == "missing" and untouched()
    # forced runs publish beside it
    jobs.run_bronze(spark, lk, force=True)
    jobs.run_silver(spark, lk, force=True)
    gold = {e["table_name"]: e["status"] for e in jobs.run_gold(spark, lk)}
    assert gold["dim_series"] == "exists" and gold["fact_sales_long"] == "ok" and untouched()
    jobs.run_gold(spark, lk, force=True)
    assert read_table(spark, lk.gold("dim_series")).count() == 2 and untouched()
    # features, model and outputs are refused
    for run in (jobs.run_features, jobs.run_train, jobs.run_eval):
        with pytest.raises(FileExistsError):
            run(spark, lk)
        assert untouched()
        run(spark, lk, force=True)
        assert untouched()
    assert all(current(spark, p) for p in outputs)


def test_forced_jobs_that_die_leave_the_last_good_tables(spark):
    import pytest

    from shelfcast.operators.features import read_features
    from shelfcast.sources.versions import current, read_table

    lk = _landed_lake(spark, "jobs_dying")
    assert [r["status"] for r in jobs.run_medallion(spark, lk, through="eval").collect()] == ["ok"] * 7
    tables = [lk.bronze("sell_prices"), lk.silver("sell_prices"), lk.gold("fact_sell_prices")]
    before = [current(spark, p) for p in [*tables, lk.features, lk.model, lk.output("predictions.parquet")]]
    rows = [read_table(spark, p).count() for p in tables]
    _write(lk.landing("sell_prices"), "store_id,item_id,wm_yr_wk,sell_price\nSA,A,11101,1.5\nSA,A,week,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        jobs.run_bronze(spark, lk, force=True)
    assert [read_table(spark, p).count() for p in tables] == rows
    # a day twice: the forced feature run fails
    sales = read_table(spark, lk.gold("fact_sales_long"))
    from shelfcast.sources.files import guarded_write

    guarded_write(sales.unionByName(sales.limit(1)), lk.gold("fact_sales_long"), force=True)
    with pytest.raises(Exception, match="two rows of day"):
        jobs.run_features(spark, lk, force=True)
    assert read_features(spark, lk.features).count() == 140
    after = [current(spark, p) for p in [*tables, lk.features, lk.model, lk.output("predictions.parquet")]]
    assert after == before
    # other sample arguments than the last run's are noticed
    lk2 = lk
    kinds = {e["table_name"]: (e["status"], e["n_rows"]) for e in jobs.run_gold(spark, lk2, sample_n_series=1, sample_days=5)}
    assert kinds["fact_sales_long"] == ("ok", 5) and kinds["fact_sell_prices"][0] == "exists"


def test_only_new_files_are_read(spark):
    from shelfcast.sources.versions import current, read_table

    lk = Lake(scratch_path(spark, "jobs_ledger"))
    price = lambda *rows: spark.createDataFrame(list(rows), jobs.BRONZE_SELL_PRICES).coalesce(1).write.mode("append").parquet(lk.bronze("sell_prices"))
    run = lambda **kw: {e["table_name"]: e for e in jobs.run_silver(spark, lk, strict=False, **kw)}["sell_prices"]
    price(("S", "I", 11101, 1.5), ("S", "J", 11101, 2.5))
    first = run()
    assert (first["status"], first["n_rows"], first["notes"]["read_files"]) == ("ok", 2, 1)
    # an old file that could no longer be read is not read
    price(("S", "K", 11102, 3.0))
    second = run()
    assert (second["status"], second["n_rows"], second["notes"]["read_files"]) == ("ok", 3, 1)
    version = current(spark, lk.silver("sell_prices"))
    assert len(version.parts) == 2 and version.parts[0].split("/")[-1].startswith("v000001")
    assert run()["status"] == "exists" and current(spark, lk.silver("sell_prices")) == version
    from shelfcast.operators.audit import fingerprint_text, table_fingerprint

    assert second["fingerprint"] == fingerprint_text(table_fingerprint(read_table(spark, lk.silver("sell_prices"))).first())
    # a file that went away makes all of it new
    import os

    folder = lk.bronze("sell_prices")
    folder = folder[len("file:"):] if folder.startswith("file:") else folder
    gone = sorted(f for f in os.listdir(folder) if f.startswith("part-"))[0]
    os.remove(os.path.join(folder, gone))
    third = run()
    assert third["status"] == "ok" and third["notes"]["read_files"] == 1 and len(current(spark, lk.silver("sell_prices")).parts) == 1
    assert third["n_rows"] == read_table(spark, lk.silver("sell_prices")).count()


def test_new_days_extend_the_features(spark):
    import pytest
    from pyspark.sql import functions as F

    from shelfcast.functions.columns import day_number
    from shelfcast.operators.features import STATE, build_features, read_features
    from shelfcast.sources.versions import current

    rows = [(s, f"d_{n}", (n * k) % 11 if n % 13 else None) for s, k in (("A", 3), ("B", 7), ("C", 5)) for n in range(1, 101) if s != "C" or n <= 60]
    sales = spark.createDataFrame(rows, "id string, d string, sales int")
    cal = spark.createDataFrame([(f"d_{n}", 11101 + n // 7, n % 7 + 1, n % 12 + 1, 2016) for n in range(1, 121)], "d string, wm_yr_wk int, wday int, month int, year int")
    lk = Lake(scratch_path(spark, "jobs_extend"))
    part = lambda lo, hi: sales.where((day_number("d") > lo) & (day_number("d") <= hi))
    part(0, 70).write.parquet(lk.gold("fact_sales_long"))
    cal.write.parquet(lk.gold("dim_calendar"))
    jobs.run_features(spark, lk, horizon=10)
    for lo, hi in ((70, 71), (71, 95), (95, 100)):  # C has no new days; B and A have
        jobs.run_extend_features(spark, lk, part(lo, hi), horizon=10)
        got = read_features(spark, lk.features)
        want = build_features(part(0, hi), cal, 10)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        state = spark.read.parquet(f"{current(spark, lk.features).parts[-1]}/{STATE}")
        assert state.groupBy("id").count().where("count != 28").count() == 0
    # the first version's training rows are still where they were, its test rows are not read
    parts = current(spark, lk.features).parts
    assert any("v000001" in p and p.endswith("is_test=false") for p in parts) and not any("v000001" in f and "is_test=true" in f for f in read_features(spark, lk.features).inputFiles())
    for late in (part(99, 100), part(40, 41)):
        with pytest.raises(Exception, match="before stored days|two rows of day"):
            jobs.run_extend_features(spark, lk, late, horizon=10)
    assert current(spark, lk.features).parts == parts


def test_half_written_model_is_no_model(spark):
    from shelfcast.sources.files import SAVED, create_marker, is_committed

    path = scratch_path(spark, "half_model")
    spark.range(1).write.parquet(f"{path}/metadata")
    assert not is_committed(spark, path)
    create_marker(spark, f"{path}/{SAVED}")
    assert is_committed(spark, path)


def test_eval_checks_all_outputs_first(spark):
    import pytest

    lk = Lake(scratch_path(spark, "jobs_eval_guard"))
    spark.range(1).write.parquet(lk.output("residual_histogram.parquet"))
    with pytest.raises(FileExistsError, match="residual_histogram"):
        jobs.run_eval(spark, lk)


def test_line_items_are_aggregated_before_their_first_exchange(spark, sf_small):
    from shelfcast.plans import retail_fixture as rf

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rf.store_daily(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    scan = next(i for i, x in enumerate(lines) if "lineitem" in x)
    above = [x for x in reversed(lines[:scan]) if "Exchange" in x or "partial_sum" in x]
    assert "partial_sum" in above[0]
