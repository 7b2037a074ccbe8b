"""Work that grows with the rows is dealt by the rows, and only what is asked for is built."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast import session
from shelfcast.operators import audit as au
from shelfcast.operators.features import add_series_features, last_rows, last_stored_rows, read_features, rolling_mean_feature, write_features
from shelfcast.plans import catalog, jobs
from shelfcast.plans import retail_fixture as rf
from shelfcast.plans.lake import RAW_TABLES, Lake
from shelfcast.session import scratch_path


def _observed(spark, monkeypatch):
    day = lambda n: dt.date(1995, 1, 1) + dt.timedelta(n)
    rows = [
        ("A", "S", "T", day(3), 5), ("A", "S", "T", day(6), 2),  # a gap, and days before it
        ("B", "S", "T", day(2), 1), ("B", "S", "T", day(7), None),
        (None, "S", "T", day(4), 9),  # a key that is NULL has no sales
        ("C", "S", "T", None, 7),  # nor has a day that is NULL
    ]
    table = spark.createDataFrame(rows, "item_id string, store_id string, state_id string, dt date, sales int")
    monkeypatch.setattr(rf, "observed_sales", lambda spark, sf_dir: table)


def test_days_between_sales_are_filled_without_a_join(spark, monkeypatch):
    _observed(spark, monkeypatch)
    dense = rf.dense_sales(spark, "none")
    assert "Join" not in dense._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["item_id"], r["d"]): r["sales"] for r in dense.collect()}
    sold = {("A", "d_3"): 5, ("A", "d_6"): 2, ("B", "d_2"): 1}
    assert got == {(item, f"d_{n}"): sold.get((item, f"d_{n}"), 0) for item in ("A", "B", "C", None) for n in range(2, 8)}


def test_no_days_at_all(spark, monkeypatch):
    none = spark.createDataFrame([("A", "S", "T", None, 7)], "item_id string, store_id string, state_id string, dt date, sales int")
    monkeypatch.setattr(rf, "observed_sales", lambda spark, sf_dir: none)
    assert rf.dense_sales(spark, "none").count() == 0


def test_partitions_follow_the_rows(spark, monkeypatch):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.partitions_for(spark, 0) == few
    assert session.partitions_for(spark, 400 * session.TASK_ROWS + 1) == 401


def test_stored_features_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    lk = Lake(scratch_path(spark, "dealt"))
    days = spark.range(60).select(F.concat(F.lit("d_"), F.col("id") + 1).alias("d"))
    series = spark.range(40).select(F.concat(F.lit("X_"), "id").alias("id"))
    sales = series.crossJoin(days).select("id", *[F.lit("x").alias(c) for c in ("item_id", "dept_id", "cat_id", "store_id", "state_id")], "d", F.lit(1).alias("sales"))
    cal = days.select("d", *[F.lit(1).alias(c) for c in ("wm_yr_wk", "wday", "month", "year", "snap_CA", "snap_TX", "snap_WI")])
    sales.write.parquet(lk.gold("fact_sales_long"))
    cal.write.parquet(lk.gold("dim_calendar"))
    jobs.run_features(spark, lk)
    stored = read_features(spark, lk.features)
    assert stored.count() == 2_400 and stored.groupBy("id").agg(F.count_if("is_test").alias("n")).where("n != 28").isEmpty()
    files = {f.rsplit("/", 1)[-1] for f in stored.inputFiles()}
    assert len(files) > int(spark.conf.get("spark.sql.shuffle.partitions"))  # 24 partitions by the rows


def test_a_query_of_one_raw_table_builds_that_alone(spark, sf_small, tmp_path):
    import shutil

    sf = str(tmp_path / "sf")
    shutil.copytree(sf_small, sf)
    assert catalog.queries()["dim_calendar"](spark, sf).count() > 0
    lk = catalog.lake(spark, sf, "landing", ["calendar"])
    there = lambda place: [t for t in RAW_TABLES if jobs.path_exists(spark, place(t))]
    assert there(lk.landing) == there(lk.bronze) == there(lk.silver) == ["calendar"]
    lk = catalog.lake(spark, sf)
    assert there(lk.landing) == there(lk.bronze) == there(lk.silver) == RAW_TABLES
    log = spark.read.schema(au.AUDIT_SCHEMA).json(lk.audit)
    assert sorted(map(tuple, log.select("pipeline", "table_name", "status").collect())) == sorted((s, t, "ok") for s in ("landing", "bronze", "silver") for t in RAW_TABLES)


def test_digest_of_few_columns_needs_no_arrays(spark):
    df = spark.createDataFrame([("a", None, 1.5, 2), (None, "b:", float("nan"), None)], "a string, b string, x double, n int")
    written = au.row_digest(df)
    assert "transform" not in df.select(written)._jdf.queryExecution().analyzed().toString()
    got = [r[0] for r in df.select(written).collect()]
    import hashlib

    assert got == [hashlib.md5(t.encode()).hexdigest() for t in (f"1:a-{len(f'1+{1 << 51}')}:1+{1 << 51}1:2", "-2:b:3:nan-")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rolling_means_of_whole_numbers_take_one_step_a_row(spark):
    sales = "case when id % 11 = 3 then null else cast(id * 7919 % 23 - 9 as int) end"
    df = spark.range(240).selectExpr("concat('S', id % 3) id", "concat('d_', id * 2) d", f"{sales} sales")
    whole, real = add_series_features(df, 5), add_series_features(df.withColumn("sales", F.col("sales").cast("double")), 5)
    assert "rowframe, -28, -1" in _plan(real) and "rowframe, -28, -1" not in _plan(whole) and "rowframe, -7, -1" not in _plan(whole)
    assert sorted(whole.columns) == sorted(real.columns) and [t for t in whole.dtypes if t[0] != "sales"] == [t for t in real.dtypes if t[0] != "sales"]
    same = real.withColumn("sales", F.col("sales").cast("int")).select(*whole.columns)
    assert whole.exceptAll(same).isEmpty() and same.exceptAll(whole).isEmpty() and whole.count() == 240
    known = whole.withColumn("again", rolling_mean_feature(7)).where("not (roll_mean_7 <=> again)")
    assert known.isEmpty() and not whole.where("roll_mean_7 is not null").isEmpty() and not whole.where("roll_mean_7 is null and d_num > 100").isEmpty()


def test_last_rows_come_from_the_test_rows(spark):
    rows = [("A", f"d_{n}", n) for n in range(1, 61)] + [("B", f"d_{n}", n) for n in range(1, 11)]
    columns = ["id", "d", "sales"]

    def stored(rows):
        path = scratch_path(spark, "last_rows")
        df = add_series_features(spark.createDataFrame(rows, "id string, d string, sales int"), 28)
        write_features(df, path)
        return read_features(spark, path)

    table = stored(rows)
    state = last_stored_rows(table, columns)
    assert _plan(state).count("relation [") == 1 and "semi" not in _plan(state)  # no history is read
    assert sorted(map(tuple, state.collect())) == sorted(r for r in rows if r[0] == "B" or r[2] > 32)
    # gaps: the last 28 days of C hold three rows, D has a single day in them
    gaps = rows + [("C", f"d_{n * 10}", n) for n in range(1, 41)] + [("D", "d_5", 1), ("D", "d_900", 2)]
    table = stored(gaps)
    assert sorted(map(tuple, last_stored_rows(table, columns).collect())) == sorted(map(tuple, last_rows(table.select(*columns)).collect()))


def test_fingerprints_are_sums_of_digest_halves_without_decimals(spark):
    import hashlib

    df = spark.createDataFrame([("a", 1), (None, -2), ("b", None), ("a", 1)], "s string, n int")
    texts = ["1:a1:1", "-2:-2", "1:b-", "1:a1:1"]
    digests = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    want = (4, str(sum(int(d[:16], 16) for d in digests)), str(sum(int(d[16:], 16) for d in digests)))
    found = au.table_fingerprint(df)
    assert tuple(found.first()) == want and [t for _, t in found.dtypes] == ["bigint", "string", "string"]
    seen = []
    got = au.observed_write(lambda d: seen.append((d.columns, _plan(d), d.collect())), df, "small")
    assert (got["n_rows"], got["hash_hi"], got["hash_lo"]) == want
    assert seen[0][0] == ["s", "n"] and "decimal" not in seen[0][1]
    assert tuple(au.table_fingerprint(df.limit(0)).first()) == (0, "0", "0")


def test_digest_of_many_columns_casts_them_once(spark):
    import hashlib

    names = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([("x", *range(19), None)], "s string, " + ", ".join(f"{c} int" for c in names))
    digest = au.row_digest(df)
    assert "as array<string>" in df.select(digest)._jdf.queryExecution().analyzed().toString().lower()
    assert df.select(digest).first()[0] == hashlib.md5(("1:x" + "".join(f"{len(str(i))}:{i}" for i in range(19)) + "-").encode()).hexdigest()


def test_features_of_the_stored_sales_are_written_from_their_buckets(spark, monkeypatch, sf_small, tmp_path):
    import shutil

    sf = str(tmp_path / "sf")
    shutil.copytree(sf_small, sf)
    rows = rf.landed_dense_sales(spark, sf_small).count()
    monkeypatch.setattr(session, "TASK_ROWS", rows // 20)
    stored = catalog.stored_features(spark, sf)
    written = {f.rsplit("/", 1)[-1].split("-")[1] for f in stored.inputFiles()}
    assert stored.count() == rows and max(map(int, written)) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert stored.groupBy("id").agg(F.count_if("is_test").alias("n")).where("n != 28").isEmpty()
    plan = catalog.features(spark, sf).repartition(session.partitions_for(spark, rows), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 0
