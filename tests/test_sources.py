"""Sources, sinks, silver typing and gold reshapes on hand-made micro-fixtures."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.columns import cast_columns, day_columns
from shelfcast.functions.dates import parse_date
from shelfcast.operators import gold as gd
from shelfcast.operators.audit import add_hashes, table_fingerprint, table_profile
from shelfcast.operators.typing import type_calendar, type_table
from shelfcast.session import scratch_path
from shelfcast.sources.csv import read_csv, write_csv
from shelfcast.sources.files import file_manifest, guarded_write, input_completeness
from shelfcast.sources.first_rows import first_rows
from shelfcast.sources.lines import wide_lines_to_long
from shelfcast.sources.versions import read_table


def test_csv_dialect_roundtrip_and_blank_is_null(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-csv-")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write('name,event_name_1,n\n"a ""b"" c",,1\nplain,Christmas,2\n')
    df = read_csv(spark, d, schema="name string, event_name_1 string, n int")
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [('a "b" c', None, 1), ("plain", "Christmas", 2)]
    inferred = read_csv(spark, d, infer_schema=True)
    assert dict(inferred.dtypes)["n"] == "int"


def test_bad_cell_fails_the_read(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-csv-")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("name,n\na,1\nb,12x\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_csv(spark, d, schema="name string, n int").collect()


def test_parse_date_rules(spark):
    df = spark.createDataFrame([("2020-01-02",), ("2020-1-2",), ("bad",), (None,)], "date string")
    got = [r[0] for r in df.select(parse_date(df, "date")).collect()]
    assert [str(x) if x else None for x in got] == ["2020-01-02", "2020-01-02", None, None]
    ints = spark.createDataFrame([(0,), (18262,)], "date int")
    assert [str(r[0]) for r in ints.select(parse_date(ints, "date")).collect()] == ["1970-01-01", "2020-01-01"]


def test_checked_cast_overflows(spark):
    df = spark.createDataFrame([(300,)], "snap_CA int")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        cast_columns(df, {"snap_CA": "tinyint"}).collect()
    assert cast_columns(df, {"absent": "tinyint"}).columns == ["snap_CA"]


def test_calendar_typing_and_unknown_table_identity(spark):
    df = spark.createDataFrame([("2016-01-02", "1", "Saturday", "1", "1", "2016", "d_1", "0")],
                               "date string, wm_yr_wk string, weekday string, wday string, month string, "
                               "year string, d string, snap_CA string")
    typed = dict(type_calendar(df).dtypes)
    assert typed["date"] == "date" and typed["wday"] == "smallint" and typed["snap_CA"] == "tinyint"
    assert typed["wm_yr_wk"] == "int" and "snap_TX" not in typed
    assert type_table("something_else", df).dtypes == df.dtypes


def test_is_weekend_null_is_false(spark):
    cal = spark.createDataFrame([("Saturday", None), (None, "X"), ("Monday", None)],
                                "weekday string, event_name_1 string")
    got = [(r["is_weekend"], r["is_event_day"]) for r in gd.dim_calendar(cal).collect()]
    assert got == [(True, False), (False, True), (False, False)]


def test_day_columns_numeric_order_and_unpivot_roundtrip(spark):
    assert day_columns(["id", "d_10", "d_2", "d_1"]) == ["d_1", "d_2", "d_10"]
    assert day_columns(["d_10", "d_2", "d_1"], 2) == ["d_2", "d_10"] and day_columns(["d_3"], 9) == ["d_3"]
    for n in (0, -1):
        with pytest.raises(ValueError, match="at least 1"):
            day_columns(["d_1"], n)
    cols = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d_10", "d_2", "d_1"]
    wide = spark.createDataFrame(
        [("B", "i", "x", "c", "s", "t", 10, 2, 1), ("A", "i", "x", "c", "s", "t", 20, 4, 3)],
        ", ".join(f"{c} {'int' if c.startswith('d_') else 'string'}" for c in cols),
    )
    full = sorted((r["id"], r["d"], r["sales"]) for r in gd.sales_long(wide, None, None).collect())
    assert full == [("A", "d_1", 3), ("A", "d_10", 20), ("A", "d_2", 4),
                    ("B", "d_1", 1), ("B", "d_10", 10), ("B", "d_2", 2)]
    sample = sorted((r["id"], r["d"]) for r in gd.sales_long(wide, 1, 2).collect())
    assert sample == [("A", "d_10"), ("A", "d_2")]
    with pytest.raises(ValueError, match="No day columns"):
        gd.sales_long(wide.select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id"))


def test_guarded_write_policies(spark):
    df = spark.range(3)
    path = scratch_path(spark, "guard")
    assert guarded_write(df, path, policy="skip") == "ok"
    assert guarded_write(spark.range(10), path, policy="skip") == "exists"
    assert read_table(spark, path).count() == 3
    with pytest.raises(FileExistsError):
        guarded_write(df, path, policy="fail")
    assert guarded_write(spark.range(5), path, policy="fail", force=True) == "ok"
    assert read_table(spark, path).count() == 5


def test_manifest_sha256_and_completeness(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-land-")
    os.makedirs(os.path.join(d, "sub"))
    blobs = {"calendar.csv": b"a,b\n1,2\n", "sub/sell_prices.csv": b"x\n" * 1000}
    for name, data in blobs.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    man = {r["rel_path"]: (r["bytes"], r["sha256"]) for r in file_manifest(spark, d).collect()}
    assert man == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in blobs.items()}
    names = file_manifest(spark, d).select(
        F.regexp_extract("rel_path", r"([^/]+)\.csv$", 1).alias("table_name"))
    got = {r["table_name"]: (r["status"], r["overall_status"])
           for r in input_completeness(names, ["calendar", "sell_prices", "sales_train_validation"]).collect()}
    assert got == {"calendar": ("ok", "partial"), "sell_prices": ("ok", "partial"),
                   "sales_train_validation": ("missing", "partial")}
    assert {r["overall_status"] for r in input_completeness(names, ["calendar"]).collect()} == {"ok"}
    assert {r["overall_status"] for r in input_completeness(names, ["zzz"]).collect()} == {"missing_input"}


def test_profile_and_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x"), (2, "y")], "k int, v string").repartition(3)
    fa, fb = table_fingerprint(a).first(), table_fingerprint(b).first()
    assert fa == fb and fa["n_rows"] == 3
    c = spark.createDataFrame([(1, "x")], "k int, v string")
    assert table_fingerprint(c).first()["hash_hi"] != fa["hash_hi"]
    # parts add up; NULL, empty text and the text of NULL's mark differ
    one, two = (table_fingerprint(df).first().asDict() for df in (a.where("k = 1"), a.where("k = 2")))
    assert add_hashes(one, two) == fa.asDict()
    texts = [table_fingerprint(spark.createDataFrame([r], "a string, b string")).first() for r in ((None, "x"), ("", "x"), ("-", "x"), ("x", None), ("1:x", ""))]
    assert len(set(texts)) == len(texts)
    numbers = [table_fingerprint(spark.createDataFrame([(x,)], "x double")).first() for x in (0.1, 0.1 + 2**-52, -0.1, 1e19, -1e19, float("nan"), float("inf"), None)]
    assert len(set(numbers)) == len(numbers) - 1 and numbers[3] == numbers[6]
    prof = {r["table_name"]: (r["n_rows"], r["n_columns"]) for r in table_profile({"a": a, "c": c}).collect()}
    assert prof == {"a": (3, 2), "c": (1, 2)}


def test_write_csv_sink(spark):
    path = scratch_path(spark, "csv_sink")
    write_csv(spark.createDataFrame([("a,b", 1.5)], "id string, y double"), path)
    assert [tuple(r) for r in read_csv(spark, path, schema="id string, y double").collect()] == [("a,b", 1.5)]


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_guarded_write_redoes_only_its_own_leftover(spark):
    from shelfcast.sources.files import is_committed
    from shelfcast.sources.versions import Draft

    path = scratch_path(spark, "leftover")
    spark.range(3).write.parquet(path)
    os.remove(os.path.join(_local(path), "_SUCCESS"))  # no commit record: another tool's folder
    for policy in ("skip", "fail"):
        try:
            assert guarded_write(spark.range(7), path, policy=policy) == "exists"
        except FileExistsError:
            assert policy == "fail"
        assert read_table(spark, path).count() == 3
    # force publishes beside it and leaves it whole
    assert guarded_write(spark.range(7), path, force=True) == "ok"
    assert read_table(spark, path).count() == 7 and spark.read.parquet(path).count() == 3
    other = scratch_path(spark, "own_leftover")
    spark.range(9).write.parquet(Draft(spark, other).folder)  # as if our own write had died before its record
    assert not is_committed(spark, other)
    assert guarded_write(spark.range(7), other, policy="fail") == "ok"
    assert read_table(spark, other).count() == 7 and is_committed(spark, other)
    assert guarded_write(spark.range(1), other, policy="skip") == "exists"


def test_versions(spark):
    from shelfcast.sources import versions as vs

    path = scratch_path(spark, "versions")
    assert vs.current(spark, path) is None and not vs.is_taken(spark, path)
    for n in range(1, 5):
        assert vs.publish(spark, path, lambda f, n=n: spark.range(n).write.parquet(f), force=True, notes={"n": n}) == "ok"
    now = vs.current(spark, path)
    assert now.number == 4 and now.notes == {"n": 4} and vs.location(spark, path) == now.parts[0]
    kept = [x for x in os.listdir(_local(path)) if not x.startswith(".")]
    assert len([x for x in kept if x.startswith("_version-")]) == len(os.listdir(os.path.join(_local(path), vs.HOME))) == vs.KEEP
    # a failed write leaves the version, and the next one is not held up
    with pytest.raises(Exception, match="lost"):
        vs.publish(spark, path, lambda f: spark.range(9).select(F.raise_error(F.lit("lost"))).write.parquet(f), force=True)
    assert vs.current(spark, path) == now and read_table(spark, path).count() == 4
    # parts of the version before stay
    draft = vs.Draft(spark, path)
    spark.range(2).write.parquet(draft.folder)
    draft.publish(keep_parts=list(now.parts))
    assert read_table(spark, path).count() == 6
    with pytest.raises(ValueError, match="2 folders"):
        vs.location(spark, path)
    # of two that were begun together the second is refused
    one, two = vs.Draft(spark, path), vs.Draft(spark, path)
    for d in (one, two):
        spark.range(1).write.parquet(d.folder)
    one.publish()
    with pytest.raises(FileExistsError, match="meanwhile"):
        two.publish()
    assert read_table(spark, path).count() == 1
    file = scratch_path(spark, "a_file")
    os.makedirs(os.path.dirname(_local(file)), exist_ok=True)
    open(_local(file), "w").close()
    with pytest.raises(FileExistsError, match="is a file"):
        guarded_write(spark.range(1), file, force=True)


def test_wide_lines_to_long(spark):
    d = tempfile.mkdtemp(prefix="shelfcast-lines-")

    def write(name, *lines):
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write("\n".join(lines) + "\n")

    write("a.csv", "id,item,d_1,note,d_10,d_2", 'A,"x, ""y""",1,n,2,3', "", 'B,,4,"",,-6\r')
    write("b.csv", "id,item,d_1,note,d_10,d_2")
    got = sorted(map(tuple, wide_lines_to_long(spark, d, ["id", "item"]).collect()), key=repr)
    by_columns = read_csv(spark, d, schema="id string, item string, d_1 int, note string, d_10 int, d_2 int").where("id is not null")
    want = by_columns.unpivot(["id", "item"], ["d_1", "d_10", "d_2"], "d", "sales")
    assert got == sorted(map(tuple, want.collect()), key=repr) and len(got) == 6
    for bad, why in (("C,z,1,n,2", "not 6 fields"), ("C,z,1,n,2,3,4", "not 6 fields"), ("C,z,1x,n,2,3", "CAST_INVALID|1x"), ("C,z, 1,n,2,3", "a cell"),
                     ('C,"z,1,n,2,3', "quotes|fields"), ("id,item,d_2,note,d_10,d_1", "another header")):
        write("c.csv", "id,item,d_1,note,d_10,d_2", bad)
        with pytest.raises(Exception, match=why):
            wide_lines_to_long(spark, d, ["id", "item"]).collect()
    with pytest.raises(ValueError, match="shop"):
        wide_lines_to_long(spark, d, ["shop"])
    plan = wide_lines_to_long(spark, d, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" in plan and "Generate posexplode" in plan and "Exchange" not in plan


def test_first_rows_open_few_files(spark):
    path = scratch_path(spark, "first_rows")
    spark.range(1000).repartitionByRange(10, "id").sortWithinPartitions("id").write.parquet(path)
    for n, files in ((1, 1), (100, 1), (101, 2), (450, 5), (5000, 10)):
        out = first_rows(spark, path, n)
        assert [r["id"] for r in out.collect()] == list(range(min(n, 1000)))
        assert len(out.inputFiles()) == files
    with pytest.raises(ValueError, match="at least 1"):
        first_rows(spark, path, 0)
    empty = scratch_path(spark, "first_rows_empty")
    spark.range(0).write.parquet(empty)
    assert first_rows(spark, empty, 3).count() == 0


def test_sample_in_file_order(spark):
    cols = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d_1", "d_2"]
    rows = [(f"S{k}", "i", "x", "c", "s", "t", k, k + 1) for k in (5, 3, 9, 1)]
    path = scratch_path(spark, "wide_file_order")
    spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c.startswith('d_') else 'string'}" for c in cols)) \
        .coalesce(1).write.parquet(path)
    wide = spark.read.parquet(path)
    by_file = {r["id"] for r in gd.sales_long(wide, 2, None, sample_order="file").collect()}
    by_id = {r["id"] for r in gd.sales_long(wide, 2, None).collect()}
    assert by_file == {"S5", "S3"} and by_id == {"S1", "S3"}


def test_stack_unpivot_equals_builtin_unpivot(spark):
    import random

    rnd = random.Random(5)
    days = [f"d_{k}" for k in (1, 2, 3, 10, 11, 25, 100)]
    meta = list(gd.SERIES_COLUMNS)
    rows = [tuple([f"S{i}", "i", "x", "c", "s", "t"] + [rnd.choice([None, rnd.randint(0, 9)]) for _ in days])
            for i in range(12)]
    wide = spark.createDataFrame(rows, ", ".join([f"{c} string" for c in meta] + [f"{d} int" for d in days]))
    ours = sorted(tuple(r) for r in gd.unpivot_days(wide, days).collect())
    builtin = sorted(tuple(r) for r in wide.unpivot(meta, days, "d", "sales").select(*meta, "d", "sales").collect())
    assert ours == builtin and len(ours) == 12 * len(days)
