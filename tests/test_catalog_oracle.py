"""Every catalog query against its DuckDB oracle at sf0.001 (the driver does
the same at sf0.01), and the rows-only queries for sane shapes."""

import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfcast.sources.tables import TESTDATA_TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TESTDATA_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _digest(rows, cols):
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        return repr(v)

    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


DUCKDB_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT",
               "tinyint": "TINYINT", "double": "DOUBLE", "float": "FLOAT", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    assert {f.name: DUCKDB_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields} == types
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert "roll_mean_28" in df.columns and df.count() > 0


def test_rows_only_queries(spark):
    qs = queries()
    coefs = {r["feature"]: r["coefficient"] for r in qs["ridge_coefficients"](spark, SF).collect()}
    assert "(intercept)" in coefs and all(math.isfinite(v) for v in coefs.values())
    n_test = qs["test_set"](spark, SF).count()
    assert qs["predictions"](spark, SF).count() == n_test
    assert qs["predictions_csv"](spark, SF).count() == n_test
    assert qs["ridge_predict"](spark, SF).count() == n_test
    metrics = {r["metric"]: r["value"] for r in qs["ridge_eval_metrics"](spark, SF).collect()}
    assert set(metrics) == {"MAE", "RMSE", "R2"} and metrics["MAE"] >= 0
    fp = qs["table_fingerprint"](spark, SF).collect()
    assert {r["table_name"] for r in fp} == {"dim_calendar", "dim_series", "fact_sell_prices", "fact_sales_long"}
    comp = qs["input_completeness"](spark, SF).collect()
    assert {r["status"] for r in comp} == {"ok"} and {r["overall_status"] for r in comp} == {"ok"}
    assert qs["file_manifest"](spark, SF).count() >= 5
    audit = qs["stage_audit"](spark, SF).collect()
    assert {r["pipeline"] for r in audit} >= {"landing", "bronze", "silver", "gold"}


def test_medallion_run(spark):
    rows = {r["stage"]: r for r in queries()["medallion_run"](spark, SF).collect()}
    assert [rows[s]["status"] for s in ["bronze", "silver", "gold", "features", "dq", "train", "eval"]] == ["ok"] * 7
    assert rows["gold"]["n_tables"] == 4


def test_audit_fingerprints_chain(spark):
    """Stage fingerprints are observed during the writes: gold's price fact is
    an identity copy of silver's, and each equals a fresh aggregate pass."""
    from shelfcast.operators.audit import AUDIT_SCHEMA, fingerprint_text, table_fingerprint
    from shelfcast.plans.catalog import lake
    from shelfcast.sources.versions import read_table

    lk = lake(spark, SF, "gold")
    log = spark.read.schema(AUDIT_SCHEMA).json(lk.audit)
    audit = {(r["pipeline"], r["table_name"]): r for r in log.collect()}
    silver = audit[("silver", "sell_prices")]
    gold = audit[("gold", "fact_sell_prices")]
    assert silver["fingerprint"] == gold["fingerprint"] and silver["bytes"] > 0
    row = table_fingerprint(read_table(spark, lk.gold("fact_sell_prices"))).first()
    assert fingerprint_text(row) == gold["fingerprint"]
    assert audit[("bronze", "sales_train_validation")]["n_columns"] > 1000
