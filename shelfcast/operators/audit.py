"""Table profiles, content fingerprints and stage audit records."""

from __future__ import annotations

import datetime as _dt
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("pipeline", T.StringType()),
    T.StructField("dataset_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_columns", T.IntegerType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("started_at_utc", T.StringType()),
    T.StructField("finished_at_utc", T.StringType()),
    T.StructField("notes", T.MapType(T.StringType(), T.StringType())),
])


#: Neighbouring columns of one type that a row's digest names one by one.
WRITTEN_OUT = 16


def utc_now() -> str:
    return _dt.datetime.now(_dt.UTC).isoformat()


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows, n_columns`` for each table.

    Each count is a zero-column aggregate; over stored Parquet Spark answers
    it from row-group metadata without decoding any column.  The per-table
    one-row aggregates are unioned into one result (one job).
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _value_text(x: str, data_type: T.DataType) -> str:
    """SQL for the canonical text of the value ``x``."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        x = f"CAST({x} AS DOUBLE)"
        text = (f"CASE WHEN isnan({x}) THEN 'nan' WHEN abs({x}) >= 4611686018427387904 THEN IF({x} > 0, 'huge', '-huge') "
                f"ELSE concat(CAST(CAST(floor({x}) AS BIGINT) AS STRING), '+', CAST(CAST(floor(({x} - floor({x})) * 4503599627370496D) AS BIGINT) AS STRING)) END")
    elif isinstance(data_type, T.TimestampType):
        text = f"CAST(unix_micros({x}) AS STRING)"
    else:
        text = f"CAST({x} AS STRING)"
    return f"coalesce(concat(char_length({text}), ':', {text}), '-')"


def row_digest(df: DataFrame) -> Column:
    """MD5 of a row's canonical text, which any engine can write alike: for
    each column the length of its value's text, a colon and the text; ``-`` for
    NULL.

    A floating-point number is its integer part and 52 binary digits of its
    fraction, both exact; beyond 2^62 only its sign counts.  Timestamps are
    microseconds.  Many neighbouring columns of one type are one array in the
    expression, so that a table of 2,000 day columns has a small plan; few are
    written out, which Spark compiles.
    """
    from shelfcast.functions.columns import quote

    def many(run: list[T.StructField]) -> str:
        values = f"array({', '.join(quote(f.name) for f in run)})"
        if not isinstance(run[0].dataType, (T.FloatType, T.DoubleType, T.TimestampType)):
            values = f"CAST({values} AS ARRAY<STRING>)"  # once, as a value's text is named twice
        data_type = T.StringType() if values.startswith("CAST") else run[0].dataType
        return f"array_join(transform({values}, x -> {_value_text('x', data_type)}), '')"

    runs = [list(run) for _, run in groupby(df.schema.fields, lambda f: f.dataType)]
    texts = [x for run in runs for x in ([many(run)] if len(run) > WRITTEN_OUT else [_value_text(quote(f.name), f.dataType) for f in run])]
    return F.expr(f"md5(concat({', '.join(texts)}))")


#: Bits of a digest that are summed apart, in 64: enough for 2^47 rows.
_PIECE = 16


def _hash_words(digest: str) -> list[Column]:
    """The four 32-bit words ``_w0`` to ``_w3`` of a column of MD5s."""
    return [F.expr(f"CAST(conv(substr({digest}, {8 * i + 1}, 8), 16, 10) AS BIGINT)").alias(f"_w{i}") for i in range(4)]


def _hash_sums() -> list[Column]:
    """``n_rows`` and, of each word of the digests, the sums of its upper and
    lower bits as whole numbers, which unlike sums of decimals cost little."""
    halves = lambda w: [F.expr(f"sum(shiftright({w}, {_PIECE}))").alias(f"{w}_hi"), F.expr(f"sum({w} & {2**_PIECE - 1})").alias(f"{w}_lo")]
    return [F.count(F.lit(1)).alias("n_rows"), *[s for i in range(4) for s in halves(f"_w{i}")]]


def _half(i: int, of) -> list:
    """The pairs of a sum and its weight that make up the sum of the digests'
    half ``i``; ``of`` gives the sum of a name."""
    return [(of(f"_w{2 * i + j}_{part}"), 2 ** (32 * (1 - j) + (_PIECE if part == "hi" else 0))) for j in (0, 1) for part in ("hi", "lo")]


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A content fingerprint of a table that does not depend on the order
    of rows and that other engines can compute: ``n_rows`` and, as text, the
    sums ``hash_hi`` and ``hash_lo`` over rows of the halves of the row's
    digest.  Sums of parts add up; repeated rows count.  One aggregate pass
    with map-side partial results."""
    df = df.select(*columns) if columns else df
    sums = df.select(row_digest(df).alias("_digest")).select(*_hash_words("_digest")).agg(*_hash_sums())
    of = lambda name: F.coalesce(name, F.lit(0)).cast("decimal(20,0)")
    whole = lambda i: sum((s * F.lit(w).cast("decimal(16,0)") for s, w in _half(i, of)), F.lit(0).cast("decimal(16,0)"))
    return sums.select("n_rows", *[whole(i).cast("decimal(38,0)").cast("string").alias(c) for i, c in enumerate(("hash_hi", "hash_lo"))])


def fingerprint_text(hashes: dict) -> str:
    return f"{hashes['n_rows']}:{hashes['hash_hi']}:{hashes['hash_lo']}"


def add_hashes(a: dict, b: dict) -> dict:
    """The fingerprint of two parts together."""
    return {"n_rows": a["n_rows"] + b["n_rows"]} | {c: str(int(a[c]) + int(b[c])) for c in ("hash_hi", "hash_lo")}


def observed_write(writer_fn, df: DataFrame, name: str) -> dict:
    """Run ``writer_fn(observed_df)`` and return the fingerprint of the rows
    written, gathered by ``DataFrame.observe`` during the write itself (no
    second pass over the data)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    words = df.withColumn("_digest", row_digest(df)).select(*df.columns, *_hash_words("_digest"))
    writer_fn(words.observe(obs, *_hash_sums()).drop(*[f"_w{i}" for i in range(4)]))
    m = obs.get
    return {"n_rows": int(m["n_rows"])} | {c: str(sum(s * w for s, w in _half(i, lambda name: int(m[name] or 0)))) for i, c in enumerate(("hash_hi", "hash_lo"))}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop content summary)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def audit_rows(
    spark: SparkSession,
    pipeline: str,
    entries: list[dict],
    dataset_id: str = "m5",
) -> DataFrame:
    """One audit row per table of a stage (driver-side metadata only;
    row counts come from Spark aggregates computed by the stage)."""
    rows = [
        (
            pipeline,
            dataset_id,
            e.get("table_name"),
            e.get("status"),
            e.get("n_rows"),
            e.get("n_columns"),
            e.get("bytes"),
            e.get("fingerprint"),
            e.get("path"),
            e.get("started_at_utc"),
            e.get("finished_at_utc"),
            {k: str(v) for k, v in (e.get("notes") or {}).items()},
        )
        for e in entries
    ]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def append_audit(audit: DataFrame, path: str) -> None:
    """Append audit rows as JSON lines (the stage report sink)."""
    audit.write.mode("append").json(path)
