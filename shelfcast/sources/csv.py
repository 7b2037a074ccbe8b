"""CSV scan and sink.

Dialect: header row, ``,`` delimiter, ``"`` quote, doubled-quote escape, one
record per line (no multi-line values, so every file splits across tasks).
Blank fields read as NULL.  A field that is not of its column's type fails the
read; nothing turns into NULL unsaid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "multiLine": "false"}
READ_OPTIONS = CSV_OPTIONS | {"mode": "FAILFAST"}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer_schema: bool = False,
) -> DataFrame:
    """CSV scan (S1).

    With an explicit ``schema`` nothing is inferred (the production path: no
    extra pass).  ``infer_schema`` (S2, discovery) samples the whole input
    once more to pick int/double/date/timestamp/string per column; ISO dates
    become ``date``.  Without either, every column is a string.
    """
    reader = spark.read.options(**READ_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "false")
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line only (reads one line)."""
    return spark.read.options(**READ_OPTIONS).csv(path).columns


def wide_schema(header: list[str], int_prefix: str = "d_", float_prefix: str | None = None) -> T.StructType:
    """Header-driven schema for the wide tables: prefixed day columns are
    int (or float forecast columns), everything else string."""
    fields = []
    for name in header:
        if int_prefix and name.startswith(int_prefix):
            fields.append(T.StructField(name, T.IntegerType()))
        elif float_prefix and name.startswith(float_prefix) and name[len(float_prefix):].isdigit():
            fields.append(T.StructField(name, T.FloatType()))
        else:
            fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV sink (S9): a folder of part files written by the executors, one
    per partition, each with a header -- nothing passes through the driver."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
