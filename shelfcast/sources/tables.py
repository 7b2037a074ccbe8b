"""Parquet table access for the driver-provided test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TESTDATA_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Full (S4) or column-pruned (S5) Parquet scan.

    Pruning is by projection: Catalyst narrows the scan's ``ReadSchema`` to the
    columns that survive to the output, so listing them here is a readability
    aid rather than a requirement.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
