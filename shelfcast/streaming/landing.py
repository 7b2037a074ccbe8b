"""Incremental landing: CSV files -> Parquet with Structured Streaming (S3).

The batch bronze copy re-reads a whole folder.  When raw files keep arriving,
the same copy runs as a file-source stream with the ``availableNow`` trigger:
every run picks up only files not yet processed, the file sink commits each
micro-batch atomically through its log, and the checkpoint (on the shared
file system) lets a restarted job resume exactly where it stopped -- a lost
executor or driver re-runs at most one micro-batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from shelfcast.sources.csv import READ_OPTIONS


def incremental_csv_to_parquet(
    spark: SparkSession,
    csv_dir: str,
    parquet_dir: str,
    schema: T.StructType,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> None:
    """Copy every not-yet-copied CSV file under ``csv_dir`` to Parquet and stop."""
    reader = spark.readStream.options(**READ_OPTIONS).schema(schema).option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.csv(csv_dir)
    q = (
        stream.writeStream.format("parquet")
        .option("path", parquet_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
