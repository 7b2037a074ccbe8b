"""File-system level sources: existence checks, guarded writes (S8, S13,
S14), file manifests (S10), input completeness (S17) and named views (S12)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.fs import fs_and_path, modified_at, path_exists, qualified
from shelfcast.sources.versions import current, publish, published_at, read_table

MANIFEST_PIECE = 8 << 20
SAVED = "_SAVED"


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    fs, hpath = fs_and_path(spark, path)
    fs.create(hpath, True).close()


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a COMMITTED output.

    A published output has a version record.  Of plain folders, Spark's commit
    protocol writes ``_SUCCESS`` only when the whole job commits, a streaming
    file sink commits through its ``_spark_metadata`` log, and ``save_model``
    adds a marker of its own after its last part.
    """
    base = path.rstrip("/")
    return current(spark, base) is not None or any(path_exists(spark, f"{base}/{name}") for name in ("_SUCCESS", SAVED, "_spark_metadata/0"))


def is_input(spark: SparkSession, path: str) -> bool:
    """True for a plain file, and for a folder that no job is still writing."""
    return path_exists(spark, path) and not path_exists(spark, f"{path.rstrip('/')}/_temporary")


def changed_at(spark: SparkSession, path: str) -> int:
    """When an output was last written, in milliseconds: its newest version, or
    the newest change of a plain folder and its commit records."""
    base = path.rstrip("/")
    return published_at(spark, base) or max(modified_at(spark, p) for p in (base, f"{base}/_SUCCESS", f"{base}/_spark_metadata"))


def guarded_write(
    df: DataFrame,
    path: str,
    policy: str = "skip",
    force: bool = False,
    fmt: str = "parquet",
) -> str:
    """Publish ``df`` unless the output exists (S13 ``skip``, S14 ``fail``).

    * ``force``            -> a new version, status ``ok``
    * exists and ``skip``  -> keep the existing output, status ``exists``
    * exists and ``fail``  -> ``FileExistsError``
    * otherwise            -> write, status ``ok``

    Whatever lies at ``path`` exists, whoever wrote it; only a folder that
    holds nothing but versions that were never finished does not.
    """
    return publish(df.sparkSession, path, lambda folder: df.write.format(fmt).save(folder), policy, force)


def file_manifest(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Manifest of every file under ``root`` (S10): ``rel_path, bytes, sha256``.

    Spark lists paths and lengths (contents are not read for that); each file
    is then hashed in a task that streams it in pieces, so a file of any size
    needs the memory of one piece.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    listed = reader.load(root).select("path", "length")
    base = qualified(spark, root).rstrip("/") + "/"

    def digest(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                # Hadoop writes file:/x, a URI of which is file:///x
                store, place = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
                sha = hashlib.sha256()
                with store.open_input_stream(place, compression=None) as stream:
                    while piece := stream.read(MANIFEST_PIECE):
                        sha.update(piece)
                out.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(out, pa.string())], names=["path", "bytes", "sha256"])

    hashed = listed.repartition("path").mapInArrow(digest, "path string, bytes long, sha256 string")
    return hashed.select(
        F.when(F.startswith("path", F.lit(base)), F.expr(f"substring(path, {len(base) + 1})")).otherwise(F.col("path")).alias("rel_path"),
        "bytes",
        "sha256",
    )


def overall_status(present: int, expected: int) -> str:
    """``ok`` when all inputs are there, ``missing_input`` when none, else
    ``partial`` (S17)."""
    return "ok" if present == expected else "missing_input" if present == 0 else "partial"


def input_completeness(manifest: DataFrame, expected: Iterable[str], name_col: str = "table_name") -> DataFrame:
    """Per expected table ``ok``/``missing`` plus overall status.

    ``manifest`` needs a ``table_name`` column (one row per file or table).
    Overall: ``ok`` when all present, ``missing_input`` when none, else
    ``partial``.  The expected list is a handful of names and joins the
    (distinct) present names by equality.
    """
    spark = manifest.sparkSession
    names = list(expected)
    want = spark.createDataFrame([(n,) for n in names], f"{name_col} string")
    present = manifest.select(name_col).distinct().withColumn("_present", F.lit(True))
    per_table = want.join(present, name_col, "left").select(
        name_col, F.when(F.col("_present"), F.lit("ok")).otherwise(F.lit("missing")).alias("status")
    )
    n_ok = per_table.where(F.col("status") == "ok").select(F.count(F.lit(1))).scalar()
    overall = (
        F.when(n_ok == len(names), F.lit("ok"))
        .when(n_ok == 0, F.lit("missing_input"))
        .otherwise(F.lit("partial"))
    )
    return per_table.select(name_col, "status", overall.alias("overall_status"))


def register_view(spark: SparkSession, source: str | DataFrame, name: str = "stg_gold") -> DataFrame:
    """Named view over a Parquet path or a DataFrame."""
    df = read_table(spark, source) if isinstance(source, str) else source
    df.createOrReplaceTempView(name)
    return spark.table(name)
