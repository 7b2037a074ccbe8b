"""A cleaning pipeline over ``documents``: quality rules, line dedup, n-gram
Jaccard dedup, benchmark decontamination, byte-level BPE encoding.

Each stage works on what its predecessor kept, its result is written as
Parquet in the shared folder and read back as the next stage's input.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm import jaccard, lines, quality, queries, tiling
from shelfcast.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    forest = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.good_rows(docs.select(COLUMNS), forest)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share stay in the last of them."""
    return lines.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones, the one with the smallest
    id.  Repeated rows are one; a document without an id cannot be named by a
    class and stays, one of each text."""
    first = jaccard.similar(docs).where("doc_id = class_id").select(F.col("doc_id").alias("_id")).distinct()
    one = Window.partitionBy("doc_id", "_text").orderBy("lang", "source")

    def once(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_text", F.md5(F.coalesce("text", F.lit(""))))
        return rows.withColumn("_n", F.row_number().over(one)).where("_n = 1").select(COLUMNS)

    named = docs.join(first, F.col("doc_id") == F.col("_id"), "left_semi")
    return once(named).unionByName(once(docs.where("doc_id is null")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return tiling.clean_rows(docs, read(spark, sf_dir, "benchmark")).select(COLUMNS)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return queries.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_dedup", jaccard_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The quality model and the near-duplicate groups have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
