"""The operators applied to whole tables, and DuckDB SQL for those that SQL
can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import alignment, bpe, extraction, jaccard, lines, neighbours, pii, quality, resampling, secrets, tiling, token_counts, warc
from shelfcast.llm.common import read
from shelfcast.session import scratch_path

TOKEN_LIMIT = 4096


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"), TOKEN_LIMIT)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive, index = scratch_path(spark, "warc"), scratch_path(spark, "cdx")
    captures = warc.write(read(spark, sf_dir, "pages"), archive)
    back = warc.look_up(captures, warc.build_index(captures, index), index, archive)
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(read(spark, sf_dir, "documents"))


def encode_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return bpe.encode_digests(docs, _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.train(docs))
    return found.select(
        "doc_id", *(secrets.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.search(neighbours.build(vectors), vectors.where("vec_id % 20 = 0"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return alignment.linked(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_extraction, op2_token_counts, op3_pii, op4_warc, op5_jaccard, op6_bpe, op7_quality, op8_line_dedup, op9_secrets,
              op10_decontamination, op11_neighbours, op12_alignment, op13_resampling)
}

ORACLE_SQL: dict[str, str] = {
    # base32 of the digest by its five-bit groups
    "op4_warc": r"""
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ), first AS (
            SELECT hex, max(page_id) AS last FROM p GROUP BY hex
        ), bits AS (
            SELECT DISTINCT hex, array_to_string([right('000' || bin(strpos('0123456789abcdef', c) - 1), 4) FOR c IN string_split(hex, '')], '') AS b FROM p
        ), base32 AS (
            SELECT hex, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(list_sum([CAST(substr(b, 5 * i + j + 1, 1) AS INT) * (16 >> j) FOR j IN range(5)]) AS INT) + 1, 1) FOR i IN range(32)], '') AS digest FROM bits
        )
        SELECT page_id, octet_length(payload) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM p JOIN first USING (hex) JOIN base32 USING (hex)""",
    "op8_line_dedup": r"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
        ), line AS (
            SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
        ), common AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
            SELECT keyed.*, common.key IS NOT NULL AND doc_id <> last AS dropped FROM keyed LEFT JOIN common ON keyed.key = common.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY r, doc_id""",
}
