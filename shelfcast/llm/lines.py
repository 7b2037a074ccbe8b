"""Line dedup: lines that many documents share are dropped everywhere but in
the document with the largest id.

Each text is split at line feeds and the lines are exploded; a line's key is
the line without white space at its ends and with A-Z in lower case.  Keys of
at least ``min_chars`` code points are hashed (MD5, 128 bits, so that chance
meetings stay negligible at any size) and the distinct documents of each hash
counted: first one row per hash and text, with the positions of the lines that
have it, then one count per task and hash, so that a line that a third of all
documents hold arrives as one count per task.  The join of texts and common
hashes has an exchange of its own on both sides, so a very common line can be
split.  A text gets the positions to drop and keeps the others, in order; time
is linear in its lines.

A null or empty text is one empty line.  Rows with the same id count as one
document and rows with a null id as one that keeps a line only if no other
document holds it; all of them are returned, each with its own text.  A text
that loses all its lines is empty.  Other columns pass through
``dedup_lines`` unchanged; columns with the names of the added ones are an
error.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import SPACE, split_join, stored

OWN = ("_row", "_of", "_same", "_drop", "_lines")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text_col`` cut down to the kept lines, and the columns
    ``n_lines`` (before) and ``n_dropped``."""
    taken = sorted({"n_lines", "n_dropped", *OWN} & set(docs.columns))
    if taken:
        raise ValueError(f"the columns {taken} would be replaced")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # equal rows share a key, so that both reads of the table agree on it
    rows = docs.withColumn("_row", F.xxhash64(text))
    line = rows.select(F.col(id_col).alias("_doc"), "_row", F.posexplode(_lines(F.col(text_col))).alias("_at", "_line"))
    key = line.select("_doc", "_row", "_at", _key(F.col("_line")).alias("_key")).where(F.char_length("_key") >= min_chars)
    held = key.groupBy("_doc", "_row", F.unhex(F.md5("_key")).alias("_hash")).agg(F.collect_list("_at").alias("_places"))
    held = stored(held, "lines-held")  # read twice below
    # a document of null id counts, but is never the largest
    counted = held.select("_doc", "_hash").distinct().groupBy("_hash").agg(F.count(F.lit(1)).alias("n"), F.max("_doc").alias("_last"))
    common = split_join(held, counted.where(F.col("n") >= min_docs).drop("n"), "_hash").where(~F.col("_doc").eqNullSafe(F.col("_last")))
    drop = common.groupBy("_doc", "_row").agg(F.array_distinct(F.flatten(F.collect_list("_places"))).alias("_drop"))
    drop = drop.select(F.col("_doc").alias("_of"), F.col("_row").alias("_same"), "_drop")
    both = rows.join(drop, F.col(id_col).eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_same")), "left")

    lines = _lines(F.col(text_col))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(every, "_drop"), lambda i: F.get("_lines", i))
    out = both.withColumn("_lines", lines).withColumns({
        "n_lines": F.size("_lines").cast("long"), "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long"),
        text_col: F.when(F.col("_drop").isNull(), text).otherwise(F.concat_ws("\n", kept))})
    return out.drop(*OWN)
