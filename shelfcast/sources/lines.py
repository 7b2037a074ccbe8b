"""Wide CSV tables read as lines, straight to long form.

A table of one column per day has thousands of columns, and a scan by columns
plans, parses and casts every one of them as a column before they are unpivoted
again.  Here a line is one string: it is split once into an array, which is
exploded with the header's day numbers.  The plan is a text scan, one projection
and one generator, however many days there are.

The dialect is that of ``shelfcast.sources.csv``; a quoted field may hold commas
and doubled quotes.  What a strict CSV scan refuses fails here as well: a line
with other than the header's number of fields, broken quotes, a cell that is no
integer (spaces around one included), a file with another header.  Blank fields
are NULL, blank lines are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.csv import csv_header

_FIELD = r',("(?:[^"]|"")*"|[^",][^,]*|(?=,)|$)'


def _fail(message: str, *values: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"malformed line, {message}: "), *values))


def _fields(line: Column) -> Column:
    """The fields of a line; those in quotes without them."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    whole = F.when(F.concat_ws(",", found) == line, found).otherwise(_fail("quotes", F.substring(line, 1, 80)))
    plain = F.transform(whole, lambda f: F.when(f.startswith('"'), F.replace(F.substring(f, F.lit(2), F.char_length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))
    return F.when(F.contains(line, F.lit('"')), plain).otherwise(F.split(line, ",", -1))


def wide_lines_to_long(spark: SparkSession, path: str, meta_columns: list[str], prefix: str = "d_", value: str = "sales") -> DataFrame:
    """``meta_columns``, ``d`` and the integer ``value`` of every line and day
    column of the CSV files at ``path``."""
    header = csv_header(spark, path)
    absent = [c for c in meta_columns if c not in header]
    days = [(i, c) for i, c in enumerate(header) if c.startswith(prefix) and c[len(prefix):].isdigit()]
    if absent or not days:
        raise ValueError(f"{path} lacks {absent or f'day columns {prefix}*'}")
    lines = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line")).where("line != ''")
    rows = lines.select(_fields(F.col("line")).alias("f"))
    # every file starts with the header
    is_header = F.element_at("f", 1) == F.lit(header[0])
    same = F.array(*map(F.lit, header)) if len(header) <= 16 else F.split(F.lit("\x00".join(header)), "\x00")
    rows = rows.where(F.when(is_header & (F.col("f") != same), _fail("another header", F.lit(path))).otherwise(~is_header))
    n = len(header)
    checked = F.when(F.size("f") == n, F.col("f")).otherwise(_fail(f"not {n} fields", F.size("f").cast("string")))
    meta = [F.expr(f"nullif(g[{header.index(c)}], '')").alias(c) for c in meta_columns]
    first, last = days[0][0], days[-1][0]
    if last - first + 1 == len(days):
        cells = F.slice("g", first + 1, len(days))
    else:
        cells = F.transform(F.split(F.lit(",".join(str(i + 1) for i, _ in days)), ",").cast("array<int>"), lambda i: F.element_at("g", i))
    long = rows.select(checked.alias("g")).select(*meta, F.posexplode(cells).alias("_at", "_cell"))
    names = F.split(F.lit(",".join(c for _, c in days)), ",")
    number = F.when(F.col("_cell") == "", F.lit(None).cast("int")).when(
        F.char_length(F.trim("_cell")) == F.char_length("_cell"), F.col("_cell").cast("int")).otherwise(_fail("a cell", F.col("_cell")).cast("int"))
    return long.select(*meta_columns, F.element_at(names, F.col("_at") + 1).alias("d"), number.alias(value))
