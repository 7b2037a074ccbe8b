"""Schema-level column helpers (metadata only, no Spark jobs)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> None:
    """Raise ``ValueError`` naming the sorted missing set."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


def quote(name: str) -> str:
    """Backtick-quote a column name for a SQL expression string."""
    return "`" + name.replace("`", "``") + "`"


def cast_columns(df: DataFrame, types: Mapping[str, str], expressions: Mapping[str, str] | None = None) -> DataFrame:
    """Checked casts of the columns named in ``types`` (P1, P2, P6, P7), in
    one projection; names that ``df`` lacks are ignored.

    ``expressions`` gives SQL of its own for some columns.  The projection is
    written as SQL strings, which the JVM parses in one call: about 2,000 day
    columns plan at once, and the analyzed plan stays one node deep.
    """
    own = expressions or {}

    def projected(name: str) -> str:
        col = quote(name)
        sql = own.get(name) or (f"CAST({col} AS {types[name]})" if name in types else col)
        return f"{sql} AS {col}"

    return df.selectExpr(*map(projected, df.columns))


def day_columns(columns: Iterable[str], last: int | None = None, prefix: str = "d_") -> list[str]:
    """The day columns in the order of their numbers, ``d_2`` before ``d_10``
    (P9); with ``last``, those of the newest days only (P10).

    ``last`` must be at least 1; more days than there are keep all of them.
    """
    if last is not None and last < 1:
        raise ValueError(f"the number of last days must be at least 1, not {last}")
    by_number = {int(c.removeprefix(prefix)): c for c in columns if c.startswith(prefix)}
    newest = sorted(by_number, reverse=True)[:last]
    return [by_number[n] for n in reversed(newest)]


def day_number(d: Column | str = "d") -> Column:
    """``d_1913`` -> 1913 as bigint.

    Only the literal ``d_`` is removed; any other text makes the ANSI cast
    raise ``CAST_INVALID_INPUT`` rather than silently yield NULL.
    """
    col = F.col(d) if isinstance(d, str) else d
    return F.replace(col.cast("string"), F.lit("d_"), F.lit("")).cast("bigint")
