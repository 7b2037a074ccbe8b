"""Gold layer: conformed dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import day_columns, quote
from shelfcast.functions.dates import WEEKEND_DAYS

SERIES_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
DEFAULT_SAMPLE_SERIES = 20
DEFAULT_SAMPLE_DAYS = 365


def dim_calendar(calendar: DataFrame) -> DataFrame:
    """Calendar + ``is_weekend`` and ``is_event_day``.

    ``isin`` yields NULL on a NULL weekday; the flag is defined as false there.
    """
    return calendar.select(
        "*",
        F.coalesce(F.col("weekday").isin(*WEEKEND_DAYS), F.lit(False)).alias("is_weekend"),
        F.col("event_name_1").isNotNull().alias("is_event_day"),
    )


def dim_series(sales_wide: DataFrame) -> DataFrame:
    """Distinct series attributes (A1); only the six columns are read."""
    return sales_wide.select(*SERIES_COLUMNS).distinct()


def fact_sell_prices(prices: DataFrame) -> DataFrame:
    """Identity projection of the typed prices."""
    return prices.select("*")


def unpivot_days(wide: DataFrame, day_columns: list[str], meta_columns: list[str] | None = None) -> DataFrame:
    """Wide -> long (R1): one row per (series, day column).

    The ``stack`` generator emits (day name, value) pairs from each wide row
    in the task that read it -- no shuffle -- and the plan is a single
    Generate node however many day columns there are.  It is written as one
    SQL expression string: with ~2,000 columns, building the equivalent
    ``Column`` objects one py4j call at a time, or ``DataFrame.unpivot``'s
    Expand, costs seconds to tens of seconds of planning alone.
    """
    meta = meta_columns if meta_columns is not None else SERIES_COLUMNS
    pairs = ", ".join(f"'{c}', CAST({quote(c)} AS INT)" for c in day_columns)
    return wide.selectExpr(*[quote(c) for c in meta], f"stack({len(day_columns)}, {pairs}) AS (d, sales)")


def sales_long(
    sales_wide: DataFrame,
    sample_n_series: int | None = None,
    sample_days: int | None = None,
    sample_order: str = "id",
) -> DataFrame:
    """Long sales fact from the wide table.

    Everything is kept (the full fact, no sort, no single-task step) unless a
    sample is asked for: ``sample_days`` keeps the last N day columns (numeric order, capped at
    what exists); ``sample_n_series`` keeps the first N series, planned as a
    top-N (``TakeOrderedAndProject``: each task keeps N rows, the driver
    merges at most N per task).  ``sample_order="id"`` (default) orders by
    ``id``, a deterministic stand-in for file order; ``"file"`` takes the
    first N rows of the stored files exactly, ordered by Parquet's hidden
    ``_metadata.file_path`` / ``_metadata.row_index`` (``sales_wide`` must be
    a direct file scan).
    """
    days = day_columns(sales_wide.columns, sample_days)
    if not days:
        raise ValueError("No day columns (d_*) found")
    cols = [quote(c) for c in SERIES_COLUMNS + days]
    if sample_n_series is None:
        wide = sales_wide.selectExpr(*cols)
    elif sample_order == "file":
        wide = (
            sales_wide.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"))
            .orderBy("_f", "_r")
            .limit(int(sample_n_series))
            .selectExpr(*cols)
        )
    elif sample_order == "id":
        wide = sales_wide.selectExpr(*cols).orderBy("id").limit(int(sample_n_series))
    else:
        raise ValueError(f"unknown sample_order {sample_order!r}")
    return unpivot_days(wide, days)
