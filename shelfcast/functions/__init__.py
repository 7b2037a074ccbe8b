"""Column-level helpers: every function returns a Spark ``Column`` or works on
DataFrame metadata only (column names, types); none starts a job."""

from shelfcast.functions.columns import cast_columns, day_columns, day_number, require_columns
from shelfcast.functions.dates import date_sql, parse_date

__all__ = ["cast_columns", "date_sql", "day_columns", "day_number", "parse_date", "require_columns"]
