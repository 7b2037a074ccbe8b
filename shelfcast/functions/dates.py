"""Date parsing (P3) and the calendar attributes derived from a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: SQL that makes a date of a column, by the column's type; other types are
#: cast.  Text that is no ISO date (``2020-1-2`` is one) becomes NULL, whole
#: numbers count days from 1970-01-01, times lose their time of day.
_BY_TYPE = {
    "string": "try_to_date({c}, 'yyyy-M-d')",
    "timestamp": "to_date({c})",
    "timestamp_ntz": "to_date({c})",
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), "date_from_unix_date(CAST({c} AS INT))"),
}


def date_sql(column: T.StructField) -> str:
    """SQL expression of the column as a date."""
    c = "`" + column.name.replace("`", "``") + "`"
    return _BY_TYPE.get(column.dataType.simpleString(), "CAST({c} AS DATE)").format(c=c)


def parse_date(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a date, by its type in ``df``."""
    return F.expr(date_sql(df.schema[name]))


# Fixed values of the M5 calendar conventions.
WEEKEND_DAYS = ["Saturday", "Sunday"]


def m5_wday(dt: Column) -> Column:
    """M5 weekday number: Saturday = 1 ... Friday = 7.

    Spark's ``dayofweek`` is Sunday = 1 ... Saturday = 7.
    """
    return (F.dayofweek(dt) % 7 + 1).cast("smallint")


def weekday_name(dt: Column) -> Column:
    return F.date_format(dt, "EEEE")
