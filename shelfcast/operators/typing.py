"""Silver types of the raw tables (P1-P8): one declared schema per table.

A declaration names the target type of columns, exactly or by prefix; a table
is typed by ONE projection that casts what is declared and passes every other
column through.  Declared columns that a table lacks are left out, unless they
are listed as needed.  With ANSI mode (the 4.x default) a value out of range
raises instead of wrapping.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from shelfcast.functions.columns import cast_columns
from shelfcast.functions.dates import date_sql


@dataclass(frozen=True)
class Declared:
    """Target types by column name and by prefix; ``needed`` names must exist."""

    types: dict[str, str] = field(default_factory=dict)
    prefixes: dict[str, str] = field(default_factory=dict)
    needed: tuple[str, ...] = ()

    def target(self, name: str) -> str | None:
        if name in self.types:
            return self.types[name]
        return next((t for prefix, t in self.prefixes.items() if name.startswith(prefix)), None)


# The types of the silver layer.
_SALES = Declared(prefixes={"d_": "int"})
SILVER = {
    "calendar": Declared(
        {
            "date": "date", "wm_yr_wk": "int", "wday": "smallint", "month": "smallint", "year": "smallint",
            "snap_CA": "tinyint", "snap_TX": "tinyint", "snap_WI": "tinyint",
        },
        needed=("date",),
    ),
    "sell_prices": Declared({"wm_yr_wk": "int", "sell_price": "float"}),
    "sales_train_validation": _SALES,
    "sales_train_evaluation": _SALES,
    "sample_submission": Declared(prefixes={"F": "float"}),
}


def type_table(name: str, df: DataFrame) -> DataFrame:
    """``df`` with the silver types of table ``name``; a table without a
    declaration passes through unchanged (P8)."""
    declared = SILVER.get(name)
    if declared is None:
        return df
    lacking = [c for c in declared.needed if c not in df.columns]
    if lacking:
        raise ValueError(f"table {name} lacks {lacking}")
    targets = {c: t for c in df.columns if (t := declared.target(c))}
    dates = {c: date_sql(df.schema[c]) for c, t in targets.items() if t == "date"}
    return cast_columns(df, {c: t for c, t in targets.items() if c not in dates}, dates)


def type_calendar(df: DataFrame) -> DataFrame:
    return type_table("calendar", df)


__all__ = ["SILVER", "Declared", "type_calendar", "type_table"]
