"""Folder layout of one lakehouse: landing (raw CSV) -> bronze -> silver -> gold."""

from __future__ import annotations

from dataclasses import dataclass

# Raw M5 table names the pipeline expects to find in the landing zone.
RAW_TABLES = ["calendar", "sell_prices", "sales_train_validation", "sales_train_evaluation", "sample_submission"]
GOLD_TABLES = ["dim_calendar", "dim_series", "fact_sell_prices", "fact_sales_long"]


@dataclass(frozen=True)
class Lake:
    root: str
    # raw tables may live outside the lake (a shared landing zone)
    landing_root: str | None = None

    @property
    def landing_dir(self) -> str:
        return self.landing_root or f"{self.root}/landing"

    def landing(self, table: str) -> str:
        return f"{self.landing_dir}/{table}.csv"

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}.parquet"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}.parquet"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}.parquet"

    @property
    def features(self) -> str:
        return f"{self.root}/gold/fact_sales_features.parquet"

    @property
    def model(self) -> str:
        return f"{self.root}/models/ridge_baseline"

    def output(self, name: str) -> str:
        return f"{self.root}/outputs/{name}"

    def checkpoint(self, name: str) -> str:
        """Streaming checkpoint folder of one incremental job."""
        return f"{self.root}/_checkpoints/{name}"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit/stages.json"
