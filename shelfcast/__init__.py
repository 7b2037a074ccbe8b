"""shelfcast: a Spark-native retail demand lakehouse.

Raw CSV tables land as Parquet (bronze), get typed (silver), become conformed
dimension and fact tables (gold), turn into per-series lag / rolling features,
pass a data-quality gate, train a ridge baseline with Spark ML and are
evaluated with error metrics, predictions and a residual histogram.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; nothing in the data path goes through the driver.
"""

__version__ = "0.1.0"

from shelfcast.operators.evaluate import metrics_long, regression_metrics, residual_histogram, residuals
from shelfcast.operators.features import build_features
from shelfcast.operators.gold import dim_calendar, dim_series, fact_sell_prices, sales_long
from shelfcast.operators.model import fit_ridge, load_model, predict, save_model, test_set, train_set
from shelfcast.operators.quality import dq_report, not_null_tests, run_gate
from shelfcast.operators.typing import type_table
from shelfcast.plans.jobs import (
    run_bronze,
    run_dq,
    run_eval,
    run_features,
    run_gold,
    run_medallion,
    run_silver,
    run_train,
)
from shelfcast.plans.lake import Lake
from shelfcast.session import build_session

__all__ = [
    "Lake",
    "build_features",
    "build_session",
    "dim_calendar",
    "dim_series",
    "dq_report",
    "fact_sell_prices",
    "fit_ridge",
    "load_model",
    "metrics_long",
    "not_null_tests",
    "predict",
    "regression_metrics",
    "residual_histogram",
    "residuals",
    "run_bronze",
    "run_dq",
    "run_eval",
    "run_features",
    "run_gate",
    "run_gold",
    "run_medallion",
    "run_silver",
    "run_train",
    "sales_long",
    "save_model",
    "test_set",
    "train_set",
    "type_table",
]
