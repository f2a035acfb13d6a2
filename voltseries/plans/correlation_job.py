"""Correlation of daily generation with temperature, and enriched daily features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.operators.timeseries import (
    add_lag_features,
    add_rolling_stats,
    calculate_correlation,
)
from voltseries.sources.tables import current_table, lower_names, overwrite_table, require_mart

TARGET, DRIVER = "total_net_generation_mwh", "avg_temperature_c"
RESULT = f"corr_{TARGET}_{DRIVER}"
MIN_ROWS = 10


def correlation_results(daily: DataFrame) -> DataFrame:
    """One row per asset."""
    return calculate_correlation(daily, TARGET, DRIVER, partition_by="asset_id")


def enriched_daily(daily: DataFrame) -> DataFrame:
    """Lags 1, 3, 7 and full 7- and 30-row mean and deviation of daily generation."""
    lagged = add_lag_features(daily, TARGET, [1, 3, 7], "asset_id", order_by="date")
    return add_rolling_stats(
        lagged, TARGET, [7, 30], ["mean", "std"], "asset_id", order_by="date"
    )


def job_summary(results: DataFrame, enriched: DataFrame) -> DataFrame:
    """Row counts of both results and the mean correlation, one row."""
    enriched_rows = enriched.agg(F.count(F.lit(1)).alias("n")).scalar()
    return results.agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(RESULT).alias("mean_correlation")
    ).select("row_count", enriched_rows.alias("enriched_row_count"), "mean_correlation")


def run_correlation_job(daily: DataFrame, results_path: str, enriched_path: str) -> dict:
    """Check the mart, store both results, and return the summary of what is stored."""
    daily = require_mart(lower_names(daily), ["asset_id", "date", TARGET, DRIVER], MIN_ROWS)
    spark = daily.sparkSession
    overwrite_table(correlation_results(daily), results_path)
    overwrite_table(enriched_daily(daily), enriched_path)
    stored = current_table(spark, results_path), current_table(spark, enriched_path)
    return job_summary(*stored).first().asDict()
