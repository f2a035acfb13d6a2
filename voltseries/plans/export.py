"""Export payloads: projections, the asset list and the manifest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltseries.operators.dedup import distinct_by
from voltseries.sources.records import write_json
from voltseries.sources.tables import lower_names, require_mart

SCHEMA_VERSION = "2.0"
MIN_ROWS = 10

# Columns of the export files.
DAILY_COLUMNS = (
    "asset_id", "date", "asset_type", "total_net_generation_mwh", "daily_capacity_factor",
    "avg_availability_pct", "total_curtailment_mwh", "daily_performance_rating",
    "excellent_hours", "good_hours", "fair_hours", "poor_hours",
    "avg_wind_speed_mps", "avg_ghi", "avg_temperature_c", "data_completeness_pct",
    "avg_soc_pct", "total_charge_mwh", "total_discharge_mwh",
    "total_fuel_mmbtu", "avg_heat_rate_btu_kwh", "total_co2_tonnes",
)
WEATHER_COLUMNS = (
    "asset_id", "date", "performance_score", "performance_category",
    "avg_expected_generation_mwh", "avg_actual_generation_mwh", "avg_performance_ratio_pct",
    "wind_r_squared", "solar_r_squared", "inferred_asset_type",
    "rolling_7d_avg_cf", "rolling_30d_avg_cf",
)
ASSET_COLUMNS = (
    "asset_id", "asset_name", "asset_type", "asset_capacity_mw", "asset_size_category",
    "latitude", "longitude", "region",
)


def display_name(name: Column, capacity: Column, technology: Column) -> Column:
    """``Name (100 MW wind)``; the capacity loses its decimals."""
    return F.concat(
        name, F.lit(" ("), capacity.cast("bigint").cast("string"), F.lit(" MW "),
        technology, F.lit(")"),
    )


def daily_payload(daily: DataFrame) -> DataFrame:
    return daily.select(*DAILY_COLUMNS)


def weather_payload(weather: DataFrame) -> DataFrame:
    return weather.select(*WEATHER_COLUMNS)


def assets_payload(dim: DataFrame) -> DataFrame:
    """One row per asset under the names of the export file."""
    one = distinct_by(dim.select(*ASSET_COLUMNS), ["asset_id"])
    return one.withColumn(
        "display_name",
        display_name(F.col("asset_name"), F.col("asset_capacity_mw"), F.col("asset_type")),
    ).withColumnsRenamed(
        {
            "asset_name": "name",
            "asset_capacity_mw": "capacity_mw",
            "asset_size_category": "size_category",
        }
    )


def assets_by_technology(assets: DataFrame) -> DataFrame:
    """Number of assets per technology; a missing one counts as ``unknown``."""
    kind = F.coalesce("asset_type", F.lit("unknown")).alias("asset_type")
    return assets.groupBy(kind).agg(F.count(F.lit(1)).alias("count"))


def manifest(
    daily: DataFrame,
    weather: DataFrame,
    assets: DataFrame,
    run_id: str,
    weather_source: str,
    generated_at: str,
) -> DataFrame:
    """One row: dates, asset counts by technology, row counts, version and labels."""
    # One entry per technology.
    by_type = F.array_sort(F.collect_list(F.struct("asset_type", "count")))
    counts = (
        assets_by_technology(assets)
        .agg(
            F.struct(
                F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
                F.map_from_entries(by_type).alias("by_type"),
            ).alias("counts")
        )
        .scalar()
    )
    weather_rows = weather.agg(F.count(F.lit(1)).alias("n")).scalar()
    span = daily.agg(
        F.min("date").cast("string").alias("start"),
        F.max("date").cast("string").alias("end"),
        F.count(F.lit(1)).alias("rows"),
    )
    return span.withColumn("counts", counts).select(
        F.lit(generated_at).alias("generated_at"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.struct("start", "end").alias("date_range"),
        F.col("counts.n").alias("asset_count"),
        F.col("counts.by_type").alias("asset_type_counts"),
        F.lit(weather_source).alias("weather_source"),
        F.struct(
            F.col("rows").alias("daily_performance"), weather_rows.alias("weather_performance")
        ).alias("row_counts"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def write_export(
    daily_mart: DataFrame,
    weather_mart: DataFrame,
    dim: DataFrame,
    folder: str,
    run_id: str = "",
    weather_source: str = "warehouse",
    generated_at: str | None = None,
) -> None:
    """Check the marts and write the four export folders.

    The marts should be stored tables: each is read more than once here.
    """
    daily = daily_payload(require_mart(lower_names(daily_mart), DAILY_COLUMNS, MIN_ROWS))
    weather = weather_payload(require_mart(lower_names(weather_mart), WEATHER_COLUMNS, MIN_ROWS))
    assets = assets_payload(require_mart(lower_names(dim), ASSET_COLUMNS))
    stamp = generated_at or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    write_json(daily, f"{folder}/daily_performance")
    write_json(weather, f"{folder}/weather_performance")
    write_json(assets, f"{folder}/assets")
    write_json(
        manifest(daily, weather, assets, run_id, weather_source, stamp), f"{folder}/manifest"
    )
