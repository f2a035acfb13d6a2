"""Daily roll-ups per asset and the daily performance mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.functions import categories as cat
from voltseries.functions.numeric import capacity_factor, round_dec

DAY_KEYS = ("asset_id", "date")


def int_generation_daily(hourly: DataFrame) -> DataFrame:
    """Sums, means, counts and shares per asset and day. A sum of NULLs is NULL."""
    category = F.col("performance_category")
    return hourly.groupBy(*DAY_KEYS).agg(
        F.max("asset_type").alias("asset_type"),
        F.max("asset_capacity_mw").alias("asset_capacity_mw"),
        F.max("asset_size_category").alias("asset_size_category"),
        round_dec("sum(gross_generation_mwh)", 4).alias("total_gross_generation_mwh"),
        round_dec("sum(net_generation_mwh)", 4).alias("total_net_generation_mwh"),
        round_dec("sum(curtailment_mwh)", 4).alias("total_curtailment_mwh"),
        round_dec("avg(soc_pct)", 2).alias("avg_soc_pct"),
        round_dec("sum(charge_mwh)", 4).alias("total_charge_mwh"),
        round_dec("sum(discharge_mwh)", 4).alias("total_discharge_mwh"),
        round_dec("sum(fuel_mmbtu)", 4).alias("total_fuel_mmbtu"),
        round_dec("avg(heat_rate_btu_kwh)", 2).alias("avg_heat_rate_btu_kwh"),
        round_dec("sum(co2_tonnes)", 4).alias("total_co2_tonnes"),
        round_dec("avg(gross_generation_mwh)", 4).alias("avg_hourly_gross_mwh"),
        round_dec("avg(net_generation_mwh)", 4).alias("avg_hourly_net_mwh"),
        round_dec("max(net_generation_mwh)", 4).alias("peak_hourly_net_mwh"),
        capacity_factor("sum(net_generation_mwh)", "max(asset_capacity_mw)", 24.0).alias(
            "daily_capacity_factor"
        ),
        round_dec("avg(capacity_factor)", 4).alias("avg_hourly_capacity_factor"),
        round_dec("avg(availability_pct)", 2).alias("avg_availability_pct"),
        round_dec("min(availability_pct)", 2).alias("min_availability_pct"),
        round_dec(
            "try_divide(sum(gross_generation_mwh) - sum(net_generation_mwh), "
            "sum(gross_generation_mwh)) * 100",
            2,
        ).alias("daily_loss_percentage"),
        round_dec("try_divide(sum(curtailment_mwh), sum(gross_generation_mwh)) * 100", 2).alias(
            "daily_curtailment_percentage"
        ),
        F.count("*").alias("total_hours"),
        F.count_if(F.col("net_generation_mwh") > 0).alias("generating_hours"),
        F.count_if(F.col("capacity_factor") > 0.5).alias("high_output_hours"),
        F.count_if(category == "Excellent").alias("excellent_hours"),
        F.count_if(category == "Good").alias("good_hours"),
        F.count_if(category == "Fair").alias("fair_hours"),
        F.count_if(category == "Poor").alias("poor_hours"),
        F.count_if("is_data_valid").alias("valid_observation_count"),
        F.count_if("is_zero_generation_anomaly").alias("zero_generation_anomaly_count"),
        F.count_if("meets_availability_target").alias("hours_meeting_availability_target"),
        round_dec("count_if(is_data_valid) / count(*) * 100", 2).alias("data_validity_pct"),
        F.min("timestamp").alias("first_generation_timestamp"),
        F.max("timestamp").alias("last_generation_timestamp"),
    )


def int_weather_daily(hourly: DataFrame) -> DataFrame:
    """Weather statistics, completeness and wind and daylight hours per asset and day."""
    return hourly.groupBy(*DAY_KEYS).agg(
        round_dec("avg(wind_speed_mps)", 2).alias("avg_wind_speed_mps"),
        round_dec("max(wind_speed_mps)", 2).alias("max_wind_speed_mps"),
        round_dec("min(wind_speed_mps)", 2).alias("min_wind_speed_mps"),
        round_dec("stddev_samp(wind_speed_mps)", 2).alias("std_wind_speed_mps"),
        round_dec("avg(ghi)", 2).alias("avg_ghi"),
        round_dec("max(ghi)", 2).alias("max_ghi"),
        round_dec("sum(ghi)", 2).alias("total_ghi"),
        round_dec("avg(temperature_c)", 2).alias("avg_temperature_c"),
        round_dec("max(temperature_c)", 2).alias("max_temperature_c"),
        round_dec("min(temperature_c)", 2).alias("min_temperature_c"),
        round_dec("avg(pressure_hpa)", 1).alias("avg_pressure_hpa"),
        round_dec("avg(relative_humidity)", 1).alias("avg_relative_humidity"),
        F.count("*").alias("observation_count"),
        F.count_if("is_data_complete").alias("complete_observation_count"),
        round_dec("count_if(is_data_complete) / count(*) * 100", 2).alias(
            "data_completeness_pct"
        ),
        round_dec("avg(CASE WHEN hour_of_day BETWEEN 10 AND 16 THEN ghi END)", 2).alias(
            "avg_peak_ghi"
        ),
        F.count_if(F.col("wind_speed_category") == "Strong").alias("strong_wind_hours"),
        F.count_if(F.col("wind_speed_category") == "Very Strong").alias("very_strong_wind_hours"),
        F.count_if(F.col("ghi") > 0).alias("daylight_hours"),
        F.min("timestamp").alias("first_observation_timestamp"),
        F.max("timestamp").alias("last_observation_timestamp"),
    )


def mart_asset_performance_daily(
    generation_daily: DataFrame,
    weather_daily: DataFrame,
    min_availability_pct: float = cat.MIN_AVAILABILITY_PCT,
) -> DataFrame:
    """Daily performance per asset; weather columns are NULL on days without weather."""
    weather = weather_daily.select(
        *DAY_KEYS, "avg_wind_speed_mps", "max_wind_speed_mps", "avg_ghi", "max_ghi",
        "total_ghi", "avg_temperature_c", "strong_wind_hours", "daylight_hours",
        "data_completeness_pct",
    )
    both = generation_daily.join(weather, list(DAY_KEYS), "left")
    return both.select(
        "asset_id", "date", "asset_type", "asset_capacity_mw", "asset_size_category",
        "total_gross_generation_mwh", "total_net_generation_mwh", "total_curtailment_mwh",
        "avg_hourly_net_mwh", "peak_hourly_net_mwh",
        "avg_soc_pct", "total_charge_mwh", "total_discharge_mwh",
        "total_fuel_mmbtu", "avg_heat_rate_btu_kwh", "total_co2_tonnes",
        "daily_capacity_factor", "avg_hourly_capacity_factor",
        "avg_availability_pct", "min_availability_pct",
        "daily_loss_percentage", "daily_curtailment_percentage",
        "total_hours", "generating_hours", "high_output_hours",
        round_dec("try_divide(generating_hours, total_hours) * 100", 2).alias(
            "generating_hours_pct"
        ),
        "excellent_hours", "good_hours", "fair_hours", "poor_hours",
        "avg_wind_speed_mps", "max_wind_speed_mps", "avg_ghi", "max_ghi", "total_ghi",
        "avg_temperature_c", "strong_wind_hours", "daylight_hours",
        "data_validity_pct", "data_completeness_pct", "zero_generation_anomaly_count",
        cat.daily_rating(F.col("daily_capacity_factor")).alias("daily_performance_rating"),
        cat.meets_availability(F.col("avg_availability_pct"), min_availability_pct).alias(
            "meets_availability_target"
        ),
        cat.is_high_quality_day(
            F.col("data_validity_pct"), F.col("data_completeness_pct")
        ).alias("has_high_quality_data"),
        "first_generation_timestamp", "last_generation_timestamp",
    )
