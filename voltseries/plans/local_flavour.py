"""The second, in-memory flavour of the marts, for a fleet with known parameters.

It differs from the mart chain on purpose: capacity factor over the observed
hours, driver by technology, only operating hours scored, batteries and gas scored
against their rated efficiency. Nothing is rounded, and sums of NULLs are 0. Labels
of daily figures disregard binary noise, so that the order of a sum does not decide them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltseries.functions import categories as cat
from voltseries.functions.calendar import day_of
from voltseries.functions.engineering import BATTERY_ROUND_TRIP_EFFICIENCY, GAS_DEFAULTS
from voltseries.functions.numeric import (
    clamp,
    linear_fit,
    nan_to_null,
    ratio,
    without_noise,
)

OPERATING_SHARE = 0.02
ACTIVE_MWH = 1e-6


def _sum0(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def daily_frame_observed_hours(generation: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily rows with the capacity factor over the hours that were observed."""
    hours = generation.withColumn("date", day_of("timestamp")).withColumn(
        "_rating", cat.hourly_performance(ratio("net_generation_mwh", "asset_capacity_mw"))
    )
    rating = F.col("_rating")
    days = hours.groupBy("asset_id", "date").agg(
        F.max("asset_type").alias("asset_type"),
        F.max("asset_capacity_mw").alias("asset_capacity_mw"),
        _sum0("gross_generation_mwh").alias("total_gross_generation_mwh"),
        _sum0("net_generation_mwh").alias("total_net_generation_mwh"),
        _sum0("curtailment_mwh").alias("total_curtailment_mwh"),
        F.avg("availability_pct").alias("avg_availability_pct"),
        F.count(F.lit(1)).alias("observed_hours"),
        F.count_if(rating == "Excellent").alias("excellent_hours"),
        F.count_if(rating == "Good").alias("good_hours"),
        F.count_if(rating == "Fair").alias("fair_hours"),
        F.count_if(rating == "Poor").alias("poor_hours"),
        F.avg("soc_pct").alias("avg_soc_pct"),
        _sum0("charge_mwh").alias("total_charge_mwh"),
        _sum0("discharge_mwh").alias("total_discharge_mwh"),
        _sum0("fuel_mmbtu").alias("total_fuel_mmbtu"),
        F.avg("heat_rate_btu_kwh").alias("avg_heat_rate_btu_kwh"),
        _sum0("co2_tonnes").alias("total_co2_tonnes"),
    )
    weather_days = (
        weather.withColumn("date", day_of("timestamp"))
        .groupBy("asset_id", "date")
        .agg(
            F.avg("wind_speed_mps").alias("avg_wind_speed_mps"),
            F.avg("ghi").alias("avg_ghi"),
            F.avg("temperature_c").alias("avg_temperature_c"),
        )
    )
    cf = ratio("total_net_generation_mwh", F.col("asset_capacity_mw") * F.col("observed_hours"))
    return (
        days.join(weather_days, ["asset_id", "date"], "left")
        .withColumn("daily_capacity_factor", cf)
        .withColumn("data_completeness_pct", F.lit(100.0))
        .withColumn(
            "daily_performance_rating",
            cat.daily_rating(without_noise("daily_capacity_factor")),
        )
    )


def with_plant_parameters(assets: DataFrame) -> DataFrame:
    """Add the rated efficiencies a dimension does not carry, as defaults."""
    defaults = {
        "round_trip_efficiency": BATTERY_ROUND_TRIP_EFFICIENCY,
        "full_load_heat_rate": GAS_DEFAULTS["heat_rate_btu_kwh"],
    }
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in assets.columns}
    return assets.withColumns(missing) if missing else assets


def operational_ratio() -> Column:
    """Battery: rated round-trip efficiency while discharging. Gas: full-load over
    actual heat rate while running. NULL otherwise."""
    kind = F.col("technology")
    discharging = F.coalesce(F.col("discharge_mwh"), F.lit(0.0)) > ACTIVE_MWH
    running = F.col("net_generation_mwh") > ACTIVE_MWH
    heat_rate = F.coalesce(F.col("heat_rate_btu_kwh"), F.col("full_load_heat_rate"))
    return F.when(
        (kind == "battery") & discharging, F.col("round_trip_efficiency") * 100.0
    ).when(
        (kind == "gas") & running, clamp(ratio("full_load_heat_rate", heat_rate) * 100.0, 0, 100)
    )


def hourly_with_driver(
    generation: DataFrame, weather: DataFrame, assets: DataFrame
) -> DataFrame:
    """Generation, its weather driver (missing = 0) and the plant parameters."""
    plants = with_plant_parameters(assets).select(
        "asset_id",
        F.col("asset_type").alias("technology"),
        "capacity_mw",
        "round_trip_efficiency",
        "full_load_heat_rate",
    )
    hours = generation.join(
        weather.select("timestamp", "asset_id", "wind_speed_mps", "ghi"),
        ["asset_id", "timestamp"],
        "left",
    ).join(plants, "asset_id", "inner")
    driver = F.when(F.col("technology") == "wind", F.col("wind_speed_mps")).when(
        F.col("technology") == "solar", F.col("ghi")
    )
    return hours.withColumn("date", day_of("timestamp")).withColumn(
        "driver",
        F.when(
            F.col("technology").isin(*cat.WEATHER_DRIVEN), F.coalesce(driver, F.lit(0.0))
        ),
    )


def fit_by_asset(hours: DataFrame) -> DataFrame:
    """Line of net generation on the driver, per wind or solar asset."""
    fit = linear_fit("driver", "net_generation_mwh", "timestamp")
    return (
        hours.filter(F.col("technology").isin(*cat.WEATHER_DRIVEN))
        .groupBy("asset_id")
        .agg(*[c.alias(name) for name, c in fit.items()])
    )


def score_hours(hours: DataFrame) -> DataFrame:
    """Expected output and performance ratio per hour, for all technologies."""
    fits = fit_by_asset(hours)
    weather_driven = F.col("technology").isin(*cat.WEATHER_DRIVEN)
    net = F.col("net_generation_mwh")
    expected = F.when(
        weather_driven, clamp(F.col("slope") * F.col("driver") + F.col("intercept"), low=0)
    ).otherwise(net)
    operating = F.col("expected") > OPERATING_SHARE * F.col("capacity_mw")
    return (
        hours.join(fits, "asset_id", "left")
        .withColumn("expected", expected)
        .withColumn(
            "ratio",
            F.when(
                weather_driven, F.when(operating, ratio(net * 100.0, "expected"))
            ).otherwise(operational_ratio()),
        )
    )


def weather_performance_local(
    generation: DataFrame, weather: DataFrame, assets: DataFrame, daily: DataFrame
) -> DataFrame:
    """Daily scores of the whole fleet in one grouped plan."""
    hours = score_hours(hourly_with_driver(generation, weather, assets))
    kind = F.col("technology")
    days = hours.groupBy("asset_id", "date").agg(
        F.max("technology").alias("technology"),
        F.avg("expected").alias("avg_expected_generation_mwh"),
        F.avg("net_generation_mwh").alias("avg_actual_generation_mwh"),
        F.avg(nan_to_null("ratio")).alias("avg_performance_ratio_pct"),
        F.max(F.when(kind == "wind", F.col("r2"))).alias("wind_r_squared"),
        F.max(F.when(kind == "solar", F.col("r2"))).alias("solar_r_squared"),
    )
    score = clamp("avg_performance_ratio_pct", 0, 100)
    scored = days.withColumn("performance_score", score).withColumn(
        "performance_category", cat.score_category(without_noise("performance_score"))
    )
    by_day = Window.partitionBy("asset_id").orderBy("date")
    rolling = daily.select(
        "asset_id",
        "date",
        F.avg("daily_capacity_factor").over(by_day.rowsBetween(-6, 0)).alias("rolling_7d_avg_cf"),
        F.avg("daily_capacity_factor").over(by_day.rowsBetween(-29, 0)).alias("rolling_30d_avg_cf"),
    )
    return scored.join(rolling, ["asset_id", "date"], "left").withColumnRenamed(
        "technology", "inferred_asset_type"
    )
