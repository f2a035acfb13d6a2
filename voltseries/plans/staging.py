"""Cleaned hourly tables: one record per asset and hour, rounded and flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.functions import categories as cat
from voltseries.functions.calendar import day_of, staging_time_parts
from voltseries.functions.numeric import capacity_factor, round_dec
from voltseries.operators.dedup import LOAD_ID, keep_latest

# Digits kept per measurement.
WEATHER_DIGITS = {
    "wind_speed_mps": 2,
    "wind_direction_deg": 1,
    "ghi": 2,
    "temperature_c": 2,
    "pressure_hpa": 1,
    "relative_humidity": 1,
}
GENERATION_DIGITS = {
    "gross_generation_mwh": 4,
    "net_generation_mwh": 4,
    "curtailment_mwh": 4,
    "availability_pct": 2,
    "asset_capacity_mw": 2,
    "soc_pct": 2,
    "charge_mwh": 4,
    "discharge_mwh": 4,
    "fuel_mmbtu": 4,
    "heat_rate_btu_kwh": 2,
    "co2_tonnes": 4,
}

# The day is a function of the timestamp, so adding it to the key changes no
# group. It makes the sort of the de-duplication serve the join and the daily
# roll-ups that follow.
HOUR_KEYS = ("asset_id", "date", "timestamp")


def _latest(raw: DataFrame, columns: list[str]) -> DataFrame:
    typed = raw.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("asset_id").cast("string").alias("asset_id"),
        *columns,
        LOAD_ID,
    ).withColumn("date", day_of("timestamp"))
    return keep_latest(typed, HOUR_KEYS, LOAD_ID)


def stg_weather(raw: DataFrame, distinct: bool = False) -> DataFrame:
    """Hourly weather. ``distinct`` only matters for input without duplicate keys
    removed; after ``keep_latest`` no two rows are equal, so it is off by default."""
    rows = _latest(raw, list(WEATHER_DIGITS))
    wind, ghi, temp = F.col("wind_speed_mps"), F.col("ghi"), F.col("temperature_c")
    # Categories and flags read the unrounded measurements.
    out = rows.select(
        "timestamp",
        "asset_id",
        *[round_dec(f"CAST({c} AS DOUBLE)", n).alias(c) for c, n in WEATHER_DIGITS.items()],
        *staging_time_parts("timestamp"),
        "date",
        cat.wind_speed_category(wind).alias("wind_speed_category"),
        cat.irradiance_category(ghi).alias("irradiance_category"),
        cat.temperature_category(temp).alias("temperature_category"),
        cat.weather_is_complete(wind, F.col("wind_direction_deg"), ghi, temp).alias(
            "is_data_complete"
        ),
    )
    return out.distinct() if distinct else out


def stg_generation(
    raw: DataFrame, min_availability_pct: float = cat.MIN_AVAILABILITY_PCT
) -> DataFrame:
    """Hourly generation with capacity factor, losses, categories and flags."""
    rows = _latest(raw, ["asset_type", *GENERATION_DIGITS])
    gross, net = F.col("gross_generation_mwh"), F.col("net_generation_mwh")
    cap, avail = F.col("asset_capacity_mw"), F.col("availability_pct")
    # A step of its own, so that the code generated for each step stays small enough
    # to be compiled.
    rows = rows.withColumns(
        {
            "capacity_factor": capacity_factor("net_generation_mwh", "asset_capacity_mw"),
            "loss_percentage": round_dec(
                "try_divide(gross_generation_mwh - net_generation_mwh, gross_generation_mwh)"
                " * 100",
                2,
            ),
            "curtailment_percentage": round_dec(
                "try_divide(curtailment_mwh, gross_generation_mwh) * 100", 2
            ),
            "hours_at_capacity": round_dec(
                "try_divide(net_generation_mwh, asset_capacity_mw)", 4
            ),
        }
    )
    cf = F.col("capacity_factor")
    return rows.select(
        "timestamp",
        "asset_id",
        F.col("asset_type").cast("string").alias("asset_type"),
        *[round_dec(f"CAST({c} AS DOUBLE)", n).alias(c) for c, n in GENERATION_DIGITS.items()],
        *staging_time_parts("timestamp"),
        "date",
        "capacity_factor",
        "loss_percentage",
        "curtailment_percentage",
        "hours_at_capacity",
        cat.size_category(cap).alias("asset_size_category"),
        cat.hourly_performance(cf).alias("performance_category"),
        cat.meets_availability(avail, min_availability_pct).alias("meets_availability_target"),
        cat.generation_is_valid(gross, net, cap).alias("is_data_valid"),
        cat.is_idle_anomaly(net, avail, F.col("asset_type")).alias("is_zero_generation_anomaly"),
    )


def int_asset_weather_join(generation: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly generation with the weather of the same asset and hour (inner)."""
    g = generation.select(
        "timestamp", "date", "asset_id", "asset_type",
        "gross_generation_mwh", "net_generation_mwh", "curtailment_mwh",
        "availability_pct", "asset_capacity_mw", "capacity_factor",
        "charge_mwh", "discharge_mwh", "heat_rate_btu_kwh",
        F.col("is_data_valid").alias("generation_data_valid"),
    )
    w = weather.select(
        "timestamp", "date", "asset_id",
        "wind_speed_mps", "ghi", "temperature_c", "pressure_hpa",
        F.col("is_data_complete").alias("weather_data_complete"),
    )
    return (
        g.join(w, list(HOUR_KEYS), "inner")
        .withColumn(
            "is_complete_record",
            cat.true_when(F.col("generation_data_valid") & F.col("weather_data_complete")),
        )
        .withColumn("hour_of_day", F.hour("timestamp"))
        .withColumn("day_of_week", F.dayofweek("timestamp") - 1)
    )


def dim_asset(assets: DataFrame) -> DataFrame:
    """One row per asset with the size label."""
    return assets.select(
        F.col("asset_id").cast("string").alias("asset_id"),
        F.col("asset_name").cast("string").alias("asset_name"),
        F.col("asset_type").cast("string").alias("asset_type"),
        F.col("capacity_mw").cast("double").alias("asset_capacity_mw"),
        cat.size_category(F.col("capacity_mw").cast("double")).alias("asset_size_category"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("region").cast("string").alias("region"),
    )
