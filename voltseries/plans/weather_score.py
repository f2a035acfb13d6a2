"""Weather-adjusted performance: a regression benchmark per asset, a score per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltseries.functions import categories as cat
from voltseries.functions.numeric import (
    clamp,
    ratio,
    round_dec,
    safe_corr,
    safe_intercept,
    safe_slope,
)
from voltseries.session import scratch_path

NET, CF, WIND, SUN = "net_generation_mwh", "capacity_factor", "wind_speed_mps", "ghi"


def complete_hours(joined: DataFrame) -> DataFrame:
    """The hours with valid generation and complete weather."""
    return joined.filter(F.col("is_complete_record")).select(
        "asset_id", "asset_type", "date", WIND, SUN, NET, CF,
        "asset_capacity_mw", "charge_mwh", "discharge_mwh", "heat_rate_btu_kwh",
    )


def asset_models(hours: DataFrame) -> DataFrame:
    """Per asset: means, correlations and one regression line per weather driver."""
    return hours.groupBy("asset_id").agg(
        F.max("asset_type").alias("asset_type"),
        F.max("asset_capacity_mw").alias("asset_capacity_mw"),
        F.count(F.lit(1)).alias("total_observations"),
        round_dec(f"avg({NET})", 4).alias("avg_net_generation_mwh"),
        round_dec(f"avg({CF})", 4).alias("avg_capacity_factor"),
        round_dec(f"avg({WIND})", 2).alias("avg_wind_speed_mps"),
        round_dec(f"avg({SUN})", 2).alias("avg_ghi"),
        round_dec(safe_corr(WIND, NET), 4).alias("wind_generation_correlation"),
        round_dec(safe_corr(SUN, NET), 4).alias("solar_generation_correlation"),
        round_dec(safe_corr(WIND, CF), 4).alias("wind_cf_correlation"),
        round_dec(safe_corr(SUN, CF), 4).alias("solar_cf_correlation"),
        round_dec(safe_slope(NET, WIND), 6).alias("wind_regression_slope"),
        round_dec(safe_intercept(NET, WIND), 6).alias("wind_regression_intercept"),
        round_dec(safe_slope(NET, SUN), 6).alias("solar_regression_slope"),
        round_dec(safe_intercept(NET, SUN), 6).alias("solar_regression_intercept"),
        round_dec(F.pow(safe_corr(WIND, NET), F.lit(2.0)), 4).alias("wind_r_squared"),
        round_dec(F.pow(safe_corr(SUN, NET), F.lit(2.0)), 4).alias("solar_r_squared"),
    )


def _line(driver: str, intercept: str, slope: str) -> Column:
    line = f"{intercept} + {slope} * {driver}"
    return round_dec(f"CASE WHEN ({line}) IS NOT NULL THEN greatest({line}, 0D) END", 4)


def expected_generation(hours: DataFrame, models: DataFrame) -> DataFrame:
    """Hourly output expected from wind and from sun, the chosen one, and the ratio.

    The driver with the larger absolute correlation is chosen; sun if either is NULL.
    """
    modelled = hours.join(models, "asset_id", "inner")
    wind_leads = F.abs("wind_generation_correlation") > F.abs("solar_generation_correlation")
    return (
        modelled.withColumns(
            {
                "expected_generation_from_wind": _line(
                    WIND, "wind_regression_intercept", "wind_regression_slope"
                ),
                "expected_generation_from_solar": _line(
                    SUN, "solar_regression_intercept", "solar_regression_slope"
                ),
            }
        )
        .withColumn(
            "expected_generation_mwh",
            F.when(wind_leads, F.col("expected_generation_from_wind")).otherwise(
                F.col("expected_generation_from_solar")
            ),
        )
        .withColumn(
            "performance_ratio_pct",
            round_dec(f"try_divide({NET}, expected_generation_mwh) * 100", 2),
        )
    )


MODEL_COLUMNS = (
    "asset_capacity_mw",
    "wind_generation_correlation", "solar_generation_correlation",
    "wind_cf_correlation", "solar_cf_correlation",
    "wind_r_squared", "solar_r_squared",
    "wind_regression_slope", "wind_regression_intercept",
    "solar_regression_slope", "solar_regression_intercept",
    "asset_type", "total_observations",
)


def daily_scores(hours: DataFrame, models: DataFrame) -> DataFrame:
    """Everything the mart needs per asset and day, from one pass over the hours.

    The model columns are constant within an asset and ride along, the numbers as
    maxima and the technology as a key, so the models need not be computed or joined
    a second time. Without text among the maxima Spark can aggregate by hash.
    """
    numeric = [c for c in MODEL_COLUMNS if c != "asset_type"]
    scored = expected_generation(
        hours.drop("asset_type", "asset_capacity_mw"), models.select("asset_id", *MODEL_COLUMNS)
    )
    days = scored.groupBy("asset_id", "date", "asset_type").agg(
        *[F.max(c).alias(c) for c in numeric],
        F.count(F.lit(1)).alias("hourly_observations"),
        round_dec(f"avg({NET})", 4).alias("daily_avg_net_generation_mwh"),
        round_dec(f"sum({NET})", 4).alias("daily_total_net_generation_mwh"),
        round_dec(f"avg({CF})", 4).alias("daily_avg_capacity_factor"),
        round_dec("avg(expected_generation_mwh)", 4).alias("avg_expected_generation_mwh"),
        round_dec(f"avg({NET})", 4).alias("avg_actual_generation_mwh"),
        round_dec("avg(performance_ratio_pct)", 2).alias("avg_performance_ratio_pct"),
        F.sum("charge_mwh").alias("total_charge_mwh"),
        F.sum("discharge_mwh").alias("total_discharge_mwh"),
        F.min("heat_rate_btu_kwh").alias("min_heat_rate"),
        F.avg("heat_rate_btu_kwh").alias("avg_heat_rate"),
    )
    return days.withColumn("performance_score", technology_score())


def technology_score() -> Column:
    """Battery: discharge over charge. Gas: best over mean heat rate. Others: the ratio.

    Clamped to 0–100; a battery or gas day without a ratio scores 100, others 0.
    """
    kind = F.col("asset_type")
    percent = lambda a, b: clamp(ratio(a, b) * 100, 0, 100)
    full, none = F.lit(100.0), F.lit(0.0)
    score = (
        F.when(
            kind == "battery",
            F.coalesce(percent("total_discharge_mwh", "total_charge_mwh"), full),
        )
        .when(kind == "gas", F.coalesce(percent("min_heat_rate", "avg_heat_rate"), full))
        .otherwise(F.coalesce(clamp("avg_performance_ratio_pct", 0, 100), none))
    )
    return round_dec(score, 2)


def rolling_means(days: DataFrame) -> DataFrame:
    """Add 7- and 30-row trailing means of daily generation and capacity factor.

    Short frames at the start of a series count. A series has one row per day, so
    one asset is at most as long as the calendar.
    """
    by_day = Window.partitionBy("asset_id").orderBy("date")
    frames = {"7d": by_day.rowsBetween(-6, 0), "30d": by_day.rowsBetween(-29, 0)}
    sources = {
        "generation": "daily_avg_net_generation_mwh",
        "cf": "daily_avg_capacity_factor",
    }
    return days.select(
        "*",
        *[
            round_dec(F.avg(column).over(frame), 4).alias(f"rolling_{span}_avg_{short}")
            for span, frame in frames.items()
            for short, column in sources.items()
        ],
    )


def staged_hours(joined: DataFrame) -> DataFrame:
    """The complete hours as a table in the scratch folder, clustered by asset.

    They are read twice, for the models and for the scores. Stored, the
    de-duplication, its sorts and the hourly join run once instead of twice.
    """
    hours = complete_hours(joined)
    path = scratch_path(joined.sparkSession, "hours")
    hours.write.parquet(path)
    return joined.sparkSession.read.schema(hours.schema).parquet(path)


def mart_asset_weather_performance(
    joined: DataFrame, models: DataFrame | None = None
) -> DataFrame:
    """The weather-adjusted mart, one row per asset and day.

    Without a stored copy of ``asset_models`` the hours are staged first.
    """
    if models is None:
        hours = staged_hours(joined)
        models = asset_models(hours)
    else:
        hours = complete_hours(joined)
    days = rolling_means(daily_scores(hours, models))
    return days.select(
        "asset_id", "date", "asset_capacity_mw",
        "wind_generation_correlation", "solar_generation_correlation",
        "wind_cf_correlation", "solar_cf_correlation",
        "wind_r_squared", "solar_r_squared",
        "wind_regression_slope", "wind_regression_intercept",
        "solar_regression_slope", "solar_regression_intercept",
        "avg_expected_generation_mwh", "avg_actual_generation_mwh",
        "avg_performance_ratio_pct", "performance_score",
        cat.score_category(F.col("performance_score")).alias("performance_category"),
        "rolling_7d_avg_generation", "rolling_7d_avg_cf",
        "rolling_30d_avg_generation", "rolling_30d_avg_cf",
        F.col("asset_type").alias("inferred_asset_type"),
        F.col("total_observations").alias("total_hourly_observations"),
    )
