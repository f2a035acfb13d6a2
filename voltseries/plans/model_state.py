"""Regression models kept up to date by mergeable moments.

The state is a table with one row per asset and day: how many hours it holds, and per pair of
weather driver and output the count, means, extremes, squared deviations and co-moment of the
hours with both values. Rows of any days merge into the moments of all their hours, so a new day
updates the models by itself: the older hours are not read again.

The merge goes in two steps over the same rows: the means of an asset first, then the
moments about them, each day adding its own and the weighted product of its distances from the
means. Nothing is taken as a difference of large sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltseries.functions.numeric import nan_to_null, ratio, round_dec
from voltseries.plans.weather_score import CF, NET, SUN, WIND

# Pairs of driver and output whose co-moments the models need.
PAIRS = {"wind_net": (WIND, NET), "sun_net": (SUN, NET), "wind_cf": (WIND, CF), "sun_cf": (SUN, CF)}
SINGLES = {"net": NET, "cf": CF, "wind": WIND, "sun": SUN}


def day_moments(hours: DataFrame) -> DataFrame:
    """The state rows of some complete hours: one row per asset and day."""
    values = []
    for name, column in SINGLES.items():
        values += [F.count(column).alias(f"{name}_n"), F.avg(column).alias(f"{name}_m")]
    for name, (driver, output) in PAIRS.items():
        x, y = nan_to_null(driver), nan_to_null(output)
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        n = F.count(x)
        values += [
            n.alias(f"{name}_n"),
            F.avg(x).alias(f"{name}_mx"),
            F.avg(y).alias(f"{name}_my"),
            (F.var_pop(x) * n).alias(f"{name}_sx"),
            (F.var_pop(y) * n).alias(f"{name}_sy"),
            (F.covar_pop(x, y) * n).alias(f"{name}_sxy"),
            F.min(x).alias(f"{name}_lowx"),
            F.max(x).alias(f"{name}_highx"),
            F.min(y).alias(f"{name}_lowy"),
            F.max(y).alias(f"{name}_highy"),
        ]
    return hours.groupBy("asset_id", "date").agg(
        F.max("asset_type").alias("asset_type"),
        F.max("asset_capacity_mw").alias("asset_capacity_mw"),
        F.count(F.lit(1)).alias("n_hours"),
        *values,
    )


def update_state(hours: DataFrame, path: str) -> None:
    """Put the days of ``hours`` into the state at ``path``; only these days are written.

    ``hours`` must hold whole days: a day that is there already is replaced, so a load may
    be repeated. Other days are neither read nor written. Rows without a day are a day of
    their own.
    """
    writer = day_moments(hours).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _mean(value: str, count: str, over) -> Column:
    return ratio(F.sum(F.col(value) * F.col(count)).over(over), F.sum(count).over(over))


def merged_moments(state: DataFrame) -> DataFrame:
    """One row per asset: the moments of all hours of the state's days.

    An asset has a row per day, so the calendar bounds its rows.
    """
    asset = Window.partitionBy("asset_id")
    means = {f"{p}_m{v}_all": _mean(f"{p}_m{v}", f"{p}_n", asset) for p in PAIRS for v in "xy"}
    about = state.withColumns(means)
    values = []
    for name in SINGLES:
        total = F.sum(F.col(f"{name}_m") * F.col(f"{name}_n"))
        values.append(ratio(total, F.sum(f"{name}_n")).alias(f"{name}_m"))
    for p in PAIRS:
        far = {v: F.col(f"{p}_m{v}") - F.col(f"{p}_m{v}_all") for v in "xy"}
        n = F.col(f"{p}_n")
        values += [
            F.sum(n).alias(f"{p}_n"),
            *[F.max(f"{p}_m{v}_all").alias(f"{p}_m{v}") for v in "xy"],
            *[F.sum(F.col(f"{p}_s{v}") + n * far[v] * far[v]).alias(f"{p}_s{v}") for v in "xy"],
            F.sum(F.col(f"{p}_sxy") + n * far["x"] * far["y"]).alias(f"{p}_sxy"),
            *[F.min(f"{p}_low{v}").alias(f"{p}_low{v}") for v in "xy"],
            *[F.max(f"{p}_high{v}").alias(f"{p}_high{v}") for v in "xy"],
        ]
    return about.groupBy("asset_id").agg(
        F.max("asset_type").alias("asset_type"),
        F.max("asset_capacity_mw").alias("asset_capacity_mw"),
        F.sum("n_hours").alias("total_observations"),
        *values,
    )


def _varies(p: str, v: str) -> Column:
    # Moments of equal values may be noise above 0; their extremes are equal.
    return F.col(f"{p}_high{v}") > F.col(f"{p}_low{v}")


def _corr(p: str) -> Column:
    value = F.try_divide(F.col(f"{p}_sxy"), F.sqrt(f"{p}_sx") * F.sqrt(f"{p}_sy"))
    return F.when(_varies(p, "x") & _varies(p, "y"), value)


def _slope(p: str) -> Column:
    return F.when(_varies(p, "x"), F.try_divide(F.col(f"{p}_sxy"), F.col(f"{p}_sx")))


def models_of(state: DataFrame) -> DataFrame:
    """The columns of ``weather_score.asset_models``, from the state alone."""
    intercept = {p: F.col(f"{p}_my") - _slope(p) * F.col(f"{p}_mx") for p in ("wind_net", "sun_net")}
    return merged_moments(state).select(
        "asset_id", "asset_type", "asset_capacity_mw", "total_observations",
        round_dec(F.col("net_m"), 4).alias("avg_net_generation_mwh"),
        round_dec(F.col("cf_m"), 4).alias("avg_capacity_factor"),
        round_dec(F.col("wind_m"), 2).alias("avg_wind_speed_mps"),
        round_dec(F.col("sun_m"), 2).alias("avg_ghi"),
        round_dec(_corr("wind_net"), 4).alias("wind_generation_correlation"),
        round_dec(_corr("sun_net"), 4).alias("solar_generation_correlation"),
        round_dec(_corr("wind_cf"), 4).alias("wind_cf_correlation"),
        round_dec(_corr("sun_cf"), 4).alias("solar_cf_correlation"),
        round_dec(_slope("wind_net"), 6).alias("wind_regression_slope"),
        round_dec(intercept["wind_net"], 6).alias("wind_regression_intercept"),
        round_dec(_slope("sun_net"), 6).alias("solar_regression_slope"),
        round_dec(intercept["sun_net"], 6).alias("solar_regression_intercept"),
        round_dec(F.pow(_corr("wind_net"), F.lit(2.0)), 4).alias("wind_r_squared"),
        round_dec(F.pow(_corr("sun_net"), F.lit(2.0)), 4).alias("solar_r_squared"),
    )
