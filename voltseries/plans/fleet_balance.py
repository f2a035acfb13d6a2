"""Theoretical output per asset, net load of the fleet, and curtailment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltseries.functions import engineering as eng
from voltseries.functions.numeric import clamp, ratio
from voltseries.operators.ordering import rank_share

DEMAND_SHARE = 0.55


def _parameters(assets: DataFrame, defaults: dict[str, float]) -> dict:
    """A column per parameter: the dimension's own if it has one, else the default."""
    return {
        name: F.coalesce(F.col(name), F.lit(value)) if name in assets.columns else F.lit(value)
        for name, value in defaults.items()
    }


def renewable_potential(weather: DataFrame, assets: DataFrame) -> DataFrame:
    """Theoretical MWh of each wind and solar asset per hour, before curtailment."""
    wind = _parameters(assets, eng.WIND_DEFAULTS)
    solar = _parameters(assets, eng.SOLAR_DEFAULTS)
    plants = assets.filter(F.col("asset_type").isin("wind", "solar")).drop(
        "asset_name", "latitude", "longitude", "region"
    )
    temp, pressure, cap = F.col("temperature_c"), F.col("pressure_hpa"), F.col("capacity_mw")
    wind_mwh = eng.wind_output(
        F.col("wind_speed_mps"), temp, pressure, cap,
        wind["cut_in_mps"], wind["rated_mps"], wind["cut_out_mps"],
        wind["wake_loss"], wind["availability"],
    )
    solar_mwh = eng.solar_output(
        F.col("ghi"), temp, F.col("cloud_cover_pct"), cap,
        solar["noct_c"], solar["temp_coeff_per_c"], solar["dc_ac_ratio"],
        solar["system_derate"],
    )
    return weather.join(plants, "asset_id").select(
        "asset_id",
        "timestamp",
        "asset_type",
        "capacity_mw",
        F.when(F.col("asset_type") == "wind", wind_mwh).otherwise(solar_mwh).alias(
            "potential_mwh"
        ),
    )


def demand_scale(assets: DataFrame) -> DataFrame:
    """One row: the demand scale in MW, from wind, solar and gas capacity."""
    supply = F.sum(
        F.when(F.col("asset_type").isin("wind", "solar", "gas"), F.col("capacity_mw"))
    )
    total = F.coalesce(F.when(supply != 0, supply), F.lit(1.0))
    return assets.agg((total * DEMAND_SHARE).alias("scale_mw"))


def hourly_balance(potential: DataFrame, hours: DataFrame, assets: DataFrame) -> DataFrame:
    """Demand, renewable total and net load of every hour in ``hours``."""
    totals = potential.groupBy("timestamp").agg(F.sum("potential_mwh").alias("renewable_mw"))
    scale = demand_scale(assets).scalar()
    return (
        hours.select("timestamp")
        .distinct()
        .join(totals, "timestamp", "left")
        .withColumn("renewable_mw", F.coalesce("renewable_mw", F.lit(0.0)))
        .withColumn(
            "demand_mw", eng.demand_mw(F.hour("timestamp"), F.dayofyear("timestamp"), scale)
        )
        .withColumn("net_load_mw", F.col("demand_mw") - F.col("renewable_mw"))
    )


def net_load_signal(balance: DataFrame) -> DataFrame:
    """Add the rank of each hour's net load, scaled to [0, 1]."""
    return rank_share(balance, "net_load_mw", ["timestamp"])


def allocate_curtailment(potential: DataFrame, balance: DataFrame) -> DataFrame:
    """Split each hour's oversupply over its assets in proportion to their output."""
    surplus = clamp(F.col("renewable_mw") - F.col("demand_mw"), low=0)
    share = balance.select(
        "timestamp",
        F.when(F.col("renewable_mw") > 0, ratio(surplus, "renewable_mw"))
        .otherwise(F.lit(0.0))
        .alias("curtail_share"),
    )
    return (
        potential.join(share, "timestamp")
        .withColumn("curtailment_mwh", F.col("potential_mwh") * F.col("curtail_share"))
        .withColumn(
            "net_generation_mwh", clamp(F.col("potential_mwh") - F.col("curtailment_mwh"), low=0)
        )
    )
