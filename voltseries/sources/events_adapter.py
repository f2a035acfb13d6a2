"""Weather, generation and asset frames derived from an ``events`` table.

``events`` holds (event_id, ts, user_id, value, …). Each user stands for an asset,
each event for one hourly record of it, and the event id for the load that brought
it, so repeated (asset, hour) pairs are re-loads of the same record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession



def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


# The mapping, as SQL expressions. Double literals keep the arithmetic in doubles.
_ASSET_ID = (
    "concat('ASSET_', lpad(CAST(user_id AS STRING), "
    "greatest(4, length(CAST(user_id AS STRING))), '0'))"
)
_HOUR = "make_timestamp_ntz(year(ts), month(ts), dayofmonth(ts), hour(ts), 0, 0)"
_KIND = (
    "CASE user_id % 4 WHEN 0 THEN 'wind' WHEN 1 THEN 'solar' WHEN 2 THEN 'battery' "
    "ELSE 'gas' END"
)
_CAPACITY = "40D + 20D * (user_id % 5)"
_ENERGY = f"least(value, {_CAPACITY})"
_BATTERY, _GAS, _CHARGING = "user_id % 4 = 2", "user_id % 4 = 3", "event_id % 2 = 0"


def generation_frame(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"{_HOUR} AS timestamp",
        f"{_ASSET_ID} AS asset_id",
        f"{_KIND} AS asset_type",
        f"CASE WHEN {_BATTERY} AND {_CHARGING} THEN 0D ELSE {_ENERGY} END "
        "AS gross_generation_mwh",
        f"CASE WHEN {_BATTERY} AND {_CHARGING} THEN -{_ENERGY} WHEN event_id % 61 = 0 THEN NULL "
        f"ELSE {_ENERGY} * (1D - 0.02D * (event_id % 5)) END AS net_generation_mwh",
        "0.05D * (event_id % 3) AS curtailment_mwh",
        "80D + event_id % 21 AS availability_pct",
        f"{_CAPACITY} AS asset_capacity_mw",
        f"CASE WHEN {_BATTERY} THEN 10D + event_id % 86 END AS soc_pct",
        f"CASE WHEN {_BATTERY} THEN CASE WHEN {_CHARGING} THEN {_ENERGY} ELSE 0D END END "
        "AS charge_mwh",
        f"CASE WHEN {_BATTERY} THEN CASE WHEN {_CHARGING} THEN 0D ELSE {_ENERGY} END END "
        "AS discharge_mwh",
        f"CASE WHEN {_GAS} THEN 7D * value END AS fuel_mmbtu",
        f"CASE WHEN {_GAS} THEN 6900D + 10D * (event_id % 90) END AS heat_rate_btu_kwh",
        f"CASE WHEN {_GAS} THEN 0.37D * value END AS co2_tonnes",
        "event_id AS _load_id",
    )


def weather_frame(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"{_HOUR} AS timestamp",
        f"{_ASSET_ID} AS asset_id",
        "CASE WHEN event_id % 53 <> 0 THEN 0.06D * value + 0.01D * (event_id % 700) END "
        "AS wind_speed_mps",
        "CAST(event_id % 360 AS DOUBLE) AS wind_direction_deg",
        "CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN 2D * value + event_id % 200 ELSE 0D END AS ghi",
        "-5D + event_id % 40 AS temperature_c",
        "980D + event_id % 60 AS pressure_hpa",
        "20D + event_id % 75 AS relative_humidity",
        "CAST(event_id % 101 AS DOUBLE) AS cloud_cover_pct",
        "event_id AS _load_id",
    )


def asset_frame(events: DataFrame) -> DataFrame:
    """One row per asset, in the columns of the asset dimension file."""
    return events.select("user_id").distinct().selectExpr(
        f"{_ASSET_ID} AS asset_id",
        "concat('Site ', user_id) AS asset_name",
        f"{_KIND} AS asset_type",
        f"{_CAPACITY} AS capacity_mw",
        "25D + user_id % 25 AS latitude",
        "-120D + user_id % 50 AS longitude",
        "CASE user_id % 4 WHEN 0 THEN 'ERCOT' WHEN 1 THEN 'MISO' WHEN 2 THEN 'WECC' "
        "ELSE 'CAISO' END AS region",
    )
