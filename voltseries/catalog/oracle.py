"""Reference SQL of the registered queries, for an independent SQL engine.

Written from the definitions of the operators. Shared steps are named CTEs; each
query gets the CTEs it needs, in order.
"""

from __future__ import annotations

import re


def r(expr: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text; NaN and infinities become NULL."""
    return f"CAST(ROUND(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def cf(generation: str, capacity: str, hours: str = "1.0e0") -> str:
    return r(f"({generation}) / NULLIF(({capacity}) * {hours}, 0)", 4)


def clamp(expr: str, low: str | None = "0", high: str | None = None) -> str:
    inner = f"GREATEST({expr}, {low})" if low is not None else expr
    if high is not None:
        inner = f"LEAST({inner}, {high})"
    return f"CASE WHEN ({expr}) IS NOT NULL THEN {inner} END"


def n(condition: str) -> str:
    return f"COUNT(CASE WHEN {condition} THEN 1 END)"


_ID = (
    "'ASSET_' || lpad(CAST(user_id AS VARCHAR), "
    "CAST(GREATEST(4, LENGTH(CAST(user_id AS VARCHAR))) AS INTEGER), '0')"
)
_KIND = (
    "CASE user_id % 4 WHEN 0 THEN 'wind' WHEN 1 THEN 'solar' WHEN 2 THEN 'battery' "
    "ELSE 'gas' END"
)
_CAP = "(40.0e0 + 20.0e0 * (user_id % 5))"
_MWH = f"LEAST(value, {_CAP})"
_SIZE = "CASE WHEN {c} >= 75 THEN 'Large' WHEN {c} >= 50 THEN 'Medium' ELSE 'Small' END"
_RATING = (
    "CASE WHEN {c} > 0.9 THEN 'Excellent' WHEN {c} > 0.6 THEN 'Good' "
    "WHEN {c} > 0.3 THEN 'Fair' WHEN {c} > 0.05 THEN 'Poor' ELSE 'Very Poor' END"
)
_DAY_RATING = "CASE WHEN {c} >= 0.6 THEN 'High' WHEN {c} >= 0.3 THEN 'Medium' ELSE 'Low' END"
_SCORE = (
    "CASE WHEN {c} >= 95 THEN 'Excellent' WHEN {c} >= 85 THEN 'Good' "
    "WHEN {c} >= 70 THEN 'Fair' ELSE 'Poor' END"
)
_PARTS = """
  CAST(EXTRACT(HOUR FROM timestamp) AS INTEGER) AS hour_of_day,
  CAST(EXTRACT(DAY FROM timestamp) AS INTEGER) AS day_of_month,
  CAST(DAYOFWEEK(timestamp) AS INTEGER) AS day_of_week,
  CAST(EXTRACT(MONTH FROM timestamp) AS INTEGER) AS month,
  CAST(EXTRACT(QUARTER FROM timestamp) AS INTEGER) AS quarter,
  CAST(EXTRACT(YEAR FROM timestamp) AS INTEGER) AS year,
  CAST(timestamp AS DATE) AS date"""

CTES: dict[str, str] = {}

CTES["raw_generation"] = f"""
SELECT date_trunc('hour', ts) AS timestamp, {_ID} AS asset_id, {_KIND} AS asset_type,
  CASE WHEN user_id % 4 = 2 AND event_id % 2 = 0 THEN 0.0e0 ELSE {_MWH} END
    AS gross_generation_mwh,
  CASE WHEN user_id % 4 = 2 AND event_id % 2 = 0 THEN -{_MWH}
       WHEN event_id % 61 = 0 THEN NULL
       ELSE {_MWH} * (1.0e0 - 0.02e0 * (event_id % 5)) END AS net_generation_mwh,
  0.05e0 * (event_id % 3) AS curtailment_mwh,
  80.0e0 + event_id % 21 AS availability_pct,
  {_CAP} AS asset_capacity_mw,
  CASE WHEN user_id % 4 = 2 THEN 10.0e0 + event_id % 86 END AS soc_pct,
  CASE WHEN user_id % 4 = 2 THEN CASE WHEN event_id % 2 = 0 THEN {_MWH} ELSE 0.0e0 END END
    AS charge_mwh,
  CASE WHEN user_id % 4 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 0.0e0 ELSE {_MWH} END END
    AS discharge_mwh,
  CASE WHEN user_id % 4 = 3 THEN 7.0e0 * value END AS fuel_mmbtu,
  CASE WHEN user_id % 4 = 3 THEN 6900.0e0 + 10.0e0 * (event_id % 90) END AS heat_rate_btu_kwh,
  CASE WHEN user_id % 4 = 3 THEN 0.37e0 * value END AS co2_tonnes,
  event_id AS _load_id
FROM events"""

CTES["raw_weather"] = f"""
SELECT date_trunc('hour', ts) AS timestamp, {_ID} AS asset_id,
  CASE WHEN event_id % 53 <> 0 THEN 0.06e0 * value + 0.01e0 * (event_id % 700) END
    AS wind_speed_mps,
  CAST(event_id % 360 AS DOUBLE) AS wind_direction_deg,
  CASE WHEN EXTRACT(HOUR FROM ts) BETWEEN 6 AND 18 THEN 2.0e0 * value + event_id % 200
       ELSE 0.0e0 END AS ghi,
  -5.0e0 + event_id % 40 AS temperature_c,
  980.0e0 + event_id % 60 AS pressure_hpa,
  20.0e0 + event_id % 75 AS relative_humidity,
  CAST(event_id % 101 AS DOUBLE) AS cloud_cover_pct,
  event_id AS _load_id
FROM events"""

CTES["assets"] = f"""
SELECT {_ID} AS asset_id, 'Site ' || CAST(user_id AS VARCHAR) AS asset_name,
  {_KIND} AS asset_type, {_CAP} AS capacity_mw,
  25.0e0 + user_id % 25 AS latitude, -120.0e0 + user_id % 50 AS longitude,
  CASE user_id % 4 WHEN 0 THEN 'ERCOT' WHEN 1 THEN 'MISO' WHEN 2 THEN 'WECC'
    ELSE 'CAISO' END AS region
FROM (SELECT DISTINCT user_id FROM events)"""

CTES["generation"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY asset_id, timestamp ORDER BY _load_id DESC) AS rn
  FROM raw_generation) WHERE rn = 1"""

CTES["weather"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY asset_id, timestamp ORDER BY _load_id DESC) AS rn
  FROM raw_weather) WHERE rn = 1"""

CTES["stg_weather"] = f"""
SELECT w.timestamp, w.asset_id,
  {r('w.wind_speed_mps', 2)} AS wind_speed_mps,
  {r('w.wind_direction_deg', 1)} AS wind_direction_deg,
  {r('w.ghi', 2)} AS ghi, {r('w.temperature_c', 2)} AS temperature_c,
  {r('w.pressure_hpa', 1)} AS pressure_hpa,
  {r('w.relative_humidity', 1)} AS relative_humidity, {_PARTS},
  CASE WHEN w.wind_speed_mps < 3 THEN 'Calm' WHEN w.wind_speed_mps < 12 THEN 'Moderate'
       WHEN w.wind_speed_mps < 25 THEN 'Strong' ELSE 'Very Strong' END AS wind_speed_category,
  CASE WHEN w.ghi < 100 THEN 'Night/Cloudy' WHEN w.ghi < 400 THEN 'Low Irradiance'
       WHEN w.ghi < 700 THEN 'Moderate Irradiance' ELSE 'High Irradiance' END
    AS irradiance_category,
  CASE WHEN w.temperature_c < 0 THEN 'Below Freezing' WHEN w.temperature_c < 15 THEN 'Cold'
       WHEN w.temperature_c < 25 THEN 'Moderate' ELSE 'Warm' END AS temperature_category,
  (w.wind_speed_mps IS NOT NULL AND w.wind_direction_deg IS NOT NULL AND w.ghi IS NOT NULL
   AND w.temperature_c IS NOT NULL) AS is_data_complete
FROM weather w"""

_HOUR_CF = cf("g.net_generation_mwh", "g.asset_capacity_mw")
CTES["stg_generation"] = f"""
SELECT g.timestamp, g.asset_id, g.asset_type,
  {r('g.gross_generation_mwh', 4)} AS gross_generation_mwh,
  {r('g.net_generation_mwh', 4)} AS net_generation_mwh,
  {r('g.curtailment_mwh', 4)} AS curtailment_mwh,
  {r('g.availability_pct', 2)} AS availability_pct,
  {r('g.asset_capacity_mw', 2)} AS asset_capacity_mw,
  {r('g.soc_pct', 2)} AS soc_pct, {r('g.charge_mwh', 4)} AS charge_mwh,
  {r('g.discharge_mwh', 4)} AS discharge_mwh, {r('g.fuel_mmbtu', 4)} AS fuel_mmbtu,
  {r('g.heat_rate_btu_kwh', 2)} AS heat_rate_btu_kwh, {r('g.co2_tonnes', 4)} AS co2_tonnes,
  {_PARTS},
  {_HOUR_CF} AS capacity_factor,
  {r('(g.gross_generation_mwh - g.net_generation_mwh) / NULLIF(g.gross_generation_mwh, 0) * 100', 2)}
    AS loss_percentage,
  {r('g.curtailment_mwh / NULLIF(g.gross_generation_mwh, 0) * 100', 2)}
    AS curtailment_percentage,
  {r('g.net_generation_mwh / NULLIF(g.asset_capacity_mw, 0)', 4)} AS hours_at_capacity,
  {_SIZE.format(c='g.asset_capacity_mw')} AS asset_size_category,
  {_RATING.format(c=_HOUR_CF)} AS performance_category,
  COALESCE(g.availability_pct >= 85.0, FALSE) AS meets_availability_target,
  NOT (g.gross_generation_mwh IS NULL OR g.net_generation_mwh IS NULL
       OR g.asset_capacity_mw IS NULL
       OR COALESCE(g.net_generation_mwh > g.gross_generation_mwh, FALSE)
       OR COALESCE(g.net_generation_mwh > g.asset_capacity_mw * 1.1e0, FALSE)) AS is_data_valid,
  COALESCE(g.net_generation_mwh = 0 AND g.availability_pct > 0
           AND g.asset_type IN ('wind', 'solar'), FALSE) AS is_zero_generation_anomaly
FROM generation g"""

CTES["generation_daily"] = f"""
SELECT asset_id, date, MAX(asset_type) AS asset_type,
  MAX(asset_capacity_mw) AS asset_capacity_mw, MAX(asset_size_category) AS asset_size_category,
  {r('SUM(gross_generation_mwh)', 4)} AS total_gross_generation_mwh,
  {r('SUM(net_generation_mwh)', 4)} AS total_net_generation_mwh,
  {r('SUM(curtailment_mwh)', 4)} AS total_curtailment_mwh,
  {r('AVG(soc_pct)', 2)} AS avg_soc_pct, {r('SUM(charge_mwh)', 4)} AS total_charge_mwh,
  {r('SUM(discharge_mwh)', 4)} AS total_discharge_mwh,
  {r('SUM(fuel_mmbtu)', 4)} AS total_fuel_mmbtu,
  {r('AVG(heat_rate_btu_kwh)', 2)} AS avg_heat_rate_btu_kwh,
  {r('SUM(co2_tonnes)', 4)} AS total_co2_tonnes,
  {r('AVG(gross_generation_mwh)', 4)} AS avg_hourly_gross_mwh,
  {r('AVG(net_generation_mwh)', 4)} AS avg_hourly_net_mwh,
  {r('MAX(net_generation_mwh)', 4)} AS peak_hourly_net_mwh,
  {cf('SUM(net_generation_mwh)', 'MAX(asset_capacity_mw)', '24.0e0')} AS daily_capacity_factor,
  {r('AVG(capacity_factor)', 4)} AS avg_hourly_capacity_factor,
  {r('AVG(availability_pct)', 2)} AS avg_availability_pct,
  {r('MIN(availability_pct)', 2)} AS min_availability_pct,
  {r('(SUM(gross_generation_mwh) - SUM(net_generation_mwh)) / NULLIF(SUM(gross_generation_mwh), 0) * 100', 2)}
    AS daily_loss_percentage,
  {r('SUM(curtailment_mwh) / NULLIF(SUM(gross_generation_mwh), 0) * 100', 2)}
    AS daily_curtailment_percentage,
  COUNT(*) AS total_hours, {n('net_generation_mwh > 0')} AS generating_hours,
  {n('capacity_factor > 0.5')} AS high_output_hours,
  {n("performance_category = 'Excellent'")} AS excellent_hours,
  {n("performance_category = 'Good'")} AS good_hours,
  {n("performance_category = 'Fair'")} AS fair_hours,
  {n("performance_category = 'Poor'")} AS poor_hours,
  {n('is_data_valid')} AS valid_observation_count,
  {n('is_zero_generation_anomaly')} AS zero_generation_anomaly_count,
  {n('meets_availability_target')} AS hours_meeting_availability_target,
  {r(n('is_data_valid') + '::DOUBLE / COUNT(*)::DOUBLE * 100', 2)} AS data_validity_pct,
  MIN(timestamp) AS first_generation_timestamp, MAX(timestamp) AS last_generation_timestamp
FROM stg_generation GROUP BY asset_id, date"""

CTES["weather_daily"] = f"""
SELECT asset_id, date,
  {r('AVG(wind_speed_mps)', 2)} AS avg_wind_speed_mps,
  {r('MAX(wind_speed_mps)', 2)} AS max_wind_speed_mps,
  {r('MIN(wind_speed_mps)', 2)} AS min_wind_speed_mps,
  {r('STDDEV(wind_speed_mps)', 2)} AS std_wind_speed_mps,
  {r('AVG(ghi)', 2)} AS avg_ghi, {r('MAX(ghi)', 2)} AS max_ghi, {r('SUM(ghi)', 2)} AS total_ghi,
  {r('AVG(temperature_c)', 2)} AS avg_temperature_c,
  {r('MAX(temperature_c)', 2)} AS max_temperature_c,
  {r('MIN(temperature_c)', 2)} AS min_temperature_c,
  {r('AVG(pressure_hpa)', 1)} AS avg_pressure_hpa,
  {r('AVG(relative_humidity)', 1)} AS avg_relative_humidity,
  COUNT(*) AS observation_count, {n('is_data_complete')} AS complete_observation_count,
  {r(n('is_data_complete') + '::DOUBLE / COUNT(*)::DOUBLE * 100', 2)} AS data_completeness_pct,
  {r('AVG(CASE WHEN hour_of_day BETWEEN 10 AND 16 THEN ghi END)', 2)} AS avg_peak_ghi,
  {n("wind_speed_category = 'Strong'")} AS strong_wind_hours,
  {n("wind_speed_category = 'Very Strong'")} AS very_strong_wind_hours,
  {n('ghi > 0')} AS daylight_hours,
  MIN(timestamp) AS first_observation_timestamp, MAX(timestamp) AS last_observation_timestamp
FROM stg_weather GROUP BY asset_id, date"""

CTES["joined"] = """
SELECT g.timestamp, g.asset_id, g.asset_type, g.gross_generation_mwh, g.net_generation_mwh,
  g.curtailment_mwh, g.availability_pct, g.asset_capacity_mw, g.capacity_factor,
  g.charge_mwh, g.discharge_mwh, g.heat_rate_btu_kwh, w.wind_speed_mps, w.ghi,
  w.temperature_c, w.pressure_hpa, g.is_data_valid AS generation_data_valid,
  w.is_data_complete AS weather_data_complete,
  (g.is_data_valid AND w.is_data_complete) AS is_complete_record,
  g.hour_of_day, g.day_of_week, g.date
FROM stg_generation g JOIN stg_weather w
  ON g.asset_id = w.asset_id AND g.timestamp = w.timestamp"""

CTES["dim_asset"] = f"""
SELECT asset_id, asset_name, asset_type, capacity_mw AS asset_capacity_mw,
  {_SIZE.format(c='capacity_mw')} AS asset_size_category, latitude, longitude, region
FROM assets"""

CTES["daily_mart"] = f"""
SELECT g.asset_id, g.date, g.asset_type, g.asset_capacity_mw, g.asset_size_category,
  g.total_gross_generation_mwh, g.total_net_generation_mwh, g.total_curtailment_mwh,
  g.avg_hourly_net_mwh, g.peak_hourly_net_mwh, g.avg_soc_pct, g.total_charge_mwh,
  g.total_discharge_mwh, g.total_fuel_mmbtu, g.avg_heat_rate_btu_kwh, g.total_co2_tonnes,
  g.daily_capacity_factor, g.avg_hourly_capacity_factor, g.avg_availability_pct,
  g.min_availability_pct, g.daily_loss_percentage, g.daily_curtailment_percentage,
  g.total_hours, g.generating_hours, g.high_output_hours,
  {r('g.generating_hours::DOUBLE / g.total_hours::DOUBLE * 100', 2)} AS generating_hours_pct,
  g.excellent_hours, g.good_hours, g.fair_hours, g.poor_hours,
  w.avg_wind_speed_mps, w.max_wind_speed_mps, w.avg_ghi, w.max_ghi, w.total_ghi,
  w.avg_temperature_c, w.strong_wind_hours, w.daylight_hours,
  g.data_validity_pct, w.data_completeness_pct, g.zero_generation_anomaly_count,
  {_DAY_RATING.format(c='g.daily_capacity_factor')} AS daily_performance_rating,
  COALESCE(g.avg_availability_pct >= 85.0, FALSE) AS meets_availability_target,
  COALESCE(g.data_validity_pct >= 95 AND w.data_completeness_pct >= 95, FALSE)
    AS has_high_quality_data,
  g.first_generation_timestamp, g.last_generation_timestamp
FROM generation_daily g LEFT JOIN weather_daily w
  ON g.asset_id = w.asset_id AND g.date = w.date"""

CTES["hours"] = "SELECT * FROM joined WHERE is_complete_record"

CTES["models"] = f"""
SELECT asset_id, MAX(asset_type) AS asset_type, MAX(asset_capacity_mw) AS asset_capacity_mw,
  COUNT(*) AS total_observations,
  {r('AVG(net_generation_mwh)', 4)} AS avg_net_generation_mwh,
  {r('AVG(capacity_factor)', 4)} AS avg_capacity_factor,
  {r('AVG(wind_speed_mps)', 2)} AS avg_wind_speed_mps, {r('AVG(ghi)', 2)} AS avg_ghi,
  {r('CORR(wind_speed_mps, net_generation_mwh)', 4)} AS wind_generation_correlation,
  {r('CORR(ghi, net_generation_mwh)', 4)} AS solar_generation_correlation,
  {r('CORR(wind_speed_mps, capacity_factor)', 4)} AS wind_cf_correlation,
  {r('CORR(ghi, capacity_factor)', 4)} AS solar_cf_correlation,
  {r('REGR_SLOPE(net_generation_mwh, wind_speed_mps)', 6)} AS wind_regression_slope,
  {r('REGR_INTERCEPT(net_generation_mwh, wind_speed_mps)', 6)} AS wind_regression_intercept,
  {r('REGR_SLOPE(net_generation_mwh, ghi)', 6)} AS solar_regression_slope,
  {r('REGR_INTERCEPT(net_generation_mwh, ghi)', 6)} AS solar_regression_intercept,
  {r('POWER(CORR(wind_speed_mps, net_generation_mwh), 2)', 4)} AS wind_r_squared,
  {r('POWER(CORR(ghi, net_generation_mwh), 2)', 4)} AS solar_r_squared
FROM hours GROUP BY asset_id"""


def _line(intercept: str, slope: str, x: str) -> str:
    return r(clamp(f"c.{intercept} + c.{slope} * h.{x}"), 4)


CTES["expected"] = f"""
SELECT *, {r('net_generation_mwh / NULLIF(expected_generation_mwh, 0) * 100', 2)}
    AS performance_ratio_pct
FROM (
  SELECT *, CASE WHEN ABS(wind_r) > ABS(sun_r) THEN from_wind ELSE from_sun END
      AS expected_generation_mwh
  FROM (
    SELECT h.*, c.wind_generation_correlation AS wind_r, c.solar_generation_correlation AS sun_r,
      {_line('wind_regression_intercept', 'wind_regression_slope', 'wind_speed_mps')} AS from_wind,
      {_line('solar_regression_intercept', 'solar_regression_slope', 'ghi')} AS from_sun
    FROM hours h JOIN models c ON h.asset_id = c.asset_id))"""

CTES["hour_days"] = f"""
SELECT asset_id, date, COUNT(*) AS hourly_observations,
  {r('AVG(net_generation_mwh)', 4)} AS daily_avg_net_generation_mwh,
  {r('SUM(net_generation_mwh)', 4)} AS daily_total_net_generation_mwh,
  {r('AVG(capacity_factor)', 4)} AS daily_avg_capacity_factor,
  {r('AVG(expected_generation_mwh)', 4)} AS avg_expected_generation_mwh,
  {r('AVG(performance_ratio_pct)', 2)} AS avg_performance_ratio_pct,
  SUM(charge_mwh) AS charged, SUM(discharge_mwh) AS discharged,
  MIN(heat_rate_btu_kwh) AS best_rate, AVG(heat_rate_btu_kwh) AS mean_rate
FROM expected GROUP BY asset_id, date"""

_BATTERY_SCORE = clamp("discharged / NULLIF(charged, 0) * 100", "0", "100")
_GAS_SCORE = clamp("best_rate / NULLIF(mean_rate, 0) * 100", "0", "100")
_OTHER_SCORE = clamp("avg_performance_ratio_pct", "0", "100")
_DAY_SCORE = r(
    f"CASE asset_type WHEN 'battery' THEN COALESCE({_BATTERY_SCORE}, 100) "
    f"WHEN 'gas' THEN COALESCE({_GAS_SCORE}, 100) ELSE COALESCE({_OTHER_SCORE}, 0) END",
    2,
)


def _trailing(column: str, rows: int) -> str:
    return r(
        f"AVG({column}) OVER (PARTITION BY asset_id ORDER BY date "
        f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)",
        4,
    )


CTES["scored_days"] = f"""
SELECT d.*, {_DAY_SCORE} AS performance_score
FROM (SELECT d.*, m.asset_type FROM hour_days d JOIN models m ON d.asset_id = m.asset_id) d"""

CTES["weather_mart"] = f"""
SELECT m.asset_id, s.date, m.asset_capacity_mw,
  m.wind_generation_correlation, m.solar_generation_correlation,
  m.wind_cf_correlation, m.solar_cf_correlation, m.wind_r_squared, m.solar_r_squared,
  m.wind_regression_slope, m.wind_regression_intercept,
  m.solar_regression_slope, m.solar_regression_intercept,
  s.avg_expected_generation_mwh,
  s.daily_avg_net_generation_mwh AS avg_actual_generation_mwh,
  s.avg_performance_ratio_pct, s.performance_score,
  {_SCORE.format(c='s.performance_score')} AS performance_category,
  s.rolling_7d_avg_generation, s.rolling_7d_avg_cf,
  s.rolling_30d_avg_generation, s.rolling_30d_avg_cf,
  m.asset_type AS inferred_asset_type, m.total_observations AS total_hourly_observations
FROM models m JOIN (
  SELECT *, {_trailing('daily_avg_net_generation_mwh', 7)} AS rolling_7d_avg_generation,
    {_trailing('daily_avg_capacity_factor', 7)} AS rolling_7d_avg_cf,
    {_trailing('daily_avg_net_generation_mwh', 30)} AS rolling_30d_avg_generation,
    {_trailing('daily_avg_capacity_factor', 30)} AS rolling_30d_avg_cf
  FROM scored_days) s ON m.asset_id = s.asset_id"""

CTES["assets_export"] = """
SELECT asset_id, asset_name AS name, asset_type, asset_capacity_mw AS capacity_mw,
  asset_size_category AS size_category, latitude, longitude, region,
  asset_name || ' (' || CAST(CAST(TRUNC(asset_capacity_mw) AS BIGINT) AS VARCHAR) || ' MW '
    || asset_type || ')' AS display_name
FROM dim_asset"""

_DAILY_OUT = (
    "asset_id, date, asset_type, total_net_generation_mwh, daily_capacity_factor, "
    "avg_availability_pct, total_curtailment_mwh, daily_performance_rating, excellent_hours, "
    "good_hours, fair_hours, poor_hours, avg_wind_speed_mps, avg_ghi, avg_temperature_c, "
    "data_completeness_pct, avg_soc_pct, total_charge_mwh, total_discharge_mwh, "
    "total_fuel_mmbtu, avg_heat_rate_btu_kwh, total_co2_tonnes"
)
CTES["daily_export"] = f"SELECT {_DAILY_OUT} FROM daily_mart"

# Second flavour: nothing rounded on the way.
CTES["local_daily_raw"] = f"""
SELECT d.*, w.avg_wind_speed_mps, w.avg_ghi, w.avg_temperature_c,
  d.total_net_generation_mwh / NULLIF(d.asset_capacity_mw * d.observed_hours, 0)
    AS daily_capacity_factor
FROM (
  SELECT asset_id, CAST(timestamp AS DATE) AS date, MAX(asset_type) AS asset_type,
    MAX(asset_capacity_mw) AS asset_capacity_mw,
    COALESCE(SUM(gross_generation_mwh), 0) AS total_gross_generation_mwh,
    COALESCE(SUM(net_generation_mwh), 0) AS total_net_generation_mwh,
    COALESCE(SUM(curtailment_mwh), 0) AS total_curtailment_mwh,
    AVG(availability_pct) AS avg_availability_pct, COUNT(*) AS observed_hours,
    {n("rating = 'Excellent'")} AS excellent_hours, {n("rating = 'Good'")} AS good_hours,
    {n("rating = 'Fair'")} AS fair_hours, {n("rating = 'Poor'")} AS poor_hours,
    AVG(soc_pct) AS avg_soc_pct, COALESCE(SUM(charge_mwh), 0) AS total_charge_mwh,
    COALESCE(SUM(discharge_mwh), 0) AS total_discharge_mwh,
    COALESCE(SUM(fuel_mmbtu), 0) AS total_fuel_mmbtu,
    AVG(heat_rate_btu_kwh) AS avg_heat_rate_btu_kwh,
    COALESCE(SUM(co2_tonnes), 0) AS total_co2_tonnes
  FROM (SELECT *, {_RATING.format(c='(net_generation_mwh / NULLIF(asset_capacity_mw, 0))')}
          AS rating FROM generation)
  GROUP BY 1, 2) d
LEFT JOIN (
  SELECT asset_id, CAST(timestamp AS DATE) AS date, AVG(wind_speed_mps) AS avg_wind_speed_mps,
    AVG(ghi) AS avg_ghi, AVG(temperature_c) AS avg_temperature_c
  FROM weather GROUP BY 1, 2) w ON d.asset_id = w.asset_id AND d.date = w.date"""

CTES["local_hours"] = """
SELECT g.*, a.asset_type AS technology, a.capacity_mw, CAST(g.timestamp AS DATE) AS date,
  CASE a.asset_type WHEN 'wind' THEN COALESCE(w.wind_speed_mps, 0)
    WHEN 'solar' THEN COALESCE(w.ghi, 0) END AS driver
FROM generation g
LEFT JOIN weather w ON g.asset_id = w.asset_id AND g.timestamp = w.timestamp
JOIN assets a ON g.asset_id = a.asset_id"""

CTES["local_fits"] = """
SELECT asset_id, CASE WHEN flat THEN 0 ELSE slope END AS slope,
  COALESCE(CASE WHEN flat THEN mean_y ELSE intercept END, 0) AS intercept,
  CASE WHEN flat OR NOT isfinite(r2) THEN 0 ELSE COALESCE(r2, 0) END AS r2
FROM (
  SELECT asset_id, AVG(y) AS mean_y, REGR_SLOPE(y, x) AS slope, REGR_INTERCEPT(y, x) AS intercept,
    POWER(CORR(y, x), 2) AS r2,
    COUNT(x) < 2
      OR (MAX(x) - ARG_MIN(x, timestamp) <= 1e-8 + 1e-5 * ABS(ARG_MIN(x, timestamp))
          AND ARG_MIN(x, timestamp) - MIN(x) <= 1e-8 + 1e-5 * ABS(ARG_MIN(x, timestamp))) AS flat
  FROM (SELECT asset_id, timestamp, driver AS x, net_generation_mwh AS y FROM local_hours
        WHERE technology IN ('wind', 'solar') AND net_generation_mwh IS NOT NULL)
  GROUP BY asset_id)"""

_OPERATIONAL = (
    "CASE WHEN technology = 'battery' AND COALESCE(discharge_mwh, 0) > 1e-6 "
    "THEN 0.88e0 * 100 "
    "WHEN technology = 'gas' AND net_generation_mwh > 1e-6 THEN "
    + clamp(
        "6900.0e0 / NULLIF(COALESCE(heat_rate_btu_kwh, 6900.0e0), 0) * 100", "0", "100"
    )
    + " END"
)

CTES["local_scored"] = f"""
SELECT *, CASE WHEN technology IN ('wind', 'solar')
    THEN CASE WHEN expected > 0.02e0 * capacity_mw
              THEN net_generation_mwh * 100.0e0 / NULLIF(expected, 0) END
    ELSE {_OPERATIONAL} END AS ratio
FROM (
  SELECT h.*, f.r2, CASE WHEN h.technology IN ('wind', 'solar')
      THEN {clamp('f.slope * h.driver + f.intercept')} ELSE h.net_generation_mwh END AS expected
  FROM local_hours h LEFT JOIN local_fits f ON h.asset_id = f.asset_id)"""

_RHO = "(pressure_hpa * 100.0e0) / (287.05e0 * (temperature_c + 273.15e0))"
_SPEED = clamp("wind_speed_mps")
_EFF = clamp(
    "ghi * (1.0e0 - 0.8e0 * LEAST(GREATEST(cloud_cover_pct / 100.0e0, 0), 1) * 0.5e0)"
)
CTES["potential"] = f"""
SELECT asset_id, timestamp, asset_type, capacity_mw,
  CASE WHEN asset_type = 'wind' THEN
    capacity_mw * (CASE WHEN speed IS NULL THEN NULL
      WHEN speed >= 3 AND speed < 12
        THEN (POWER(speed, 3) - POWER(3.0e0, 3)) / (POWER(12.0e0, 3) - POWER(3.0e0, 3))
      WHEN speed >= 12 AND speed <= 25 THEN 1.0e0 ELSE 0.0e0 END)
    * (rho / 1.225e0) * ((1.0e0 - 0.10e0) * 0.95e0)
  ELSE GREATEST(LEAST(
    capacity_mw * 1.2e0 * (eff / 1000.0e0)
      * (1.0e0 + (-0.004e0) * (temperature_c + ((45.0e0 - 20.0e0) / 800.0e0) * eff - 25.0e0))
      * 0.86e0, capacity_mw), 0) END AS potential_mwh
FROM (
  SELECT w.*, a.asset_type, a.capacity_mw, {_SPEED} AS speed, {_EFF} AS eff, {_RHO} AS rho
  FROM weather w JOIN assets a ON w.asset_id = a.asset_id
  WHERE a.asset_type IN ('wind', 'solar'))"""

_DEMAND = (
    "scale_mw * (0.72e0 + 0.20e0 * SIN(2 * PI() * (EXTRACT(HOUR FROM timestamp) - 17) / 24.0e0))"
    " * (1.0e0 + 0.12e0 * COS(4 * PI() * (EXTRACT(DOY FROM timestamp) - 15) / 365.0e0))"
)
CTES["balance"] = f"""
SELECT timestamp, renewable_mw, {_DEMAND} AS demand_mw, {_DEMAND} - renewable_mw AS net_load_mw
FROM (
  SELECT t.timestamp, COALESCE(p.mw, 0) AS renewable_mw,
    (SELECT COALESCE(NULLIF(SUM(CASE WHEN asset_type IN ('wind', 'solar', 'gas')
        THEN capacity_mw END), 0), 1.0e0) * 0.55e0 FROM assets) AS scale_mw
  FROM (SELECT DISTINCT timestamp FROM weather) t
  LEFT JOIN (SELECT timestamp, SUM(potential_mwh) AS mw FROM potential GROUP BY timestamp) p
    ON t.timestamp = p.timestamp)"""

CTES["mix"] = """
SELECT * FROM (
  SELECT d.date, s.series, s.asset_type,
    COALESCE(SUM(CASE WHEN x.asset_type = 'battery' THEN COALESCE(x.total_discharge_mwh, 0)
      ELSE GREATEST(0, COALESCE(x.total_net_generation_mwh, 0)) END), 0) AS value
  FROM (SELECT DISTINCT date FROM daily_export) d
  CROSS JOIN (VALUES (0, 'wind'), (1, 'solar'), (2, 'gas'), (3, 'battery'))
    AS s(series, asset_type)
  LEFT JOIN daily_export x ON x.date = d.date AND x.asset_type = s.asset_type
  GROUP BY 1, 2, 3)
QUALIFY MAX(value) OVER (PARTITION BY asset_type) > 0"""

CTES["kpi_totals"] = """
SELECT COALESCE(SUM(total_net_generation_mwh), 0) AS net,
  COALESCE(AVG(CASE WHEN asset_type IN ('wind', 'solar', 'gas')
    THEN COALESCE(daily_capacity_factor, 0) END), 0) AS cf,
  CASE WHEN SUM(CASE WHEN asset_type IN ('wind', 'solar', 'gas')
      THEN total_net_generation_mwh END) > 0
    THEN SUM(CASE WHEN asset_type IN ('wind', 'solar') THEN total_net_generation_mwh END)
      / SUM(CASE WHEN asset_type IN ('wind', 'solar', 'gas') THEN total_net_generation_mwh END)
      * 100.0e0 ELSE 0 END AS share,
  COALESCE(SUM(total_co2_tonnes), 0) AS co2,
  COALESCE(SUM(CASE WHEN asset_type = 'battery' THEN total_discharge_mwh END), 0) AS batt,
  COALESCE(SUM(total_curtailment_mwh), 0) AS curt
FROM daily_export"""

_ORDER = list(CTES)


def _needs(sql: str) -> set[str]:
    """The CTEs a text names, and those they name."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in _ORDER:
            if name not in found and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                found.add(name)
                todo.append(CTES[name])
    return found


def _full(sql: str) -> str:
    used = _needs(sql)
    body = ",\n".join(f"{name} AS ({CTES[name]})" for name in _ORDER if name in used)
    return f"WITH {body}\n{sql}"


def _r6(*columns: str) -> str:
    return ", ".join(f"{r(c, 6)} AS {c}" for c in columns)


_GEN_DOUBLES = (
    "gross_generation_mwh", "net_generation_mwh", "curtailment_mwh", "availability_pct",
    "asset_capacity_mw", "soc_pct", "charge_mwh", "discharge_mwh", "fuel_mmbtu",
    "heat_rate_btu_kwh", "co2_tonnes",
)
_WX_DOUBLES = (
    "wind_speed_mps", "wind_direction_deg", "ghi", "temperature_c", "pressure_hpa",
    "relative_humidity", "cloud_cover_pct",
)

SQL: dict[str, str] = {}

SQL["stg_weather"] = "SELECT * FROM stg_weather"
SQL["stg_generation"] = "SELECT * FROM stg_generation"
SQL["dedup_latest_load"] = (
    f"SELECT timestamp, asset_id, asset_type, {_r6(*_GEN_DOUBLES)}, _load_id FROM generation"
)
SQL["time_features"] = """
SELECT asset_id, timestamp, CAST(EXTRACT(HOUR FROM timestamp) AS INTEGER) AS hour,
  CAST(EXTRACT(DAY FROM timestamp) AS INTEGER) AS day,
  CAST(ISODOW(timestamp) AS INTEGER) AS day_of_week,
  CAST(EXTRACT(MONTH FROM timestamp) AS INTEGER) AS month,
  CAST(EXTRACT(QUARTER FROM timestamp) AS INTEGER) AS quarter,
  CAST(EXTRACT(YEAR FROM timestamp) AS INTEGER) AS year
FROM generation"""
SQL["categories"] = """
SELECT wind_speed_category, irradiance_category, temperature_category, COUNT(*) AS hours
FROM stg_weather GROUP BY 1, 2, 3"""
SQL["quality_flags"] = f"""
SELECT asset_type, asset_size_category, COUNT(*) AS hours,
  {n('is_data_valid')} AS valid_hours, {n('is_zero_generation_anomaly')} AS anomaly_hours,
  {n('meets_availability_target')} AS target_hours
FROM stg_generation GROUP BY 1, 2"""
SQL["capacity_factor_unrounded"] = f"""
SELECT asset_id, timestamp, {_r6('net_generation_mwh', 'asset_capacity_mw')},
  {r('net_generation_mwh / NULLIF(asset_capacity_mw * 2.0e0, 0)', 6)} AS capacity_factor
FROM generation"""
SQL["int_weather_daily"] = "SELECT * FROM weather_daily"
SQL["int_generation_daily"] = "SELECT * FROM generation_daily"
SQL["daily_frame_observed_hours"] = f"""
SELECT asset_id, date, asset_type, {_r6(
    'asset_capacity_mw', 'total_gross_generation_mwh', 'total_net_generation_mwh',
    'total_curtailment_mwh', 'avg_availability_pct')},
  observed_hours, excellent_hours, good_hours, fair_hours, poor_hours, {_r6(
    'avg_soc_pct', 'total_charge_mwh', 'total_discharge_mwh', 'total_fuel_mmbtu',
    'avg_heat_rate_btu_kwh', 'total_co2_tonnes', 'avg_wind_speed_mps', 'avg_ghi',
    'avg_temperature_c', 'daily_capacity_factor')},
  100.0e0 AS data_completeness_pct,
  {_DAY_RATING.format(c='daily_capacity_factor')} AS daily_performance_rating
FROM local_daily_raw"""
SQL["int_asset_weather_join"] = "SELECT * FROM joined"
SQL["dim_asset"] = "SELECT * FROM dim_asset"
SQL["dim_lookup_fallback"] = """
SELECT x.asset_id, x.date, x.asset_type,
  COALESCE(NULLIF(x.asset_type, ''), NULLIF(a.asset_type, ''), 'unknown') AS technology
FROM (SELECT asset_id, date, CASE WHEN EXTRACT(DAY FROM date) % 2 = 0 THEN asset_type ELSE '' END
        AS asset_type FROM daily_mart) x
LEFT JOIN assets_export a ON x.asset_id = a.asset_id"""
SQL["align_hour_axis"] = f"""
SELECT x.asset_id, x.timestamp,
  {r('COALESCE(g.gross_generation_mwh, 0)', 6)} AS gross_generation_mwh
FROM (SELECT a.asset_id, t.timestamp FROM assets a
      CROSS JOIN (SELECT DISTINCT timestamp FROM generation) t) x
LEFT JOIN generation g ON x.asset_id = g.asset_id AND x.timestamp = g.timestamp"""
SQL["select_by_technology"] = """
SELECT * FROM daily_export
WHERE asset_id IN (SELECT asset_id FROM assets_export WHERE asset_type = 'solar')
  AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""
SQL["mart_asset_performance_daily"] = "SELECT * FROM daily_mart"
SQL["mart_asset_weather_performance"] = "SELECT * FROM weather_mart"
SQL["combined_assets"] = f"""
SELECT timestamp, asset_id, {_r6('gross_generation_mwh')},
  ROW_NUMBER() OVER (ORDER BY timestamp, asset_id) - 1 AS position FROM generation"""
SQL["source_preference"] = """
SELECT source, asset_id, COUNT(*) AS hours
FROM weather, (VALUES ('modelled'), ('measured')) AS s(source) GROUP BY ALL"""
SQL["materialised_alike"] = """
SELECT kind, asset_type, COUNT(*) AS days
FROM generation_daily, (VALUES ('inline'), ('view'), ('table')) AS k(kind) GROUP BY ALL"""
SQL["stg_weather_distinct"] = "SELECT DISTINCT * FROM stg_weather"
SQL["sorted_series"] = f"""
SELECT date, {r('COALESCE(SUM(total_net_generation_mwh), 0)', 6)} AS value,
  ROW_NUMBER() OVER (ORDER BY date) - 1 AS position FROM daily_export GROUP BY date"""
SQL["expected_generation"] = """
SELECT asset_id, timestamp, from_wind AS expected_generation_from_wind,
  from_sun AS expected_generation_from_solar, expected_generation_mwh
FROM expected"""
SQL["performance_ratio"] = """
SELECT asset_id, date, hourly_observations, avg_expected_generation_mwh,
  daily_avg_net_generation_mwh AS avg_actual_generation_mwh, avg_performance_ratio_pct,
  daily_total_net_generation_mwh, daily_avg_capacity_factor
FROM hour_days"""
SQL["technology_score"] = (
    "SELECT asset_id, date, asset_type, performance_score FROM scored_days"
)
SQL["asset_correlations"] = "SELECT * FROM models"
SQL["asset_models_incremental"] = "SELECT * FROM models"
SQL["linfit_by_asset"] = f"SELECT asset_id, {_r6('slope', 'intercept', 'r2')} FROM local_fits"
SQL["static_correlation"] = (
    f"SELECT {r('CORR(wind_speed_mps, net_generation_mwh)', 6)} "
    "AS corr_wind_speed_mps_net_generation_mwh FROM joined"
)
_DAILY_CORR = r("CORR(total_net_generation_mwh, avg_temperature_c)", 6)
_CORR_NAME = "corr_total_net_generation_mwh_avg_temperature_c"
SQL["correlation_by_asset"] = (
    f"SELECT asset_id, {_DAILY_CORR} AS {_CORR_NAME} FROM daily_mart GROUP BY asset_id"
)


def _full_frame(aggregate: str, column: str, rows: int, partition: str, order: str) -> str:
    frame = (
        f"OVER ({partition} ORDER BY {order} "
        f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )
    return r(
        f"CASE WHEN COUNT({column}) {frame} = {rows} THEN {aggregate}({column}) {frame} END", 6
    )


def _daily_rolling(stats: tuple[str, ...], sizes: tuple[int, ...]) -> str:
    column = "total_net_generation_mwh"
    names = {"mean": "AVG", "std": "STDDEV_SAMP", "min": "MIN", "max": "MAX"}
    return ", ".join(
        _full_frame(names[s], column, k, "PARTITION BY asset_id", "date")
        + f" AS {column}_rolling_{s}_{k}"
        for k in sizes
        for s in stats
    )


def _lag(how: str, column: str, k: int, over: str) -> str:
    return f"{how}({column}, {k}) OVER ({over}) AS {column}_{how.lower()}_{k}"


_BY_DAY = "PARTITION BY asset_id ORDER BY date"
_NET = "total_net_generation_mwh"
SQL["correlation_enriched"] = f"""
SELECT asset_id, date, {_NET}, {_lag('LAG', _NET, 1, _BY_DAY)}, {_lag('LAG', _NET, 3, _BY_DAY)},
  {_lag('LAG', _NET, 7, _BY_DAY)}, {_daily_rolling(('mean', 'std'), (7, 30))}
FROM daily_mart"""
SQL["correlation_job_summary"] = f"""
SELECT COUNT(*) AS row_count, (SELECT COUNT(*) FROM daily_mart) AS enriched_row_count,
  {r('AVG(CASE WHEN isfinite(c) THEN c END)', 6)} AS mean_correlation
FROM (SELECT asset_id, CORR(total_net_generation_mwh, avg_temperature_c) AS c
      FROM daily_mart GROUP BY asset_id)"""
SQL["lag_features"] = f"""
SELECT asset_id, date, {_NET}, {_lag('LAG', _NET, 1, _BY_DAY)}, {_lag('LAG', _NET, 3, _BY_DAY)},
  {_lag('LAG', _NET, 7, _BY_DAY)} FROM generation_daily"""
SQL["lead_features"] = f"""
SELECT asset_id, date, {_NET}, {_lag('LEAD', _NET, 1, _BY_DAY)},
  {_lag('LEAD', _NET, 2, _BY_DAY)} FROM generation_daily"""
SQL["rolling_stats"] = f"""
SELECT asset_id, date, {_NET}, {_daily_rolling(('mean', 'std', 'min', 'max'), (3, 7))}
FROM generation_daily"""
_F7 = "OVER (PARTITION BY asset_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_BOTH = f"CASE WHEN {_NET} IS NOT NULL AND avg_temperature_c IS NOT NULL THEN 1 END"
SQL["rolling_correlation"] = f"""
SELECT asset_id, date, {_NET}, avg_temperature_c,
  {r(f"CASE WHEN COUNT({_BOTH}) {_F7} = 7 THEN CORR({_NET}, avg_temperature_c) {_F7} END", 6)}
    AS {_CORR_NAME}_rolling_7
FROM daily_mart"""
_GROSS = "gross_generation_mwh"
_ALL = "ORDER BY timestamp, asset_id"
SQL["lag_lead_whole_table"] = f"""
SELECT timestamp, asset_id, {_GROSS}, {_lag('LAG', _GROSS, 1, _ALL)},
  {_lag('LAG', _GROSS, 5, _ALL)}, {_lag('LEAD', _GROSS, 2, _ALL)}
FROM stg_generation"""
SQL["rolling_stats_whole_table"] = f"""
SELECT timestamp, asset_id, {_GROSS},
  {_full_frame('AVG', _GROSS, 24, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_mean_24,
  {_full_frame('STDDEV_SAMP', _GROSS, 24, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_std_24,
  {_full_frame('MIN', _GROSS, 24, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_min_24,
  {_full_frame('MAX', _GROSS, 24, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_max_24
FROM stg_generation"""
_BY_TYPE = "PARTITION BY asset_type"
SQL["rolling_stats_split_series"] = f"""
SELECT asset_type, timestamp, asset_id, {_GROSS},
  {_full_frame('AVG', _GROSS, 12, _BY_TYPE, 'timestamp, asset_id')} AS {_GROSS}_rolling_mean_12,
  {_full_frame('MAX', _GROSS, 12, _BY_TYPE, 'timestamp, asset_id')} AS {_GROSS}_rolling_max_12
FROM stg_generation"""
SQL["rolling_stats_year"] = f"""
SELECT timestamp, asset_id, {_GROSS},
  {_full_frame('AVG', _GROSS, 8760, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_mean_8760,
  {_full_frame('STDDEV_SAMP', _GROSS, 8760, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_std_8760,
  {_full_frame('MIN', _GROSS, 8760, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_min_8760,
  {_full_frame('MAX', _GROSS, 8760, '', 'timestamp, asset_id')} AS {_GROSS}_rolling_max_8760
FROM stg_generation"""
_F720 = "OVER (PARTITION BY asset_type ORDER BY timestamp, asset_id ROWS BETWEEN 719 PRECEDING AND CURRENT ROW)"
_WIND_CF = "CASE WHEN wind_speed_mps IS NOT NULL AND capacity_factor IS NOT NULL THEN 1 END"
SQL["rolling_correlation_month"] = f"""
SELECT asset_type, timestamp, asset_id, {_r6('wind_speed_mps', 'capacity_factor')},
  {r(f"CASE WHEN COUNT({_WIND_CF}) {_F720} = 720 THEN CORR(wind_speed_mps, capacity_factor) {_F720} END", 6)}
    AS corr_wind_speed_mps_capacity_factor_rolling_720
FROM joined"""
SQL["rolling_7d_30d"] = """
SELECT asset_id, date, rolling_7d_avg_generation, rolling_7d_avg_cf,
  rolling_30d_avg_generation, rolling_30d_avg_cf FROM weather_mart"""
SQL["rank_signal"] = f"""
SELECT timestamp, asset_id, {_GROSS},
  {r(f'''(ROW_NUMBER() OVER (ORDER BY {_GROSS} NULLS FIRST, timestamp, asset_id) - 1)::DOUBLE
    / GREATEST(COUNT(*) OVER () - 1, 1)''', 6)} AS rank_signal
FROM stg_generation"""
SQL["cumulative_mix"] = f"""
SELECT date, CAST(series AS INTEGER) AS series, asset_type, {r('value', 6)} AS value,
  {r('COALESCE(SUM(value) OVER (PARTITION BY date ORDER BY series ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)', 6)} AS lower,
  {r('SUM(value) OVER (PARTITION BY date ORDER BY series ROWS UNBOUNDED PRECEDING)', 6)} AS upper
FROM mix"""
SQL["weather_performance_local"] = f"""
SELECT s.asset_id, s.date, s.inferred_asset_type,
  {r('s.e', 6)} AS avg_expected_generation_mwh, {r('s.a', 6)} AS avg_actual_generation_mwh,
  {r('s.q', 6)} AS avg_performance_ratio_pct, {r('s.wr', 6)} AS wind_r_squared,
  {r('s.sr', 6)} AS solar_r_squared, {r(clamp('s.q', '0', '100'), 6)} AS performance_score,
  {_SCORE.format(c='(' + clamp('s.q', '0', '100') + ')')} AS performance_category,
  {r('d.m7', 6)} AS rolling_7d_avg_cf, {r('d.m30', 6)} AS rolling_30d_avg_cf
FROM (
  SELECT asset_id, date, MAX(technology) AS inferred_asset_type, AVG(expected) AS e,
    AVG(net_generation_mwh) AS a, AVG(ratio) AS q,
    MAX(CASE WHEN technology = 'wind' THEN r2 END) AS wr,
    MAX(CASE WHEN technology = 'solar' THEN r2 END) AS sr
  FROM local_scored GROUP BY asset_id, date) s
LEFT JOIN (
  SELECT asset_id, date,
    AVG(daily_capacity_factor) OVER (PARTITION BY asset_id ORDER BY date
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
    AVG(daily_capacity_factor) OVER (PARTITION BY asset_id ORDER BY date
      ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30
  FROM local_daily_raw) d ON s.asset_id = d.asset_id AND s.date = d.date"""
SQL["operational_ratio"] = f"""
SELECT asset_id, timestamp, technology, {r(_OPERATIONAL, 6)} AS operational_ratio
FROM local_hours"""
SQL["air_density"] = f"SELECT asset_id, timestamp, {r(_RHO, 6)} AS air_density FROM weather"
for _tech in ("wind", "solar"):
    SQL[f"{_tech}_theoretical"] = (
        f"SELECT asset_id, timestamp, {r('potential_mwh', 6)} AS potential_mwh "
        f"FROM potential WHERE asset_type = '{_tech}'"
    )
SQL["gas_fuel_co2"] = f"""
SELECT asset_id, timestamp, {r('rate', 6)} AS heat_rate,
  {r('net_generation_mwh * rate / 1000.0e0', 6)} AS fuel,
  {r('net_generation_mwh * rate / 1000.0e0 * 0.05306e0', 6)} AS co2
FROM (
  SELECT *, CASE WHEN net_generation_mwh > 0
    THEN 6900.0e0 * (0.90e0 + 0.10e0 / (net_generation_mwh / asset_capacity_mw))
    ELSE 6900.0e0 END AS rate
  FROM generation WHERE asset_type = 'gas')"""
SQL["clear_sky_ghi"] = f"""
SELECT asset_id, timestamp, {r('1050.0e0 * GREATEST(0, SIN(lat) * SIN(decl) + COS(lat) * COS(decl) * COS(ha))', 6)}
    AS clear_sky_ghi
FROM (
  SELECT w.asset_id, w.timestamp, RADIANS(a.latitude) AS lat,
    RADIANS(23.45e0 * SIN(RADIANS(360.0e0 * (284 + EXTRACT(DOY FROM w.timestamp)) / 365.0e0)))
      AS decl,
    RADIANS(15.0e0 * (EXTRACT(HOUR FROM w.timestamp) - 12.0e0)) AS ha
  FROM weather w JOIN assets a ON w.asset_id = a.asset_id)"""
SQL["demand_curve"] = f"SELECT timestamp, {r('demand_mw', 6)} AS demand_mw FROM balance"
SQL["net_load"] = f"""
SELECT timestamp, renewable_mw, demand_mw, net_load_mw,
  {r('''(ROW_NUMBER() OVER (ORDER BY net_load_mw, timestamp) - 1)::DOUBLE
    / GREATEST(COUNT(*) OVER () - 1, 1)''', 6)} AS rank_signal
FROM (SELECT timestamp, {_r6('renewable_mw', 'demand_mw', 'net_load_mw')} FROM balance)"""
SQL["curtailment_allocation"] = f"""
SELECT asset_id, timestamp, asset_type, {_r6('capacity_mw', 'potential_mwh')},
  {r('share', 6)} AS curtail_share, {r('potential_mwh * share', 6)} AS curtailment_mwh,
  {r(clamp('potential_mwh - potential_mwh * share'), 6)} AS net_generation_mwh
FROM (
  SELECT p.*, CASE WHEN b.renewable_mw > 0
    THEN GREATEST(b.renewable_mw - b.demand_mw, 0) / b.renewable_mw ELSE 0.0e0 END AS share
  FROM potential p JOIN balance b ON p.timestamp = b.timestamp)"""
SQL["range_violations_weather"] = """
SELECT COUNT(*) AS out_of_range_rows, COUNT(*) = 0 AS passed FROM stg_weather
WHERE wind_speed_mps < 0 OR wind_speed_mps > 50 OR temperature_c < -50 OR temperature_c > 60
  OR relative_humidity < 0 OR relative_humidity > 100"""
SQL["range_violations_generation"] = """
SELECT COUNT(*) AS out_of_range_rows, COUNT(*) = 0 AS passed FROM stg_generation
WHERE asset_type <> 'battery'
  AND (net_generation_mwh < 0 OR capacity_factor < 0 OR capacity_factor > 1)"""
SQL["row_count_check"] = """
SELECT table_name, row_count, CAST(100 AS INTEGER) AS minimum, row_count >= 100 AS passed
FROM (
  SELECT 'raw_weather' AS table_name, COUNT(*) AS row_count FROM raw_weather
  UNION ALL SELECT 'raw_generation', COUNT(*) FROM raw_generation
  UNION ALL SELECT 'daily_mart', COUNT(*) FROM daily_mart
  UNION ALL SELECT 'correlation', COUNT(DISTINCT asset_id) FROM daily_mart)"""
SQL["freshness_check"] = """
SELECT t, max_timestamp, CAST(48 AS INTEGER) AS threshold_hours,
  COALESCE(max_timestamp >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 48 HOUR, FALSE) AS passed,
  CASE WHEN max_timestamp IS NULL THEN 'no rows' END AS reason
FROM (SELECT 'weather' AS t, MAX(timestamp) AS max_timestamp FROM stg_weather
      UNION ALL SELECT 'generation', MAX(timestamp) FROM stg_generation)"""
SQL["data_age_badge"] = """
SELECT days, CASE WHEN days <= 2 THEN 'data current'
  ELSE 'data ' || CAST(days AS VARCHAR) || ' days behind' END AS badge
FROM (SELECT CAST(FLOOR(EPOCH(TIMESTAMP '2024-02-01 00:00:00' - CAST(MAX(date) AS TIMESTAMP))
        / 86400) AS BIGINT) AS days FROM daily_mart)"""


def _rules(table: str, column_rules: list[tuple[str, str]], key: tuple[str, str, str]) -> str:
    """A report from (rule, condition that breaks it) pairs and one uniqueness rule."""
    parts = [
        f"SELECT '{name}' AS rule, 'error' AS severity, COUNT(*) AS failures "
        f"FROM {table} WHERE {broken}"
        for name, broken in column_rules
    ]
    name, severity, columns = key
    parts.append(
        f"SELECT '{name}', '{severity}', COUNT(*) FROM (SELECT {columns} FROM {table} "
        f"GROUP BY {columns} HAVING COUNT(*) > 1)"
    )
    union = " UNION ALL ".join(parts)
    return (
        "SELECT rule, severity, failures, CASE WHEN failures = 0 THEN 'pass' "
        f"WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({union})"
    )


_KINDS = "('wind', 'solar', 'battery', 'gas')"
SQL["rule_report"] = _rules(
    "raw_generation",
    [
        (f"not_null:{c}", f"{c} IS NULL")
        for c in (
            "timestamp", "asset_id", "asset_type", "gross_generation_mwh",
            "net_generation_mwh", "curtailment_mwh", "availability_pct", "asset_capacity_mw",
        )
    ]
    + [
        ("accepted_values:asset_type", f"asset_type NOT IN {_KINDS}"),
        ("accepted_range:gross_generation_mwh", "gross_generation_mwh < 0"),
        (
            "accepted_range:net_generation_mwh",
            "net_generation_mwh < 0 AND asset_type <> 'battery'",
        ),
        ("accepted_range:curtailment_mwh", "curtailment_mwh < 0"),
        ("accepted_range:availability_pct", "NOT availability_pct BETWEEN 0 AND 100"),
        ("accepted_range:asset_capacity_mw", "NOT asset_capacity_mw BETWEEN 0 AND 1000"),
    ],
    ("unique:asset_id,timestamp", "warn", "asset_id, timestamp"),
)
SQL["rule_report_weather_mart"] = _rules(
    "weather_mart",
    [
        (f"not_null:{c}", f"{c} IS NULL")
        for c in ("asset_id", "date", "performance_score", "inferred_asset_type")
    ]
    + [
        (f"accepted_range:{d}_generation_correlation",
         f"NOT {d}_generation_correlation BETWEEN -1 AND 1")
        for d in ("wind", "solar")
    ]
    + [
        ("accepted_range:performance_score", "NOT performance_score BETWEEN 0 AND 100"),
        ("accepted_values:inferred_asset_type", f"inferred_asset_type NOT IN {_KINDS}"),
    ],
    ("unique:asset_id,date", "error", "asset_id, date"),
)


def _nulls(*columns: str) -> list[tuple[str, str]]:
    return [(f"not_null:{c}", f"{c} IS NULL") for c in columns]


def _outside(*ranges: tuple[str, float, float]) -> list[tuple[str, str]]:
    return [(f"accepted_range:{c}", f"NOT {c} BETWEEN {low} AND {high}") for c, low, high in ranges]


def _other_kind(column: str = "asset_type") -> tuple[str, str]:
    return f"accepted_values:{column}", f"{column} NOT IN {_KINDS}"


def _output(column: str) -> tuple[str, str]:
    return f"accepted_range:{column}", f"asset_type <> 'battery' AND NOT {column} BETWEEN 0 AND 1.1"


_HOUR_KEY, _DAY_KEY = "asset_id, timestamp", "asset_id, date"
SQL["rule_report_raw_weather"] = _rules(
    "raw_weather",
    _nulls("timestamp", "asset_id", "wind_speed_mps", "wind_direction_deg", "ghi", "temperature_c",
           "pressure_hpa", "relative_humidity")
    + _outside(("wind_speed_mps", 0, 50), ("wind_direction_deg", 0, 360), ("ghi", 0, 1500),
               ("temperature_c", -50, 60), ("pressure_hpa", 900, 1100), ("relative_humidity", 0, 100)),
    ("unique:asset_id,timestamp", "warn", _HOUR_KEY),
)
SQL["rule_report_stg_weather"] = _rules(
    "stg_weather",
    _nulls("timestamp", "asset_id", "wind_speed_mps", "ghi", "is_data_complete"),
    ("unique:asset_id,timestamp", "error", _HOUR_KEY),
)
SQL["rule_report_stg_generation"] = _rules(
    "stg_generation",
    _nulls("timestamp", "asset_id", "asset_type", "net_generation_mwh", "capacity_factor", "is_data_valid")
    + [_other_kind(), _output("capacity_factor")],
    ("unique:asset_id,timestamp", "error", _HOUR_KEY),
)
SQL["rule_report_weather_daily"] = _rules(
    "weather_daily", _nulls("asset_id", "date"), ("unique:asset_id,date", "error", _DAY_KEY)
)
SQL["rule_report_generation_daily"] = _rules(
    "generation_daily",
    _nulls("asset_id", "date", "total_net_generation_mwh") + [_output("daily_capacity_factor")],
    ("unique:asset_id,date", "error", _DAY_KEY),
)
SQL["rule_report_join"] = _rules(
    "joined", _nulls("timestamp", "asset_id", "is_complete_record"), ("unique:asset_id,timestamp", "error", _HOUR_KEY)
)
SQL["rule_report_daily_mart"] = _rules(
    "daily_mart",
    _nulls("asset_id", "date", "asset_type", "total_net_generation_mwh", "daily_capacity_factor")
    + [_other_kind(), _output("daily_capacity_factor")]
    + _outside(("avg_availability_pct", 0, 100)),
    ("unique:asset_id,date", "error", _DAY_KEY),
)
SQL["rule_report_dim_asset"] = _rules(
    "dim_asset", _nulls("asset_id") + [_other_kind()], ("unique:asset_id", "error", "asset_id")
)
SQL["failing_rows"] = """
SELECT asset_id, timestamp, concat_ws(',',
    CASE WHEN net_generation_mwh IS NULL THEN 'not_null:net_generation_mwh' END,
    CASE WHEN capacity_factor IS NULL THEN 'not_null:capacity_factor' END,
    CASE WHEN asset_type <> 'battery' AND (capacity_factor < 0 OR capacity_factor > 1.1)
      THEN 'accepted_range:capacity_factor' END) AS failed_rules
FROM stg_generation
WHERE net_generation_mwh IS NULL OR capacity_factor IS NULL
  OR (asset_type <> 'battery' AND (capacity_factor < 0 OR capacity_factor > 1.1))"""
SQL["stored_failures"] = SQL["failing_rows"]
_REPEATED = " UNION ALL ".join(
    f"SELECT 'unique:{columns.replace(' ', '')}' AS rule, '{severity}' AS severity, COUNT(*) AS failures, "
    "CAST(COALESCE(SUM(c), 0) AS BIGINT) AS n_records, COALESCE(MAX(c), 0) AS largest FROM "
    f"(SELECT COUNT(*) AS c FROM raw_generation WHERE {' AND '.join(f'{x} IS NOT NULL' for x in columns.split(', '))} "
    f"GROUP BY {columns} HAVING COUNT(*) > 1)"
    for columns, severity in (
        ("asset_id, timestamp", "warn"), ("_load_id", "error"), ("asset_id, timestamp, net_generation_mwh", "warn"),
    )
)
SQL["unique_report"] = f"""
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({_REPEATED})"""
SQL["report_during_write"] = f"SELECT * FROM ({SQL['rule_report_daily_mart']}) WHERE rule NOT LIKE 'unique%'"
SQL["unique_violations"] = """
SELECT asset_id, timestamp, COUNT(*) AS n_records FROM raw_generation
GROUP BY asset_id, timestamp HAVING COUNT(*) > 1"""
SQL["metric_daily_generation"] = f"""
SELECT CAST(date_trunc('week', date) AS DATE) AS date, asset_size_category,
  {r('SUM(total_net_generation_mwh)', 6)} AS daily_generation
FROM daily_mart GROUP BY 1, 2"""
SQL["metric_generation_efficiency"] = f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS date, daily_performance_rating,
  {r('AVG(daily_capacity_factor)', 6)} AS generation_efficiency
FROM daily_mart WHERE asset_type <> 'battery' GROUP BY 1, 2"""
SQL["metric_weather_adjusted_score"] = f"""
SELECT date AS weather_date, inferred_asset_type,
  {r('AVG(performance_score)', 6)} AS weather_adjusted_score
FROM weather_mart GROUP BY 1, 2"""
_MEASURES = [
    ("asset_performance", "total_generation", "SUM(total_net_generation_mwh)", "daily_mart"),
    ("asset_performance", "avg_capacity_factor", "AVG(daily_capacity_factor)", "daily_mart"),
    ("asset_performance", "avg_temperature", "AVG(avg_temperature_c)", "daily_mart"),
    ("asset_performance", "avg_availability", "AVG(avg_availability_pct)", "daily_mart"),
    ("asset_performance", "total_curtailment", "SUM(total_curtailment_mwh)", "daily_mart"),
    ("asset_weather_performance", "avg_performance_score", "AVG(performance_score)",
     "weather_mart"),
    ("asset_weather_performance", "avg_actual_generation", "AVG(avg_actual_generation_mwh)",
     "weather_mart"),
    ("asset_weather_performance", "avg_expected_generation",
     "AVG(avg_expected_generation_mwh)", "weather_mart"),
    ("asset_weather_performance", "avg_performance_ratio", "AVG(avg_performance_ratio_pct)",
     "weather_mart"),
]
SQL["metric_measures"] = " UNION ALL ".join(
    f"SELECT '{model}' AS model, '{measure}' AS measure, {r(agg, 6)} AS value FROM {table}"
    for model, measure, agg, table in _MEASURES
)
_SPINE = (
    "SELECT CAST(UNNEST(generate_series(MIN(timestamp)::DATE::TIMESTAMP, "
    "MAX(timestamp)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date_day FROM stg_generation"
)
SQL["time_spine"] = _SPINE
SQL["metric_on_spine"] = f"""
SELECT s.date_day, {r('m.v', 6)} AS daily_generation
FROM (SELECT DISTINCT CAST(date_day + CAST(shift AS INTEGER) AS DATE) AS date_day
      FROM ({_SPINE}) CROSS JOIN (VALUES (-40), (0), (40)) AS v(shift)) s
LEFT JOIN (SELECT date, SUM(total_net_generation_mwh) AS v FROM daily_mart
           GROUP BY date) m ON s.date_day = m.date"""
_COMMAS = "format('{{:,}}', CAST(ROUND({x}) AS BIGINT))"
SQL["fleet_kpis"] = f"""
SELECT key, label, {r('value', 6)} AS value, display, unit FROM (
  SELECT 'net_generation' AS key, 'net generation' AS label, net AS value,
    {_COMMAS.format(x='net')} AS display, 'MWh' AS unit FROM kpi_totals
  UNION ALL SELECT 'capacity_factor', 'fleet capacity factor', cf,
    printf('%.1f', cf * 100) || '%', 'wind · solar · gas' FROM kpi_totals
  UNION ALL SELECT 'renewable_share', 'renewable share', share,
    {_COMMAS.format(x='share')} || '%', 'of served load' FROM kpi_totals
  UNION ALL SELECT 'co2_emissions', 'CO₂ emissions', co2, {_COMMAS.format(x='co2')}, 'tonnes'
    FROM kpi_totals
  UNION ALL SELECT 'battery_throughput', 'battery discharge', batt,
    {_COMMAS.format(x='batt')}, 'MWh delivered' FROM kpi_totals
  UNION ALL SELECT 'curtailment', 'curtailment', curt, {_COMMAS.format(x='curt')}, 'MWh' FROM kpi_totals)"""
SQL["figures_by_grouping"] = f"""
SELECT CASE WHEN GROUPING(date) = 0 THEN 'date' WHEN GROUPING(asset_id) = 0 THEN 'asset'
    WHEN GROUPING(kind) = 0 THEN 'technology' ELSE 'total' END AS scope,
  date, asset_id, kind AS technology,
  {r('COALESCE(SUM(total_net_generation_mwh), 0)', 6)} AS net_generation,
  {r("AVG(CASE WHEN asset_type IN ('wind', 'solar', 'gas') THEN COALESCE(daily_capacity_factor, 0) END)", 6)} AS capacity_factor,
  {r('AVG(COALESCE(daily_capacity_factor, 0))', 6)} AS mean_capacity_factor,
  {r("AVG(CASE WHEN asset_type = 'battery' THEN avg_soc_pct END)", 6)} AS battery_soc,
  {r("COALESCE(SUM(CASE WHEN asset_type = 'gas' THEN total_co2_tonnes END), 0)", 6)} AS gas_emissions,
  {r("COALESCE(SUM(CASE WHEN asset_type = 'battery' THEN total_discharge_mwh END), 0)", 6)} AS battery_throughput,
  {r('COALESCE(SUM(total_curtailment_mwh), 0)', 6)} AS curtailment
FROM (SELECT *, asset_type AS kind FROM daily_export)
GROUP BY GROUPING SETS ((date), (asset_id), (kind), ())"""
SQL["generation_by_date"] = (
    f"SELECT date, {r('COALESCE(SUM(total_net_generation_mwh), 0)', 6)} AS value "
    "FROM daily_export GROUP BY date"
)
SQL["capacity_factor_by_date"] = (
    f"SELECT date, {r('AVG(COALESCE(daily_capacity_factor, 0))', 6)} AS value "
    "FROM daily_export WHERE asset_type IN ('wind', 'solar', 'gas') GROUP BY date"
)
SQL["score_by_date"] = (
    f"SELECT date, {r('AVG(COALESCE(performance_score, 0))', 6)} AS value "
    "FROM weather_mart GROUP BY date"
)
SQL["battery_soc_by_date"] = (
    f"SELECT date, {r('AVG(avg_soc_pct)', 6)} AS value FROM daily_export "
    "WHERE asset_type = 'battery' AND avg_soc_pct IS NOT NULL GROUP BY date"
)
SQL["emissions_by_date"] = (
    f"SELECT date, {r('COALESCE(SUM(total_co2_tonnes), 0)', 6)} AS value FROM daily_export "
    "WHERE asset_type = 'gas' GROUP BY date"
)
SQL["series_summary"] = f"""
SELECT MIN(date) AS first_label, MAX(date) AS last_label, {r('MAX(v)', 6)} AS y_max
FROM (SELECT date, COALESCE(SUM(total_net_generation_mwh), 0) AS v
      FROM daily_export GROUP BY date)"""
_BAR = (
    "CASE WHEN MAX(v) OVER () <> 0 THEN GREATEST(1.5, v / MAX(v) OVER () * 100.0e0) ELSE 0 END"
)
SQL["asset_bars"] = f"""
SELECT b.asset_id, COALESCE(a.display_name, b.asset_id) AS name,
  COALESCE(a.asset_type, '') AS asset_type, {r('b.v', 6)} AS value, {r('b.pct', 6)} AS pct
FROM (SELECT asset_id, v, {_BAR} AS pct FROM (
        SELECT asset_id, AVG(COALESCE(daily_capacity_factor, 0)) AS v
        FROM daily_export GROUP BY asset_id)) b
LEFT JOIN assets_export a ON b.asset_id = a.asset_id"""
SQL["type_split"] = f"""
SELECT asset_type, {r('v', 6)} AS value, {r(_BAR, 6)} AS pct
FROM (SELECT asset_type, COALESCE(SUM(total_net_generation_mwh), 0) AS v
      FROM daily_export GROUP BY asset_type)"""
SQL["generation_mix"] = (
    f"SELECT date, CAST(series AS INTEGER) AS series, asset_type, {r('value', 6)} AS value FROM mix"
)
SQL["fleet_roster"] = f"""
SELECT a.asset_id, COALESCE(a.display_name, a.asset_id) AS name, a.asset_type,
  COALESCE(a.capacity_mw, 0) AS capacity_mw, COALESCE(NULLIF(a.region, ''), '—') AS region,
  {r('COALESCE(d.c, 0)', 6)} AS capacity_factor, {r('COALESCE(d.g, 0)', 6)} AS net_generation_mwh
FROM assets_export a LEFT JOIN (
  SELECT asset_id, AVG(COALESCE(daily_capacity_factor, 0)) AS c,
    SUM(COALESCE(total_net_generation_mwh, 0)) AS g
  FROM daily_export GROUP BY asset_id) d ON a.asset_id = d.asset_id"""
SQL["upsert_latest"] = f"""
SELECT timestamp, asset_id, asset_type, {_r6(*_GEN_DOUBLES)}, _load_id,
  CAST(timestamp AS DATE) AS date FROM generation"""
SQL["upsert_weather"] = f"""
SELECT timestamp, asset_id, {_r6(*_WX_DOUBLES)}, _load_id,
  CAST(timestamp AS DATE) AS date FROM weather"""
SQL["schema_evolution"] = f"""
SELECT timestamp, asset_id, {r('gross_generation_mwh', 6)} AS gross_generation_mwh, _load_id,
  CASE WHEN _load_id % 3 = 1 THEN {r('availability_pct', 6)} END AS availability_pct,
  CAST(timestamp AS DATE) AS date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY asset_id, timestamp ORDER BY _load_id DESC) AS rn
      FROM (SELECT * REPLACE (CASE WHEN _load_id % 11 <> 0 THEN timestamp END AS timestamp)
            FROM raw_generation))
WHERE rn = 1"""
SQL["lookback_window"] = f"""
SELECT * FROM (
  SELECT asset_id, date, {_NET}, {_daily_rolling(('mean',), (3,))} FROM generation_daily
  WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20')
WHERE date = DATE '2024-01-20'"""
SQL["day_partition"] = f"""
SELECT timestamp, asset_id, asset_type, {_r6(*_GEN_DOUBLES)} FROM generation
WHERE CAST(timestamp AS DATE) = DATE '2024-01-20'"""
SQL["filter_date_range"] = """
SELECT asset_id, timestamp, date, net_generation_mwh FROM stg_generation
WHERE timestamp >= TIMESTAMP '2024-01-05 00:00:00'
  AND timestamp <= TIMESTAMP '2024-01-10 12:00:00'"""
SQL["parquet_roundtrip"] = f"""
SELECT timestamp, asset_id, {_r6(*_WX_DOUBLES)}, CAST(timestamp AS DATE) AS date FROM weather"""
_ZERO = lambda c: f"COALESCE({c}, 0) AS {c}"
SQL["json_export_roundtrip"] = f"""
SELECT asset_id, CAST(date AS VARCHAR) AS date, {_ZERO('total_net_generation_mwh')},
  {_ZERO('daily_capacity_factor')}, {_ZERO('avg_availability_pct')},
  {_ZERO('total_curtailment_mwh')}, {_ZERO('total_discharge_mwh')},
  {_ZERO('total_co2_tonnes')}, {_ZERO('total_fuel_mmbtu')},
  daily_performance_rating, asset_type, avg_soc_pct
FROM daily_export"""
SQL["weather_json_roundtrip"] = """
SELECT asset_id, CAST(date AS VARCHAR) AS date, COALESCE(performance_score, 0)
    AS performance_score, performance_category, inferred_asset_type
FROM weather_mart"""
SQL["assets_json_roundtrip"] = """
SELECT asset_id, capacity_mw, size_category, asset_type, display_name, region
FROM assets_export"""
SQL["manifest"] = """
SELECT '2024-02-01T00:00:00Z' AS generated_at, 'run-1' AS pipeline_run_id,
  (SELECT CAST(MIN(date) AS VARCHAR) FROM daily_mart) AS first_day,
  (SELECT CAST(MAX(date) AS VARCHAR) FROM daily_mart) AS last_day,
  (SELECT COUNT(*) FROM assets_export) AS asset_count,
  (SELECT '{' || string_agg('"' || asset_type || '":' || c, ',' ORDER BY asset_type) || '}'
   FROM (SELECT asset_type, CAST(COUNT(*) AS VARCHAR) AS c FROM assets_export GROUP BY 1))
    AS asset_type_counts,
  'warehouse' AS weather_source,
  (SELECT COUNT(*) FROM daily_mart) AS daily_rows,
  (SELECT COUNT(*) FROM weather_mart) AS weather_rows, '2.0' AS schema_version"""
_DEFAULTS = {"temperature_c": 15.0, "pressure_hpa": 1013.0, "relative_humidity": 60.0}
SQL["flatten_hourly_payload"] = (
    "SELECT timestamp, asset_id, "
    + ", ".join(
        f"{r(f'COALESCE({c}, {_DEFAULTS.get(c, 0.0)})', 6)} AS {c}" for c in _WX_DOUBLES
    )
    + " FROM weather"
)
SQL["csv_seed_roundtrip"] = (
    "SELECT asset_id, asset_name, asset_type, capacity_mw, latitude, longitude, region FROM assets"
)
SQL["contract_checked_mart"] = (
    "SELECT * REPLACE (CAST(date AS TIMESTAMP) AS date) FROM weather_mart"
)
SQL["contract_daily_mart"] = (
    "SELECT * REPLACE (CAST(date AS TIMESTAMP) AS date) FROM daily_mart "
    "WHERE asset_id IS NOT NULL AND date IS NOT NULL AND asset_type IS NOT NULL "
    "AND total_net_generation_mwh IS NOT NULL AND daily_capacity_factor IS NOT NULL"
)
SQL["contract_dim_asset"] = SQL["dim_asset"]


def oracle_sql() -> dict[str, str]:
    return {name: _full(sql) for name, sql in SQL.items()}
