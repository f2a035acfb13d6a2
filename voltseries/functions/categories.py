"""Category labels and record flags.

Fixed values: thresholds and labels must equal the ones the marts publish. A NULL
measurement falls through every comparison into the last label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltseries.functions.numeric import true_when

TECHNOLOGIES = ("wind", "solar", "battery", "gas")
WEATHER_DRIVEN = ("wind", "solar")
GENERATING = ("wind", "solar", "gas")

MIN_AVAILABILITY_PCT = 85.0


def _below(c: Column, steps: list[tuple[float, str]], last: str) -> Column:
    label = F
    for limit, name in steps:
        label = label.when(c < limit, name)
    return label.otherwise(last)


def _at_least(c: Column, steps: list[tuple[float, str]], last: str) -> Column:
    label = F
    for limit, name in steps:
        label = label.when(c >= limit, name)
    return label.otherwise(last)


def _above(c: Column, steps: list[tuple[float, str]], last: str) -> Column:
    label = F
    for limit, name in steps:
        label = label.when(c > limit, name)
    return label.otherwise(last)


def wind_speed_category(speed: Column) -> Column:
    return _below(speed, [(3, "Calm"), (12, "Moderate"), (25, "Strong")], "Very Strong")


def irradiance_category(ghi: Column) -> Column:
    return _below(
        ghi,
        [(100, "Night/Cloudy"), (400, "Low Irradiance"), (700, "Moderate Irradiance")],
        "High Irradiance",
    )


def temperature_category(temperature: Column) -> Column:
    return _below(temperature, [(0, "Below Freezing"), (15, "Cold"), (25, "Moderate")], "Warm")


def size_category(capacity: Column) -> Column:
    return _at_least(capacity, [(75, "Large"), (50, "Medium")], "Small")


def hourly_performance(cf: Column) -> Column:
    return _above(
        cf, [(0.9, "Excellent"), (0.6, "Good"), (0.3, "Fair"), (0.05, "Poor")], "Very Poor"
    )


def daily_rating(cf: Column) -> Column:
    return _at_least(cf, [(0.6, "High"), (0.3, "Medium")], "Low")


def score_category(score: Column) -> Column:
    return _at_least(score, [(95, "Excellent"), (85, "Good"), (70, "Fair")], "Poor")


def meets_availability(availability: Column, target: float = MIN_AVAILABILITY_PCT) -> Column:
    return true_when(availability >= target)


def generation_is_valid(gross: Column, net: Column, capacity: Column) -> Column:
    """All three present, net not above gross, at most 10 % above capacity."""
    return true_when(
        gross.isNotNull() & (net <= gross) & (net <= capacity * F.lit(1.1))
    )


def is_idle_anomaly(net: Column, availability: Column, asset_type: Column) -> Column:
    """An available wind or solar asset that produced nothing."""
    return true_when((net == 0) & (availability > 0) & asset_type.isin(*WEATHER_DRIVEN))


def weather_is_complete(*measurements: Column) -> Column:
    flag = F.lit(True)
    for m in measurements:
        flag = flag & m.isNotNull()
    return flag


def is_high_quality_day(validity: Column, completeness: Column) -> Column:
    return true_when((validity >= 95) & (completeness >= 95))
