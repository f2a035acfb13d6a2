import datetime as dt

import pytest
from plan_text import physical_plan
from pyspark.sql import functions as F

from voltseries.operators.dedup import keep_latest
from voltseries.plans import daily, staging

WEATHER = (
    "timestamp timestamp_ntz, asset_id string, wind_speed_mps double, wind_direction_deg double, "
    "ghi double, temperature_c double, pressure_hpa double, relative_humidity double, "
    "_load_id bigint"
)
GENERATION = (
    "timestamp timestamp_ntz, asset_id string, asset_type string, gross_generation_mwh double, "
    "net_generation_mwh double, curtailment_mwh double, availability_pct double, "
    "asset_capacity_mw double, soc_pct double, charge_mwh double, discharge_mwh double, "
    "fuel_mmbtu double, heat_rate_btu_kwh double, co2_tonnes double, _load_id bigint"
)
T0 = dt.datetime(2023, 1, 1)  # a Sunday


def weather(spark, *rows):
    """Rows of (hour, asset, wind, ghi, temperature, load)."""
    return spark.createDataFrame(
        [(T0 + dt.timedelta(hours=h), a, w, 180.0, g, t, 1013.25, 50.0, n) for h, a, w, g, t, n in rows],
        WEATHER,
    )


def generation(spark, *rows):
    """Rows of (hour, asset, type, gross, net, capacity, load); availability 99."""
    return spark.createDataFrame(
        [
            (T0 + dt.timedelta(hours=h), a, k, g, n, 0.5, 99.0, c) + (None,) * 6 + (load,)
            for h, a, k, g, n, c, load in rows
        ],
        GENERATION,
    )


def test_null_measurements_take_the_last_label(spark):
    row = staging.stg_weather(weather(spark, (0, "A", None, None, None, 1))).first()
    assert row.wind_speed_category == "Very Strong"
    assert row.irradiance_category == "High Irradiance"
    assert row.temperature_category == "Warm"
    assert row.is_data_complete is False
    row = staging.stg_generation(generation(spark, (0, "A", "wind", None, None, None, 1))).first()
    assert row.asset_size_category == "Small"
    assert row.performance_category == "Very Poor"
    assert row.is_data_valid is False
    assert row.is_zero_generation_anomaly is False


@pytest.mark.parametrize(
    "wind,label", [(2.999, "Calm"), (3.0, "Moderate"), (11.9, "Moderate"), (12.0, "Strong"),
                   (24.99, "Strong"), (25.0, "Very Strong")]
)
def test_wind_limits(spark, wind, label):
    row = staging.stg_weather(weather(spark, (0, "A", wind, 0.0, 0.0, 1))).first()
    assert row.wind_speed_category == label


def test_categories_read_the_unrounded_value(spark):
    # 2.999 is Calm although it is stored as 3.0.
    row = staging.stg_weather(weather(spark, (0, "A", 2.999, 0.0, 0.0, 1))).first()
    assert (row.wind_speed_mps, row.wind_speed_category) == (3.0, "Calm")


def test_weekday_counts_from_sunday(spark):
    rows = staging.stg_weather(weather(spark, (0, "A", 1.0, 0.0, 0.0, 1), (24, "A", 1.0, 0.0, 0.0, 1)))
    assert [r.day_of_week for r in rows.orderBy("timestamp").collect()] == [0, 1]


def test_generation_flags(spark):
    rows = {
        r.asset_id: r
        for r in staging.stg_generation(
            generation(
                spark,
                (0, "ok", "wind", 51.0, 50.0, 100.0, 1),
                (0, "above_gross", "wind", 49.0, 50.0, 100.0, 1),
                (0, "overgen", "wind", 111.0, 110.1, 100.0, 1),
                (0, "idle_wind", "wind", 0.0, 0.0, 100.0, 1),
                (0, "idle_gas", "gas", 0.0, 0.0, 100.0, 1),
                (0, "no_capacity", "wind", 1.0, 1.0, 0.0, 1),
            )
        ).collect()
    }
    assert rows["ok"].is_data_valid and rows["ok"].capacity_factor == 0.5
    assert rows["ok"].loss_percentage == 1.96
    assert not rows["above_gross"].is_data_valid
    assert not rows["overgen"].is_data_valid
    assert rows["idle_wind"].is_zero_generation_anomaly
    assert rows["idle_wind"].loss_percentage is None
    assert not rows["idle_gas"].is_zero_generation_anomaly
    assert rows["no_capacity"].capacity_factor is None
    assert rows["no_capacity"].hours_at_capacity is None
    assert rows["no_capacity"].performance_category == "Very Poor"


def test_latest_load_wins_and_ties_are_stable(spark):
    rows = [(0, "A", "wind", float(v), float(v), 100.0, load) for v, load in
            [(10, 1), (20, 3), (30, 2), (5, 3)]]
    for seed in range(4):
        raw = generation(spark, *rows).orderBy(F.rand(seed)).repartition(3)
        got = staging.stg_generation(raw).collect()
        assert len(got) == 1 and got[0].net_generation_mwh == 5.0  # lowest of the tied loads


def test_dedup_cuts_copies_before_the_shuffle(spark):
    """Most rows share one key: each map task must pass on one row of it."""
    df = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 0 ELSE id END AS k", "id AS _load_id"
    ).repartition(4)
    latest = keep_latest(df, ["k"])
    plan = physical_plan(latest)
    assert plan.count("WindowGroupLimit") == 2
    partial = plan.rindex("WindowGroupLimit")
    assert plan.index("Exchange hashpartitioning(k") < partial
    assert latest.count() == 10000
    assert latest.filter("k = 0").first()._load_id == 29999


def test_daily_sums_of_nulls_stay_null(spark):
    stg = staging.stg_generation(
        generation(spark, (0, "A", "wind", 5.0, None, 100.0, 1), (1, "A", "wind", 5.0, None, 100.0, 1))
    )
    row = daily.int_generation_daily(stg).first()
    assert row.total_net_generation_mwh is None
    assert row.daily_capacity_factor is None
    assert (row.total_hours, row.generating_hours, row.valid_observation_count) == (2, 0, 0)
    assert row.data_validity_pct == 0.0


def test_daily_capacity_factor_divides_by_24_hours(spark):
    stg = staging.stg_generation(
        generation(spark, (0, "A", "wind", 51.0, 50.0, 100.0, 1), (1, "A", "wind", 52.0, 51.0, 100.0, 1))
    )
    row = daily.int_generation_daily(stg).first()
    assert row.daily_capacity_factor == round(101 / 2400, 4)
    assert row.avg_hourly_capacity_factor == 0.505
    assert row.total_curtailment_mwh == 1.0


def test_mart_keeps_days_without_weather(spark):
    stg = staging.stg_generation(generation(spark, (0, "A", "wind", 51.0, 50.0, 100.0, 1)))
    wx = staging.stg_weather(weather(spark, (30, "A", 5.0, 200.0, 15.0, 1)))
    mart = daily.mart_asset_performance_daily(
        daily.int_generation_daily(stg), daily.int_weather_daily(wx)
    )
    row = mart.first()
    assert mart.count() == 1
    assert row.avg_wind_speed_mps is None and row.data_completeness_pct is None
    assert row.has_high_quality_data is False
    assert row.daily_performance_rating == "Low"


def test_weather_daily(spark):
    wx = staging.stg_weather(
        weather(spark, (9, "A", 5.0, 100.0, 10.0, 1), (12, "A", 15.0, 300.0, 20.0, 1),
                (13, "A", None, 500.0, 20.0, 1))
    )
    row = daily.int_weather_daily(wx).first()
    assert row.avg_wind_speed_mps == 10.0 and row.std_wind_speed_mps == 7.07
    assert row.avg_peak_ghi == 400.0 and row.daylight_hours == 3
    assert (row.strong_wind_hours, row.very_strong_wind_hours) == (1, 1)
    assert (row.observation_count, row.complete_observation_count) == (3, 2)
    assert row.data_completeness_pct == 66.67


def test_distinct_staging_is_a_no_op(spark):
    raw = weather(spark, (0, "A", 5.0, 1.0, 1.0, 1), (0, "A", 5.0, 1.0, 1.0, 2))
    assert staging.stg_weather(raw, distinct=True).collect() == staging.stg_weather(raw).collect()
