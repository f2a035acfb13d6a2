import datetime as dt
from itertools import permutations

import pytest
from test_staging import GENERATION, T0, generation, weather

from voltseries.plans import local_flavour as local
from voltseries.plans import staging, weather_score
from voltseries.sources.records import ASSET_SEED


def joined(spark, gen, wx):
    return staging.int_asset_weather_join(staging.stg_generation(gen), staging.stg_weather(wx))


def linear_asset(spark, speeds, factor=2.0):
    gen = generation(
        spark, *[(h, "A", "wind", s * factor + 1, s * factor, 100.0, 1) for h, s in enumerate(speeds)]
    )
    wx = weather(spark, *[(h, "A", s, 0.0, 10.0, 1) for h, s in enumerate(speeds)])
    return gen, wx


def test_wind_asset_on_its_line_scores_full(spark):
    mart = weather_score.mart_asset_weather_performance(
        joined(spark, *linear_asset(spark, [float(s) for s in range(2, 26)]))
    )
    row = mart.first()
    assert row.wind_generation_correlation == 1.0 and row.wind_r_squared == 1.0
    assert (row.wind_regression_slope, row.wind_regression_intercept) == (2.0, 0.0)
    # The irradiance never varies, so its correlation is unknown and sun is chosen.
    assert row.solar_generation_correlation is None
    assert row.avg_expected_generation_mwh is None and row.performance_score == 0.0


def test_driver_with_the_larger_correlation(spark):
    speeds = [float(s) for s in range(2, 26)]
    gen, _ = linear_asset(spark, speeds)
    wx = weather(spark, *[(h, "A", s, float((h * 7) % 5), 10.0, 1) for h, s in enumerate(speeds)])
    row = weather_score.mart_asset_weather_performance(joined(spark, gen, wx)).first()
    assert row.avg_performance_ratio_pct == 100.0
    assert (row.performance_score, row.performance_category) == (100.0, "Excellent")
    assert row.rolling_7d_avg_generation == row.avg_actual_generation_mwh


def test_single_hour_has_no_line(spark):
    row = weather_score.mart_asset_weather_performance(
        joined(spark, *linear_asset(spark, [5.0]))
    ).first()
    assert row.wind_generation_correlation is None and row.wind_regression_slope is None
    assert (row.performance_score, row.performance_category) == (0.0, "Poor")
    assert row.total_hourly_observations == 1


def technology_rows(spark, kind, rows):
    """(hour, charge, discharge, heat rate) of one asset."""
    return spark.createDataFrame(
        [
            (T0 + dt.timedelta(hours=h), "A", kind, 50.0, 40.0, 0.0, 99.0, 100.0, 50.0, c, d,
             None, r, None, 1)
            for h, c, d, r in rows
        ],
        GENERATION,
    )


@pytest.mark.parametrize(
    "kind,rows,score",
    [
        ("battery", [(0, 10.0, 0.0, None), (1, 0.0, 8.8, None)], 88.0),
        ("battery", [(0, 0.0, 5.0, None)], 100.0),  # no charge: the default
        ("battery", [(0, 1.0, 5.0, None)], 100.0),  # clamped
        ("gas", [(0, None, None, 7000.0), (1, None, None, 8000.0)], 93.33),
        ("gas", [(0, None, None, None)], 100.0),
    ],
)
def test_technology_scores(spark, kind, rows, score):
    gen = technology_rows(spark, kind, rows)
    wx = weather(spark, *[(h, "A", 5.0 + h, 10.0 * h, 10.0, 1) for h, *_ in rows])
    row = weather_score.mart_asset_weather_performance(joined(spark, gen, wx)).first()
    assert row.performance_score == score and row.inferred_asset_type == kind


def test_stored_models_give_the_same_mart(spark, tmp_path):
    gen, wx = linear_asset(spark, [float(s) for s in range(2, 50)])
    rows = joined(spark, gen, wx)
    path = str(tmp_path / "models")
    weather_score.asset_models(weather_score.complete_hours(rows)).write.parquet(path)
    one = weather_score.mart_asset_weather_performance(rows)
    two = weather_score.mart_asset_weather_performance(rows, spark.read.parquet(path))
    assert sorted(one.collect()) == sorted(two.collect())


def test_rolling_means_allow_short_frames(spark):
    days = spark.createDataFrame(
        [("A", dt.date(2023, 1, d), float(d), d / 100) for d in range(1, 9)],
        "asset_id string, date date, daily_avg_net_generation_mwh double, "
        "daily_avg_capacity_factor double",
    )
    rows = weather_score.rolling_means(days).orderBy("date").collect()
    assert [r.rolling_7d_avg_generation for r in rows] == [1, 1.5, 2, 2.5, 3, 3.5, 4, 5]
    assert rows[-1].rolling_30d_avg_generation == 4.5


def seed(spark, *kinds):
    return spark.createDataFrame(
        [(k, f"Site {k}", k, 100.0, 30.0, -100.0, "X") for k in kinds], ASSET_SEED
    )


def test_local_flavour(spark):
    gen = generation(
        spark,
        *[(h, "wind", "wind", 2.0 * h, 2.0 * h, 100.0, 1) for h in range(24)],
        *[(h, "gas", "gas", 10.0, 10.0, 100.0, 1) for h in range(2)],
    )
    # No weather for hour 0: its driver counts as 0.
    wx = weather(spark, *[(h, "wind", float(h), 0.0, 10.0, 1) for h in range(1, 24)])
    daily = local.daily_frame_observed_hours(gen, wx)
    by_asset = {r.asset_id: r for r in daily.collect()}
    assert by_asset["gas"].daily_capacity_factor == pytest.approx(0.1)
    assert by_asset["gas"].total_charge_mwh == 0.0 and by_asset["gas"].avg_soc_pct is None
    assert by_asset["wind"].data_completeness_pct == 100.0
    perf = {
        r.asset_id: r
        for r in local.weather_performance_local(gen, wx, seed(spark, "wind", "gas"), daily).collect()
    }
    assert perf["wind"].wind_r_squared == pytest.approx(1.0)
    assert perf["wind"].solar_r_squared is None
    # Only hours expected above 2 % of capacity are scored; all of them are on the line.
    assert perf["wind"].avg_performance_ratio_pct == pytest.approx(100.0)
    # Gas without a reported heat rate counts as running at full load.
    assert perf["gas"].performance_score == pytest.approx(100.0)
    assert perf["gas"].avg_expected_generation_mwh == pytest.approx(10.0)
    assert perf["gas"].rolling_7d_avg_cf == pytest.approx(0.1)


def test_operational_ratio(spark):
    assets = seed(spark, "battery", "gas")
    gen = spark.createDataFrame(
        [
            (T0, "battery", "battery", 5.0, 5.0, 0.0, 99.0, 100.0, 50.0, 0.0, 5.0, None, None, None, 1),
            (T0 + dt.timedelta(hours=1), "battery", "battery", 0.0, -5.0, 0.0, 99.0, 100.0, 50.0, 5.0,
             0.0, None, None, None, 1),
            (T0, "gas", "gas", 5.0, 5.0, 0.0, 99.0, 100.0, None, None, None, 1.0, 13800.0, 1.0, 1),
            (T0 + dt.timedelta(hours=1), "gas", "gas", 0.0, 0.0, 0.0, 99.0, 100.0, None, None, None,
             0.0, 6900.0, 0.0, 1),
        ],
        GENERATION,
    )
    hours = local.hourly_with_driver(gen, weather(spark, (9, "x", 1.0, 1.0, 1.0, 1)), assets)
    got = {
        (r.asset_id, r.timestamp.hour): r.q
        for r in hours.select("asset_id", "timestamp", local.operational_ratio().alias("q")).collect()
    }
    assert got == {("battery", 0): 88.0, ("battery", 1): None, ("gas", 0): 50.0, ("gas", 1): None}


def test_local_labels_do_not_depend_on_the_order_of_a_sum(spark):
    """Exactly 0.3 of capacity and a score of exactly 70, with the hours in every order."""
    nets = [40.0 * (1.0 - 0.02 * 2), 40.0 * (1.0 - 0.02 * 3), -40.0]
    gen = generation(
        spark,
        *[(h, f"B{i}", "battery", 0.0, n, 40.0, 1) for i, p in enumerate(permutations(nets)) for h, n in enumerate(p)],
    )
    days = local.daily_frame_observed_hours(gen, weather(spark, (0, "x", 1.0, 1.0, 1.0, 1))).collect()
    assert len({r.daily_capacity_factor for r in days}) > 1
    assert {r.daily_performance_rating for r in days} == {"Medium"}

    orders = list(enumerate(permutations([702.0, 716.0, 682.0])))
    gas = spark.createDataFrame(
        [
            (T0 + dt.timedelta(hours=h), f"G{i}", "gas", 5.0, 5.0, 0.0, 99.0, 100.0, None, None, None, 1.0,
             6900.0 * 1000 / x, 1.0, 1)
            for i, p in orders for h, x in enumerate(p)
        ],
        GENERATION,
    )
    plants = spark.createDataFrame([(f"G{i}", "S", "gas", 100.0, 30.0, -100.0, "X") for i, _ in orders], ASSET_SEED)
    wx = weather(spark, (0, "x", 1.0, 1.0, 1.0, 1))
    scored = local.weather_performance_local(gas, wx, plants, local.daily_frame_observed_hours(gas, wx)).collect()
    assert len({r.performance_score for r in scored}) > 1
    assert {r.performance_category for r in scored} == {"Fair"}


def test_local_flavour_day_with_nothing_scored_is_poor(spark):
    gen = generation(spark, (0, "wind", "wind", 0.5, 0.5, 100.0, 1), (1, "wind", "wind", 0.6, 0.6, 100.0, 1))
    wx = weather(spark, (0, "wind", 1.0, 0.0, 1.0, 1), (1, "wind", 1.1, 0.0, 1.0, 1))
    daily = local.daily_frame_observed_hours(gen, wx)
    row = local.weather_performance_local(gen, wx, seed(spark, "wind"), daily).first()
    assert row.performance_score is None and row.performance_category == "Poor"
