import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltseries.operators import kpis, metrics
from voltseries.operators.joins import align_to_hours, select_assets, with_technology
from voltseries.sources.tables import day_spine, day_spine_of

DAILY = (
    "asset_id string, date date, asset_type string, total_net_generation_mwh double, "
    "daily_capacity_factor double, total_curtailment_mwh double, total_discharge_mwh double, "
    "avg_soc_pct double, total_co2_tonnes double"
)
D1, D2 = dt.date(2026, 4, 1), dt.date(2026, 4, 2)


@pytest.fixture(scope="module")
def daily(spark):
    """Rows without a technology of their own: the dimension supplies it."""
    return spark.createDataFrame(
        [
            ("W1", D1, "", 800.0, 0.33, 10.0, 0.0, None, 0.0),
            ("W1", D2, "", 900.0, 0.38, 20.0, 0.0, None, 0.0),
            ("S1", D1, None, 300.0, 0.25, 5.0, 0.0, None, 0.0),
            ("S1", D2, None, 320.0, 0.27, 5.0, 0.0, None, 0.0),
        ],
        DAILY,
    )


@pytest.fixture(scope="module")
def mixed(spark, daily):
    more = spark.createDataFrame(
        [
            ("B1", D1, "battery", -20.0, -0.01, 0.0, 40.0, 55.0, 0.0),
            ("B1", D2, "battery", 10.0, 0.01, 0.0, 60.0, None, None),
            ("G1", D1, "gas", 500.0, 0.5, 0.0, None, None, 200.0),
            ("X9", D2, "", -7.0, None, None, None, None, None),
        ],
        DAILY,
    )
    return daily.unionByName(more)


@pytest.fixture(scope="module")
def assets(spark):
    return spark.createDataFrame(
        [
            ("W1", "Ridge (100 MW wind)", "wind", 100.0, "ERCOT"),
            ("S1", "Flats (50 MW solar)", "solar", 50.0, ""),
            ("B1", "Cells (60 MW battery)", "battery", 60.0, "CAISO"),
            ("N1", None, "gas", None, None),
        ],
        "asset_id string, display_name string, asset_type string, capacity_mw double, region string",
    )


def pairs(df):
    return [(r.date, r.value) for r in df.orderBy("date").collect()]


def test_kpis_of_two_assets(spark, daily, assets):
    got = {r.key: (r.value, r.display) for r in kpis.fleet_kpis(daily, assets).collect()}
    assert got["net_generation"] == (2320.0, "2,320")
    assert got["capacity_factor"][0] == pytest.approx(0.3075)
    assert got["capacity_factor"][1] == "30.8%"
    assert got["renewable_share"] == (100.0, "100%")
    assert got["curtailment"] == (40.0, "40")
    solar = select_assets(daily, assets, "solar")
    assert kpis.fleet_totals(solar, assets).first().net_generation == 620.0


def test_kpis_of_a_mixed_fleet(spark, mixed, assets):
    row = kpis.fleet_totals(mixed, assets).first()
    assert row.net_generation == pytest.approx(2320 - 20 + 10 + 500 - 7)
    assert row.capacity_factor == pytest.approx((0.33 + 0.38 + 0.25 + 0.27 + 0.5) / 5)
    assert row.renewable_share == pytest.approx(2320 / 2820 * 100)
    assert (row.co2_emissions, row.battery_throughput) == (200.0, 100.0)


def test_kpis_of_nothing(spark, daily, assets):
    row = kpis.fleet_totals(daily.filter("date > '2030-01-01'"), assets).first()
    assert set(row) == {0.0}


def test_series(spark, mixed, assets):
    assert pairs(kpis.generation_by_date(mixed)) == [(D1, 1580.0), (D2, 1223.0)]
    assert pairs(kpis.capacity_factor_by_date(mixed, assets)) == [
        (D1, pytest.approx((0.33 + 0.25 + 0.5) / 3)), (D2, pytest.approx((0.38 + 0.27) / 2))
    ]
    assert pairs(kpis.battery_soc_by_date(mixed, assets)) == [(D1, 55.0)]
    assert pairs(kpis.emissions_by_date(mixed, assets)) == [(D1, 200.0)]
    row = kpis.series_summary(kpis.generation_by_date(mixed)).first()
    assert (row.first_label, row.last_label, row.y_max) == (D1, D2, 1580.0)
    late = select_assets(mixed, start="2030-01-01")
    assert kpis.series_summary(kpis.generation_by_date(late)).count() == 0


def test_scores(spark):
    df = spark.createDataFrame([(D1, 90.0), (D1, None), (D2, 70.0)], "date date, performance_score double")
    assert pairs(kpis.score_by_date(df)) == [(D1, 45.0), (D2, 70.0)]


def test_asset_bars(spark, daily, assets):
    got = {r.asset_id: (r.name, r.asset_type, r.value, r.pct) for r in kpis.asset_bars(daily, assets).collect()}
    assert got["W1"] == ("Ridge (100 MW wind)", "wind", pytest.approx(0.355), pytest.approx(100.0))
    assert got["S1"][2:] == (pytest.approx(0.26), pytest.approx(0.26 / 0.355 * 100))


def test_bars_have_a_floor_and_a_zero(spark, daily, assets):
    tiny = daily.withColumn(
        "daily_capacity_factor", F.when(F.col("asset_id") == "W1", 1.0).otherwise(0.0)
    )
    assert {r.asset_id: r.pct for r in kpis.asset_bars(tiny, assets).collect()} == {"W1": 100.0, "S1": 1.5}
    none = daily.withColumn("daily_capacity_factor", F.lit(0.0))
    assert {r.pct for r in kpis.asset_bars(none, assets).collect()} == {0.0}


def test_type_split(spark, daily, mixed, assets):
    got = {r.asset_type: r.value for r in kpis.type_split(daily, assets).collect()}
    assert got == {"wind": 1700.0, "solar": 620.0}
    assert {r.asset_type for r in kpis.type_split(mixed, assets).collect()} == {
        "wind", "solar", "battery", "gas", "unknown",
    }


def test_mix_is_dense_and_stacked(spark, mixed, assets):
    mix = kpis.generation_mix(mixed, assets)
    got = {(r.date, r.asset_type): r.value for r in mix.collect()}
    assert got == {
        (D1, "wind"): 800.0, (D1, "solar"): 300.0, (D1, "gas"): 500.0, (D1, "battery"): 40.0,
        (D2, "wind"): 900.0, (D2, "solar"): 320.0, (D2, "gas"): 0.0, (D2, "battery"): 60.0,
    }
    bands = {(r.date, r.asset_type): (r.lower, r.upper) for r in kpis.cumulative_mix(mix).collect()}
    assert bands[(D1, "wind")] == (0.0, 800.0)
    assert bands[(D1, "battery")] == (1600.0, 1640.0)


def test_mix_drops_technologies_that_produce_nothing(spark, daily, assets):
    assert {r.asset_type for r in kpis.generation_mix(daily, assets).collect()} == {"wind", "solar"}


def test_roster_keeps_assets_without_rows(spark, daily, assets):
    got = {r.asset_id: r for r in kpis.fleet_roster(daily, assets).collect()}
    assert got["W1"].net_generation_mwh == 1700.0
    assert got["S1"].region == "—"
    assert (got["N1"].name, got["N1"].capacity_mw, got["N1"].capacity_factor) == ("N1", 0.0, 0.0)
    assert "B1" in got


def test_lookup_prefers_the_rows_own_technology(spark, mixed, assets):
    got = {r.asset_id: r.technology for r in with_technology(mixed, assets, "unknown").collect()}
    assert got == {"W1": "wind", "S1": "solar", "B1": "battery", "G1": "gas", "X9": "unknown"}


def test_select_assets(spark, mixed, assets):
    assert select_assets(mixed, asset_ids=["W1"], start="2026-04-02").count() == 1
    assert select_assets(mixed, end="2026-04-01").count() == 4
    with pytest.raises(ValueError):
        select_assets(mixed, technology="wind")


def test_align_to_hours(spark):
    t = lambda h: dt.datetime(2023, 1, 1, h)
    rows = spark.createDataFrame(
        [("a", t(0), 1.0), ("b", t(3), 2.0), ("a", t(3), None)],
        "asset_id string, timestamp timestamp_ntz, v double",
    )
    fleet = spark.createDataFrame([("a",), ("b",)], "asset_id string")
    got = {(r.asset_id, r.timestamp.hour): r.v for r in align_to_hours(rows, fleet, "v").collect()}
    # Hours 1 and 2 occur nowhere and stay out.
    assert got == {("a", 0): 1.0, ("a", 3): 0.0, ("b", 0): 0.0, ("b", 3): 2.0}


# --- metrics -----------------------------------------------------------------


def test_align_keeps_timestamps_off_the_hour(spark):
    at = lambda h, m: dt.datetime(2023, 1, 1, h, m)
    rows = spark.createDataFrame(
        [("a", at(0, 0), 1.0), ("a", at(0, 30), 2.0), ("b", at(5, 0), 3.0)],
        "asset_id string, timestamp timestamp_ntz, v double",
    )
    fleet = spark.createDataFrame([("a",), ("b",)], "asset_id string")
    got = {(r.asset_id, r.timestamp): r.v for r in align_to_hours(rows, fleet, "v").collect()}
    assert len(got) == 6 and got["a", at(0, 30)] == 2.0 and got["b", at(0, 30)] == 0.0
    inside = align_to_hours(rows, fleet, "v", start="2023-01-01 00:00:00", end="2023-01-01 05:00:00")
    assert inside.count() == 6
    with pytest.raises(Exception, match="outside the hour range"):
        align_to_hours(rows, fleet, "v", end="2023-01-01 04:00:00").collect()
    lost = rows.unionByName(spark.createDataFrame([("a", None, 1.0)], rows.schema))
    with pytest.raises(Exception, match="null or outside"):
        align_to_hours(lost, fleet, "v").collect()


@pytest.fixture(scope="module")
def marts(spark):
    daily = spark.createDataFrame(
        [("a", D1, "Large", "High", 10.0, 0.5), ("b", D1, "Small", "Low", 30.0, 0.1),
         ("a", dt.date(2026, 4, 6), "Large", "Low", 5.0, None)],
        "asset_id string, date date, asset_size_category string, daily_performance_rating string, "
        "total_net_generation_mwh double, daily_capacity_factor double",
    )
    weather = spark.createDataFrame(
        [("a", D1, "wind", "Good", 90.0), ("b", D1, "gas", "Poor", 50.0)],
        "asset_id string, date date, inferred_asset_type string, performance_category string, "
        "performance_score double",
    )
    return {"mart_asset_performance_daily": daily, "mart_asset_weather_performance": weather}


def test_metric_grains_and_dimensions(spark, marts):
    total = metrics.query_metric(marts, "daily_generation").first()
    assert total.daily_generation == 45.0
    weekly = metrics.query_metric(marts, "daily_generation", ["asset_size_category"], "week")
    assert {(str(r.date), r.asset_size_category, r.daily_generation) for r in weekly.collect()} == {
        ("2026-03-30", "Large", 10.0), ("2026-03-30", "Small", 30.0), ("2026-04-06", "Large", 5.0),
    }
    monthly = metrics.query_metric(marts, "generation_efficiency", grain="month")
    assert [(str(r.date), r.generation_efficiency) for r in monthly.collect()] == [
        ("2026-04-01", pytest.approx(0.3))
    ]
    scores = metrics.query_metric(
        marts, "weather_adjusted_score", ["weather_asset"], "day", "inferred_asset_type = 'wind'"
    )
    assert [(r.weather_asset, r.weather_date, r.weather_adjusted_score) for r in scores.collect()] == [
        ("a", D1, 90.0)
    ]


def test_several_metrics_in_one_pass(spark, marts):
    row = metrics.query_metric(marts, ["daily_generation", "avg_capacity_factor"]).first()
    assert (row.daily_generation, row.avg_capacity_factor) == (45.0, pytest.approx(0.3))
    with pytest.raises(KeyError):
        metrics.query_metric(marts, ["daily_generation", "weather_adjusted_score"])


def test_unknown_names_are_refused(spark, marts):
    with pytest.raises(KeyError):
        metrics.query_metric(marts, "bogus")
    with pytest.raises(KeyError):
        metrics.query_metric(marts, "daily_generation", ["inferred_asset_type"])
    with pytest.raises(ValueError):
        metrics.query_metric(marts, "daily_generation", grain="decade")


def test_metric_on_spine_has_every_day(spark, marts):
    metric = metrics.query_metric(marts, "daily_generation", grain="day")
    spine = day_spine_of(marts["mart_asset_performance_daily"])
    rows = metrics.on_spine(metric, spine, "date").orderBy("date_day").collect()
    assert [r.daily_generation for r in rows] == [40.0, None, None, None, None, 5.0]


def test_spine_excludes_its_end(spark):
    rows = day_spine("2023-01-01", "2025-12-31", spark).orderBy("date_day").collect()
    assert len(rows) == 1095
    assert (str(rows[0].date_day), str(rows[-1].date_day)) == ("2023-01-01", "2025-12-30")
