import random

import pytest
from plan_text import physical_plan
from pyspark.sql import functions as F

from voltseries.plans import model_state, weather_score

FIELDS = (
    "asset_id string, asset_type string, date date, wind_speed_mps double, ghi double, "
    "net_generation_mwh double, capacity_factor double, asset_capacity_mw double"
)


@pytest.fixture
def hours(spark):
    import datetime as dt

    rng = random.Random(3)
    rows = []
    for asset in range(4):
        for day in range(9):
            for _ in range(rng.randint(1, 24)):
                wind = None if rng.random() < 0.05 else rng.uniform(0, 20)
                net = 1e6 + (wind or 3.0) * 2 + rng.gauss(0, 1)
                sun = 500.0 if asset == 2 else rng.uniform(0, 900)
                rows.append(
                    (f"A{asset}", "wind", dt.date(2024, 1, 1 + day), wind, sun, None if rng.random() < 0.05 else net, net / 2e6, 50.0)
                )
    return spark.createDataFrame(rows, FIELDS).repartition(3)


def rows_of(df):
    return {r["asset_id"]: r.asDict() for r in df.collect()}


def same(left, right):
    assert left.keys() == right.keys()
    for asset, row in left.items():
        for name, value in row.items():
            other = right[asset][name]
            assert other == (pytest.approx(value, rel=1e-6, abs=2e-6) if isinstance(value, float) else value), (asset, name)


def test_three_loads_equal_one_pass(spark, hours, tmp_path):
    path = str(tmp_path / "state")
    for part in range(3):
        model_state.update_state(hours.filter(F.dayofmonth("date") % 3 == part), path)
    found = model_state.models_of(model_state.read_state(spark, path))
    whole = weather_score.asset_models(hours)
    assert set(found.columns) == set(whole.columns)
    same(rows_of(whole), rows_of(found.select(*whole.columns)))
    # An asset under constant sun has no line on it.
    assert rows_of(found)["A2"]["solar_regression_slope"] is None


def test_a_repeated_load_replaces_its_day(spark, hours, tmp_path):
    path = str(tmp_path / "state")
    model_state.update_state(hours, path)
    day = hours.filter("date = '2024-01-04'")
    model_state.update_state(day, path)
    same(rows_of(weather_score.asset_models(hours)), rows_of(model_state.models_of(model_state.read_state(spark, path))))
    # A corrected day changes the models as a full pass would.
    fixed = day.withColumn("wind_speed_mps", F.col("wind_speed_mps") + 1)
    model_state.update_state(fixed, path)
    full = hours.filter("date <> '2024-01-04'").unionByName(fixed)
    same(rows_of(weather_score.asset_models(full)), rows_of(model_state.models_of(model_state.read_state(spark, path))))


def test_models_read_the_state_only(spark, hours, tmp_path):
    path, raw = str(tmp_path / "state"), str(tmp_path / "hours")
    hours.write.partitionBy("date").parquet(raw)
    stored = spark.read.parquet(raw)
    for day in range(1, 10):
        one = stored.filter(F.col("date") == F.lit(f"2024-01-{day:02d}").cast("date"))
        assert "PartitionFilters: [isnotnull(date" in physical_plan(one)
        model_state.update_state(one, path)
    plan = physical_plan(model_state.models_of(model_state.read_state(spark, path)))
    assert raw not in plan and plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_hours(spark, hours, tmp_path):
    path = str(tmp_path / "state")
    model_state.update_state(hours, path)
    model_state.update_state(hours.limit(0), path)
    assert model_state.models_of(model_state.read_state(spark, path)).count() == 4
    assert model_state.models_of(model_state.day_moments(hours.limit(0))).count() == 0
