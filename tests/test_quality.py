import datetime as dt

import pytest

from voltseries.operators import quality

NOW = dt.datetime(2023, 1, 10, 12)


def stamps(spark, *hours):
    return spark.createDataFrame(
        [(dt.datetime(2023, 1, 8) + dt.timedelta(hours=h),) for h in hours],
        "timestamp timestamp_ntz",
    )


def test_freshness(spark):
    fresh = quality.freshness(stamps(spark, 0, 20), NOW).first()
    assert fresh.passed and fresh.reason is None and fresh.threshold_hours == 48
    assert fresh.max_timestamp == dt.datetime(2023, 1, 8, 20)
    # Exactly 48 hours old still passes, one hour more does not.
    assert quality.freshness(stamps(spark, 12), NOW).first().passed
    assert not quality.freshness(stamps(spark, 11), NOW).first().passed
    empty = quality.freshness(stamps(spark), NOW).first()
    assert not empty.passed and empty.reason == "no rows"
    aware = dt.datetime(2023, 1, 10, 13, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert quality.freshness(stamps(spark, 12), aware).first().passed


def test_row_count(spark):
    assert quality.row_count_check(spark.range(100)).first().passed
    row = quality.row_count_check(spark.range(99)).first()
    assert (row.row_count, row.minimum, row.passed) == (99, 100, False)
    assert quality.row_count_check(spark.range(12), 10).first().passed


def test_weather_ranges(spark):
    df = spark.createDataFrame(
        [(0.0, 60.0, 100.0), (50.1, 0.0, 0.0), (1.0, -51.0, 101.0), (None, None, None)],
        "wind_speed_mps double, temperature_c double, relative_humidity double",
    )
    row = quality.weather_range_check(df).first()
    assert (row.out_of_range_rows, row.passed) == (2, False)


def test_generation_ranges_leave_batteries_out(spark):
    df = spark.createDataFrame(
        [("battery", -50.0, -0.5), ("wind", -1.0, 0.0), ("gas", 1.0, 1.01), ("gas", 1.0, 1.0)],
        "asset_type string, net_generation_mwh double, capacity_factor double",
    )
    assert quality.generation_range_check(df).first().out_of_range_rows == 2


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [("a", "wind", 0.5), ("a", "wind", 1.2), ("b", "battery", -0.5), ("c", "coal", -0.1),
         (None, None, None)],
        "asset_id string, asset_type string, cf double",
    )


RULES = (
    quality.not_null("asset_id"),
    quality.accepted_values("asset_type", ["wind", "battery"], severity="warn"),
    quality.accepted_range("cf", 0, 1.1, where="asset_type <> 'battery'"),
    quality.accepted_range("cf", high=1.2, inclusive=False),
    quality.unique("asset_id", severity="warn"),
)


def test_rule_report(spark, mixed):
    got = [(r.rule, r.failures, r.status) for r in quality.rule_report(mixed, RULES).collect()]
    assert sorted(got) == sorted(
        [
            ("not_null:asset_id", 1, "fail"),
            ("accepted_values:asset_type", 1, "warn"),  # NULL is accepted
            ("accepted_range:cf", 2, "fail"),
            ("accepted_range:cf", 1, "fail"),
            ("unique:asset_id", 1, "warn"),  # NULL keys do not count
        ]
    )
    clean = quality.rule_report(mixed.filter("asset_id = 'b'"), RULES).collect()
    assert {r.status for r in clean} == {"pass"}


def test_column_rules_share_one_pass(spark, mixed):
    from plan_text import physical_plan

    rules = [r for r in RULES if isinstance(r, quality.ColumnRule)]
    plan = physical_plan(quality.rule_report(mixed, rules))
    assert plan.count("Exchange") <= 1


def test_failing_rows_are_stored(spark, mixed, tmp_path):
    quality.store_failures(mixed, RULES, str(tmp_path))
    rows = spark.read.parquet(str(tmp_path / "rows")).collect()
    assert {(r.asset_id, tuple(r.failed_rules)) for r in rows} == {
        ("a", ("accepted_range:cf", "accepted_range:cf")),
        ("c", ("accepted_values:asset_type", "accepted_range:cf")),
        (None, ("not_null:asset_id",)),
    }
    keys = spark.read.parquet(str(tmp_path / "unique_asset_id")).collect()
    assert [(r.asset_id, r.n_records) for r in keys] == [("a", 2)]


def test_data_age(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 8),)], "date date")
    row = quality.data_age(df, NOW).first()
    assert (row.days, row.badge) == (2, "data current")
    row = quality.data_age(df, dt.datetime(2023, 1, 11)).first()
    assert (row.days, row.badge) == (3, "data 3 days behind")


def test_unknown_rule_kind(spark):
    with pytest.raises(ValueError):
        quality.ColumnRule("bogus", "x").broken()
