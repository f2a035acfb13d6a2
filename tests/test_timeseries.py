import datetime as dt
import random

import pytest
from plan_text import physical_plan
from pyspark.sql import functions as F

from voltseries.operators import timeseries as ts
from voltseries.operators.ordering import rank_share, with_position


def series(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def column(df, name, order="i"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_lag_and_lead(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0])
    lagged = ts.add_lag_features(df, "x", [1, 2], order_by="i")
    assert column(lagged, "x_lag_1") == [None, 1, 2, 3]
    assert column(lagged, "x_lag_2") == [None, None, 1, 2]
    leading = ts.add_lead_features(df, "x", [1, 2], order_by="i")
    assert column(leading, "x_lead_1") == [2, 3, 4, None]
    assert column(leading, "x_lead_2") == [3, 4, None, None]


def test_lag_stays_inside_its_series(spark):
    df = spark.createDataFrame(
        [(0, "a", 1), (1, "a", 2), (2, "b", 10), (3, "b", 11)], "i int, k string, x int"
    )
    lagged = ts.add_lag_features(df, "x", [1], "k", order_by="i")
    assert column(lagged, "x_lag_1") == [None, 1, None, 10]


def test_rolling_needs_a_full_frame_without_nulls(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0])
    rolled = ts.add_rolling_stats(df, "x", [2], order_by="i")
    assert column(rolled, "x_rolling_mean_2") == [None, 1.5, 2.5, 3.5]
    assert column(rolled, "x_rolling_std_2")[1] == pytest.approx(0.5**0.5)
    gap = ts.add_rolling_stats(series(spark, [1.0, None, 3.0, 4.0]), "x", [2], order_by="i")
    assert column(gap, "x_rolling_mean_2") == [None, None, None, 3.5]


def test_unknown_statistic_is_skipped(spark):
    df = series(spark, [1.0, 2.0, 3.0])
    assert ts.add_rolling_stats(df, "x", [2], ["mean", "bogus"], order_by="i").columns == [
        "i", "x", "x_rolling_mean_2",
    ]
    assert ts.add_rolling_stats(df, "x", [2], ["bogus"], order_by="i").columns == ["i", "x"]


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "a double, b double")
    assert ts.calculate_correlation(df, "a", "b").first()["corr_a_b"] == pytest.approx(1.0)
    two = spark.createDataFrame(
        [("u", 1.0, 1.0), ("u", 2.0, 2.0), ("d", 1.0, 2.0), ("d", 2.0, 1.0)],
        "k string, a double, b double",
    )
    got = {r.k: r.corr_a_b for r in ts.calculate_correlation(two, "a", "b", partition_by="k").collect()}
    assert got == pytest.approx({"u": 1.0, "d": -1.0})


def test_rolling_correlation(spark):
    rows = [(0, 1.0, 1.0), (1, 2.0, 2.0), (2, 3.0, 1.0), (3, 4.0, None), (4, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    got = column(ts.calculate_correlation(df, "a", "b", 2, order_by="i"), "corr_a_b_rolling_2")
    assert got == [None, pytest.approx(1.0), pytest.approx(-1.0), None, None]
    with pytest.raises(ValueError):
        ts.calculate_correlation(df, "a", "b", 2)


def test_time_features(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2023-01-01 13:00:00' AS timestamp")
    row = ts.add_time_features(df).first()
    assert (row.hour, row.day, row.month, row.quarter, row.year) == (13, 1, 1, 1, 2023)
    assert row.day_of_week == 7  # a Sunday


def test_capacity_factor(spark):
    df = spark.createDataFrame([(50.0, 100.0), (1.0, 0.0)], "g double, c double")
    got = ts.calculate_capacity_factor(df, "g", "c", 2.0)
    assert [r.capacity_factor for r in got.collect()] == [0.25, None]


def test_date_range_is_inclusive_and_prunes(spark, tmp_path):
    rows = [(dt.datetime(2023, 1, d), d) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, x int")
    pick = lambda **kw: sorted(r.x for r in ts.filter_by_date_range(df, **kw).collect())
    assert pick(start_date="2023-01-02", end_date="2023-01-03") == [2, 3]
    assert pick(start_date="2023-01-02") == [2, 3]
    assert pick(end_date="2023-01-02") == [1, 2]
    assert pick() == [1, 2, 3]
    path = str(tmp_path / "t")
    df.withColumn("date", F.to_date("timestamp")).write.partitionBy("date").parquet(path)
    stored = spark.read.parquet(path)
    plan = physical_plan(
        ts.filter_by_date_range(stored, start_date="2023-01-02", partition_col="date")
    )
    assert "PartitionFilters: [isnotnull(date" in plan


@pytest.mark.parametrize("block_rows", [1, 3, 7, 1000])
def test_blocks_equal_a_plain_window(spark, block_rows):
    """One key holds most rows; the blocks must not show in the result."""
    rng = random.Random(block_rows)
    rows = [
        (i, "hot" if rng.random() < 0.7 else rng.choice("abc"),
         None if rng.random() < 0.1 else rng.random(), rng.random())
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "i int, k string, x double, y double").repartition(5)

    def features(**kw):
        out = ts.add_lag_features(df, "x", [1, 4], order_by="i", **kw)
        out = ts.add_lead_features(out, "x", [2], order_by="i", **kw)
        out = ts.add_rolling_stats(out, "x", [3], ["mean", "min", "max"], order_by="i", **kw)
        return ts.calculate_correlation(out, "x", "y", 5, order_by="i", **kw)

    plain = features(partition_by="k").orderBy("i").toPandas()
    split = features(partition_by="k", block_rows=block_rows).orderBy("i").toPandas()
    assert list(plain.columns) == list(split.columns)
    assert len(split) == 300
    for name in plain.columns:
        if plain[name].dtype == object:
            assert list(plain[name]) == list(split[name])
        else:
            assert plain[name].isna().equals(split[name].isna())
            assert (plain[name] - split[name]).abs().max() < 1e-12 or plain[name].isna().all()


def test_positions_with_one_value_for_most_rows(spark):
    rows = [(7.0 if i % 3 else float(i), i) for i in range(600)]
    df = spark.createDataFrame(rows, "x double, i int").repartition(6)
    got = [r.i for r in with_position(df, ["x", "i"], "p", ranges=5).orderBy("p").collect()]
    assert got == [i for _, i in sorted(rows)]
    places = [r.p for r in with_position(df, ["x", "i"], "p", ranges=5).orderBy("p").collect()]
    assert places == list(range(600))


def test_rank_share(spark):
    df = spark.createDataFrame([(30.0, 1), (10.0, 2), (20.0, 3), (20.0, 4)], "x double, i int")
    got = {r.i: r.rank_signal for r in rank_share(df, "x", ["i"]).collect()}
    assert got == pytest.approx({2: 0.0, 3: 1 / 3, 4: 2 / 3, 1: 1.0})
    one = spark.createDataFrame([(5.0, 1)], "x double, i int")
    assert rank_share(one, "x", ["i"]).first().rank_signal == 0.0
