import math
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.operators import timeseries as ts

STATS = ["mean", "std", "min", "max"]


def series(spark, n=420, seed=1, offset=0.0):
    rng = random.Random(seed)
    rows = []
    for key in ("a", "b"):
        for i in range(n if key == "a" else n // 3):
            x = None if rng.random() < 0.004 else offset + rng.choice((rng.gauss(0, 1), 3.0))
            rows.append((key, i, x, None if rng.random() < 0.004 else offset + rng.gauss(0, 2)))
    rng.shuffle(rows)
    schema = "k string, t int, x double, y double"
    return spark.createDataFrame(rows, schema).repartition(3)


def same(left, right, digits=1e-9):
    keys = ["k", "t"]
    one = {tuple(r[c] for c in keys): r for r in left.collect()}
    two = {tuple(r[c] for c in keys): r for r in right.collect()}
    assert left.columns == right.columns and one.keys() == two.keys()
    filled = 0
    for key, row in one.items():
        for a, b in zip(row, two[key], strict=True):
            if isinstance(a, float):
                filled += 1
                assert b == pytest.approx(a, rel=digits, abs=digits), key
            else:
                assert a == b, key
    return filled


@pytest.mark.parametrize(("keys", "block"), [("k", None), ("k", 50), (None, 70), (None, None)])
@pytest.mark.parametrize("size", [1, 2, 7, 60])
def test_equals_plain_frames(spark, monkeypatch, keys, block, size):
    df = series(spark)
    order = ["t"] if keys else ["k", "t"]
    plain = ts.add_rolling_stats(df, "x", [3, size], STATS, keys, order_by=order, block_rows=block)
    monkeypatch.setattr(ts, "LONG_FRAME", 0)
    merged = ts.add_rolling_stats(df, "x", [3, size], STATS, keys, order_by=order, block_rows=block)
    assert same(plain, merged) > 200


@pytest.mark.parametrize(("keys", "block"), [("k", None), (None, 40)])
def test_correlation_equals_plain_frames(spark, monkeypatch, keys, block):
    df = series(spark, seed=5)
    order = ["t"] if keys else ["k", "t"]
    plain = ts.calculate_correlation(df, "x", "y", 30, keys, order_by=order, block_rows=block)
    monkeypatch.setattr(ts, "LONG_FRAME", 5)
    merged = ts.calculate_correlation(df, "x", "y", 30, keys, order_by=order, block_rows=block)
    assert same(plain, merged) > 200


def test_large_offsets_do_not_cancel(spark, monkeypatch):
    """Running totals would lose the deviation here; merged parts keep it."""
    monkeypatch.setattr(ts, "LONG_FRAME", 5)
    rows = [("a", i, 1e9 + (i % 2), 0.0) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, x double, y double")
    found = ts.add_rolling_stats(df, "x", [100], ["std"], "k", order_by="t").filter("t >= 99").collect()
    want = math.sqrt(100 * 0.25 / 99)
    assert all(r["x_rolling_std_100"] == pytest.approx(want, rel=1e-6) for r in found)


def test_constants_short_series_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(ts, "LONG_FRAME", 2)
    rows = [("a", i, 0.1, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, t int, x double, y double")
    found = ts.add_rolling_stats(df, "x", [5, 20], ["std"], "k", order_by="t").orderBy("t").collect()
    assert [r["x_rolling_std_5"] for r in found] == [None] * 4 + [0.0] * 5
    assert {r["x_rolling_std_20"] for r in found} == {None}
    corr = ts.calculate_correlation(df, "x", "y", 5, "k", order_by="t").collect()
    assert {r["corr_x_y_rolling_5"] for r in corr} == {None}
    assert ts.add_rolling_stats(df.limit(0), "x", [5], STATS, order_by="t").count() == 0


def test_no_frame_is_recomputed_per_row(spark):
    """All windows grow from the start of their partition, or fetch one row."""
    from plan_text import physical_plan

    df = spark.createDataFrame([("a", 1, 1.0, 1.0)], T.StructType.fromDDL("k string, t int, x double, y double"))
    plan = physical_plan(ts.add_rolling_stats(df.withColumn("x", F.col("x")), "x", [8760], STATS, "k", order_by="t"))
    frames = re.findall(r"RowFrame, ([^,]+), ([^)\s]+)\)", plan)
    assert {(a, b) for a, b in frames if a == "-8759"} == {("-8759", "-8759")}
    assert {a for a, _ in frames} == {"-8759", "unboundedpreceding$()"}
