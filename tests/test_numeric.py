import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from voltseries.functions.numeric import (
    capacity_factor,
    clamp,
    linear_fit,
    round_dec,
    safe_corr,
    safe_intercept,
    safe_slope,
    without_noise,
)


def expected_round(x, digits):
    if x is None or math.isnan(x) or math.isinf(x):
        return None
    twelve = Decimal(repr(x)).quantize(Decimal("1e-12"), ROUND_HALF_UP)
    return float(twelve.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0


@pytest.mark.parametrize("digits", [1, 2, 4, 6])
def test_round_agrees_with_decimal(spark, digits):
    rng = random.Random(digits)
    values = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1.005, 2.675, -1.005, 0.5, -0.5]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 12) for _ in range(3000)]
    # Ties, ties with the noise of a sum, and near-ties.
    ties = [(2 * rng.randint(-(10**6), 10**6) + 1) * 0.5 * 10.0**-digits for _ in range(1500)]
    values += ties + [t + 1e-14 for t in ties] + [t - 1e-9 for t in ties] + [t * 3 / 3 for t in ties]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    rows = df.select(
        "x", round_dec("x", digits).alias("text"), round_dec(F.col("x"), digits).alias("column")
    ).collect()
    for row in rows:
        want = expected_round(row.x, digits)
        assert row.text == want and row.column == want, row
        if want == 0:
            assert math.copysign(1, row.text) == 1


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,), (500.0,)], "x double")
    assert [r[0] for r in df.select(clamp("x", 0, 100)).collect()] == [None, 0, 50, 100]
    assert [r[0] for r in df.select(clamp("x", low=0)).collect()] == [None, 0, 50, 500]


def test_capacity_factor_of_zero_capacity(spark):
    df = spark.createDataFrame([(50.0, 0.0), (50.0, 100.0), (None, 100.0)], "g double, c double")
    assert [r[0] for r in df.select(capacity_factor("g", "c", 2.0)).collect()] == [None, 0.25, None]


def test_correlation_of_constant_input_is_null(spark):
    df = spark.createDataFrame(
        [("flat", 1.0, 5.0), ("flat", 2.0, 5.0), ("one", 1.0, 1.0), ("up", 1.0, 2.0),
         ("up", 2.0, 4.0), ("up", 3.0, None), ("nan", 1.0, 2.0), ("nan", float("nan"), 3.0)],
        "k string, x double, y double",
    )
    got = {
        r.k: (r.c, r.s, r.i)
        for r in df.groupBy("k")
        .agg(
            safe_corr("x", "y").alias("c"),
            safe_slope("x", "y").alias("s"),
            safe_intercept("x", "y").alias("i"),
        )
        .collect()
    }
    assert got["flat"] == (None, None, None)
    assert got["one"] == (None, None, None)
    assert got["up"] == pytest.approx((1.0, 0.5, 0.0))
    assert got["nan"][0] is None


def fit(spark, rows):
    df = spark.createDataFrame(rows, "t int, x double, y double")
    aggregates = linear_fit("x", "y", "t")
    row = df.agg(*[c.alias(n) for n, c in aggregates.items()]).first()
    return row.slope, row.intercept, row.r2


def test_linear_fit(spark):
    assert fit(spark, [(1, 1.0, 3.0), (2, 2.0, 5.0), (3, 3.0, 7.0)]) == pytest.approx((2, 1, 1))
    # One point, a constant x, and an x that is constant within tolerance: the mean of y.
    assert fit(spark, [(1, 1.0, 3.0)]) == (0, 3, 0)
    assert fit(spark, [(1, 4.0, 3.0), (2, 4.0, 5.0)]) == (0, 4, 0)
    assert fit(spark, [(1, 4.0, 3.0), (2, 4.00002, 5.0)]) == (0, 4, 0)
    # No points at all.
    assert fit(spark, [(1, None, 3.0)]) == (0, 0, 0)
    # A constant y has no explained share.
    assert fit(spark, [(1, 1.0, 3.0), (2, 2.0, 3.0)]) == pytest.approx((0, 3, 0))


@pytest.mark.parametrize("value", [1e27, -3.5e300, 1.7e308, 4.6e15])
def test_large_finite_values_round_to_themselves(spark, value):
    row = spark.createDataFrame([(value,)], "x double").select(
        round_dec("x", 4).alias("a"), round_dec(F.col("x"), 4).alias("b")
    ).first()
    assert (row.a, row.b) == (value, value)


def test_noise_is_dropped_and_odd_values_stay(spark):
    values = [0.29999999999999993, 0.30000000000000004, 94.99999999999999, 0.2999999999, 1e30, math.inf, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate([*values, math.nan])], "i int, v double")
    got = [r.w for r in frame.select("i", without_noise("v").alias("w")).orderBy("i").collect()]
    assert got[:-1] == [0.3, 0.3, 95.0, 0.2999999999, 1e30, math.inf, None] and math.isnan(got[-1])
