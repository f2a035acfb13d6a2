import math

import pytest
from pyspark.sql import functions as F

from voltseries.functions import engineering as eng
from voltseries.plans import fleet_balance


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def d(x):
    return F.lit(x).cast("double")


def wind(spark, speed, capacity=100.0):
    p = {k: d(v) for k, v in eng.WIND_DEFAULTS.items()}
    return value(spark, eng.wind_output(d(speed), d(15.0), d(1013.25), d(capacity), p["cut_in_mps"],
                                        p["rated_mps"], p["cut_out_mps"], p["wake_loss"],
                                        p["availability"]))


def solar(spark, ghi, temperature=25.0, cloud=0.0, capacity=50.0):
    p = {k: d(v) for k, v in eng.SOLAR_DEFAULTS.items()}
    return value(spark, eng.solar_output(d(ghi), d(temperature), d(cloud), d(capacity), p["noct_c"],
                                         p["temp_coeff_per_c"], p["dc_ac_ratio"],
                                         p["system_derate"]))


def test_density_at_standard_conditions(spark):
    assert value(spark, eng.air_density(d(15.0), d(1013.25))) == pytest.approx(1.225, abs=0.01)
    cold = value(spark, eng.air_density(d(-10.0), d(1013.25)))
    assert cold > value(spark, eng.air_density(d(30.0), d(1013.25)))


def test_wind_curve(spark):
    assert wind(spark, 2.0) == 0 and wind(spark, 30.0) == 0
    assert wind(spark, 15.0) == pytest.approx(85.5, rel=0.01)
    assert wind(spark, -1.0) == 0 and wind(spark, None) is None
    ramp = [wind(spark, s) for s in (4.0, 6.0, 8.0, 10.0)]
    assert all(a < b for a, b in zip(ramp, ramp[1:], strict=False))


def test_solar_curve(spark):
    assert solar(spark, 0.0) == 0
    assert solar(spark, 2000.0) == pytest.approx(50.0)
    assert solar(spark, 600.0, temperature=40.0) < solar(spark, 600.0, temperature=5.0)
    assert solar(spark, 600.0, cloud=50.0) < solar(spark, 600.0)
    assert solar(spark, None) is None


def test_gas_part_load(spark):
    rate = lambda out: value(
        spark, eng.part_load_heat_rate(d(out), d(100.0), d(6900.0), d(0.9), d(0.1))
    )
    assert rate(100.0) == pytest.approx(6900.0)
    assert rate(50.0) == pytest.approx(6900 * 1.1)
    assert rate(0.0) == 6900.0
    fuel = value(spark, eng.fuel_mmbtu(d(100.0), d(6900.0)))
    assert fuel == pytest.approx(690.0)
    assert value(spark, eng.co2_tonnes(d(fuel))) == pytest.approx(690 * 0.05306)


def test_clear_sky(spark):
    ghi = lambda lat, day, hour: value(spark, eng.clear_sky_ghi(d(lat), d(day), d(hour)))
    assert ghi(35.0, 172.0, 0.0) == 0.0
    assert ghi(35.0, 172.0, 12.0) > ghi(35.0, 355.0, 12.0) > 0
    assert ghi(35.0, 172.0, 12.0) <= eng.CLEAR_SKY_PEAK


def test_demand(spark):
    got = value(spark, eng.demand_mw(d(23.0), d(15.0), d(100.0)))
    assert got == pytest.approx(100 * (0.72 + 0.2 * math.sin(math.pi / 2)) * 1.12)


def test_curtailment_is_shared_in_proportion(spark):
    hour = "TIMESTAMP_NTZ '2023-01-01 00:00:00'"
    potential = spark.sql(
        f"SELECT 'a' AS asset_id, {hour} AS timestamp, 30D AS potential_mwh "
        f"UNION ALL SELECT 'b', {hour}, 10D"
    )
    balance = spark.sql(f"SELECT {hour} AS timestamp, 40D AS renewable_mw, 20D AS demand_mw")
    got = {r.asset_id: (r.curtailment_mwh, r.net_generation_mwh)
           for r in fleet_balance.allocate_curtailment(potential, balance).collect()}
    assert got == {"a": (15.0, 15.0), "b": (5.0, 5.0)}
    calm = spark.sql(f"SELECT {hour} AS timestamp, 0D AS renewable_mw, 20D AS demand_mw")
    assert {r.curtail_share for r in fleet_balance.allocate_curtailment(potential, calm).collect()} == {0.0}


def test_demand_scale_of_an_empty_supply(spark):
    fleet = spark.sql("SELECT 'battery' AS asset_type, 100D AS capacity_mw")
    assert fleet_balance.demand_scale(fleet).first().scale_mw == pytest.approx(0.55)
