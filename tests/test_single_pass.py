"""Reports and figures that take one pass: during a write, in one shuffle, over grouping sets."""

import pytest
from plan_text import physical_plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.operators import kpis, quality
from voltseries.sources import contracts, tables

CONTRACT = T.StructType(
    [T.StructField("k", T.StringType(), False), T.StructField("v", T.DoubleType(), True)]
)
RULES = (quality.accepted_range("v", 0, 10), quality.not_null("v", severity="warn"), quality.accepted_values("k", ["a", "b"]))


@pytest.fixture
def rows(spark):
    data = [("a", 1.0), ("a", 11.0), ("b", None), ("c", 3.0), ("c", -1.0)]
    return spark.createDataFrame(data, "k string, v double").repartition(3)


def test_write_and_report_in_one_job(spark, rows, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def touched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    path = str(tmp_path / "t")
    counted = rows.mapInArrow(touched, rows.schema)
    report = {r["rule"]: (r["failures"], r["status"]) for r in contracts.write_with_contract(counted, CONTRACT, path, RULES).collect()}
    assert report == {
        "not_null:k": (0, "pass"), "accepted_range:v": (2, "fail"), "not_null:v": (1, "warn"), "accepted_values:k": (2, "fail"),
    }
    assert seen.value == 5  # each row computed once
    assert tables.current_table(spark, path).count() == 5
    plain = {r["rule"]: r["failures"] for r in quality.rule_report(rows, RULES).collect()}
    assert plain == {k: v[0] for k, v in report.items() if k != "not_null:k"}


def test_missing_values_keep_the_old_version(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    contracts.write_with_contract(rows, CONTRACT, path)
    broken = rows.withColumn("k", F.when(F.col("v") > 0, F.col("k")))
    with pytest.raises(contracts.ContractError, match="k: 2 NULLs"):
        contracts.write_with_contract(broken, CONTRACT, path)
    assert tables.current_table(spark, path).filter("k IS NULL").count() == 0
    contracts.write_with_contract(rows.limit(0), CONTRACT, path)
    assert tables.current_table(spark, path).count() == 0


KEYED = (quality.unique("k"), quality.unique("k", "v", severity="warn"), quality.unique("v"), quality.unique("n"))


@pytest.fixture
def keyed(spark):
    data = [("a", 0.0, 1), ("a", -0.0, 2), ("a", 1.0, 3), (None, 1.0, 4), ("b", None, 5), ("b", None, 6), ("a,", 2.0, 7)]
    return spark.createDataFrame(data, "k string, v double, n int").repartition(3)


def test_all_uniqueness_rules_in_one_shuffle(keyed):
    found = {r["rule"]: (r["failures"], r["n_records"], r["largest"], r["status"]) for r in quality.unique_report(keyed, KEYED).collect()}
    assert found == {
        "unique:k": (2, 5, 3, "fail"), "unique:k,v": (1, 2, 2, "warn"), "unique:v": (2, 4, 2, "fail"), "unique:n": (0, 0, 0, "pass"),
    }
    plan = physical_plan(quality.repeated_keys(keyed, KEYED))
    assert plan.count("Exchange hashpartitioning") == 1
    for rule in KEYED:
        assert quality.unique_violations(keyed, rule.columns).count() == found[rule.name][0]
    report = {r["rule"]: r["failures"] for r in quality.rule_report(keyed, KEYED).collect()}
    assert report == {name: f[0] for name, f in found.items()}


def test_stored_keys_have_their_columns(spark, keyed, tmp_path):
    quality.store_failures(keyed, KEYED, str(tmp_path))
    pairs = spark.read.parquet(str(tmp_path / "unique_k_v"))
    assert pairs.columns == ["k", "v", "n_records"]
    assert [tuple(r) for r in pairs.collect()] == [("a", 0.0, 2)]
    assert spark.read.parquet(str(tmp_path / "unique_n")).count() == 0


DAILY = (
    "asset_id string, date date, asset_type string, total_net_generation_mwh double, daily_capacity_factor double, "
    "avg_soc_pct double, total_co2_tonnes double, total_discharge_mwh double, total_curtailment_mwh double"
)


@pytest.fixture
def fleet(spark):
    import datetime as dt

    day = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    data = [
        ("w", day[0], "wind", 5.0, 0.5, None, None, None, 0.1), ("w", day[1], "wind", None, None, None, None, None, None),
        ("b", day[0], "battery", -1.0, 0.1, 40.0, None, 3.0, 0.0), ("b", day[1], "battery", 2.0, 0.2, None, None, 1.0, 0.0),
        ("g", day[1], "gas", 7.0, 0.9, None, 2.5, None, 0.0), ("x", day[2], None, 1.0, 0.3, None, 1.0, None, 0.0),
    ]
    daily = spark.createDataFrame(data, DAILY).repartition(2)
    assets = spark.createDataFrame([("w", "wind", "W"), ("b", "battery", "B"), ("g", "gas", "G")], "asset_id string, asset_type string, display_name string")
    return daily, assets


def by(df, key, value="value"):
    return {r[key]: r[value] for r in df.collect()}


def test_figures_equal_their_own_queries(fleet):
    daily, assets = fleet
    found = kpis.figures_by_grouping(daily, assets)
    scope = {s: found.filter(F.col("scope") == s) for s in ("total", "date", "asset", "technology")}
    total = scope["total"].first()
    own = kpis.fleet_totals(daily, assets).first()
    assert (total["net_generation"], total["curtailment"], total["battery_throughput"]) == (
        own["net_generation"], own["curtailment"], own["battery_throughput"],
    )
    assert total["capacity_factor"] == pytest.approx(own["capacity_factor"])
    assert by(scope["date"], "date", "net_generation") == by(kpis.generation_by_date(daily), "date")
    for column, query in (
        ("capacity_factor", kpis.capacity_factor_by_date), ("battery_soc", kpis.battery_soc_by_date),
    ):
        figures = {k: v for k, v in by(scope["date"], "date", column).items() if v is not None}
        assert figures == by(query(daily, assets), "date")
    emissions = by(kpis.emissions_by_date(daily, assets), "date")
    assert {k: v for k, v in by(scope["date"], "date", "gas_emissions").items() if k in emissions} == emissions
    assert by(scope["asset"], "asset_id", "mean_capacity_factor") == by(kpis.asset_bars(daily, assets), "asset_id")
    assert by(scope["technology"], "technology", "net_generation") == by(kpis.type_split(daily, assets), "asset_type")


def test_figures_take_one_scan_and_one_shuffle(spark, fleet, tmp_path):
    daily, assets = fleet
    paths = [str(tmp_path / n) for n in ("daily", "assets")]
    for df, path in zip((daily, assets), paths, strict=True):
        df.write.parquet(path)
    plan = physical_plan(kpis.figures_by_grouping(*[spark.read.parquet(p) for p in paths]))
    assert plan.count("FileScan parquet") == 2  # one of the daily rows, one of the dimension
    assert plan.count("Exchange hashpartitioning") == 1
    assert kpis.figures_by_grouping(daily.limit(0), assets).count() <= 1
