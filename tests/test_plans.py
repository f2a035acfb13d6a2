"""What the physical plans must and must not contain."""

import re

import pytest
from plan_text import physical_plan

from voltseries.catalog import oracle
from voltseries.catalog.queries import QUERIES, Fleet
from voltseries.operators import timeseries as ts

FOLDER = "/root/testdata/sf0.001"

# Queries that store something first; their plans are plain reads.
STORING = {
    "lag_lead_whole_table", "rolling_stats_whole_table", "rolling_stats_split_series",
    "rank_signal", "net_load", "upsert_latest", "parquet_roundtrip", "json_export_roundtrip",
    "weather_json_roundtrip", "assets_json_roundtrip", "flatten_hourly_payload",
    "csv_seed_roundtrip", "contract_checked_mart", "contract_daily_mart", "contract_dim_asset",
    "upsert_weather", "schema_evolution", "stored_failures", "correlation_job_summary",
    "combined_assets", "sorted_series", "rolling_stats_year", "rolling_correlation_month",
    "report_during_write", "asset_models_incremental",
}


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORING))
def test_plan_of_query(spark, name):
    plan = physical_plan(QUERIES[name](Fleet(spark, FOLDER)))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan, bad
    # One task may finish a total over the table, never sort or number its rows.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
            assert "partial_" in lines[i + 1], lines[i + 1]


def test_scan_reads_the_needed_columns(spark):
    plan = physical_plan(Fleet(spark, FOLDER).weather_daily)
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {
        "event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double"
    }
    keys = physical_plan(Fleet(spark, FOLDER).events.select("user_id").filter("user_id > 5"))
    assert "PushedFilters: [IsNotNull(user_id), GreaterThan(user_id,5)]" in keys


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = Fleet(spark, FOLDER).stg_generation.select("asset_id", "timestamp", "date")
    df.write.partitionBy("date").parquet(path)
    plan = physical_plan(
        ts.filter_by_date_range(
            spark.read.parquet(path), "timestamp", "2024-01-05", "2024-01-06",
            partition_col="date",
        )
    )
    assert "(date#" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.fixture()
def static_plans(spark):
    """Plans without runtime re-planning and without broadcasts, as for large inputs."""
    old = {k: spark.conf.get(k) for k in
           ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_join_reuses_the_shuffle_of_the_deduplication(spark, static_plans):
    plan = physical_plan(Fleet(spark, FOLDER).joined)
    assert plan.count("Exchange hashpartitioning") == 2  # one per side, none for the join
    assert plan.count("WindowGroupLimit") == 4  # cut before and after each shuffle


def test_weather_mart_joins_the_hours_once(spark, static_plans):
    fleet = Fleet(spark, FOLDER)
    staged = physical_plan(fleet.joined)
    assert staged.count("Join") == 1
    assert len(re.findall(r"[-*+] Window ", staged)) == 2
    plan = physical_plan(fleet.weather_mart)
    # The staged hours, for the models and for the scores; one shuffle of each by asset.
    assert plan.count("FileScan") == 2 and plan.count("WindowGroupLimit") == 0
    assert len(re.findall(r"[-*+] Exchange hashpartitioning", plan)) == 2


def test_daily_rollup_needs_no_second_sort_before_its_shuffle(spark, static_plans):
    lines = [line.strip(" :+-*") for line in physical_plan(Fleet(spark, FOLDER).generation_daily).splitlines()]
    partial = next(i for i, line in enumerate(lines) if "partial_sum" in line)
    until_window = lines[partial + 1 : next(i for i, l in enumerate(lines) if l.startswith("Window "))]
    assert not any(re.match(r"(\(\d+\) )?Sort ", line) for line in until_window)


def test_all_rolling_features_share_one_sort(spark, static_plans):
    df = spark.range(10).selectExpr("id AS i", "id % 2 AS k", "CAST(id AS DOUBLE) AS x")
    out = ts.add_rolling_stats(df, "x", [3, 7, 30], ["mean", "std", "min", "max"], "k", order_by="i")
    plan = physical_plan(out)
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("name", ["combined_assets", "source_preference"])
def test_frames_of_a_union_are_not_deduplicated_in_each_branch(spark, monkeypatch, name):
    """Branches with the same partitioning run in one task, and their sorts are held at once."""
    seen = []
    frame = type(spark.range(0))
    real = frame.unionByName
    monkeypatch.setattr(frame, "unionByName", lambda a, b, **kw: seen.append(real(a, b, **kw)) or seen[-1])
    QUERIES[name](Fleet(spark, FOLDER))
    assert seen and "Union" in physical_plan(seen[-1])
    assert "Window" not in physical_plan(seen[-1])
