import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voltseries.operators import timeseries as ts
from voltseries.plans import correlation_job, export
from voltseries.session import scratch_path
from voltseries.sources import contracts, records, tables

RAW = "asset_id string, timestamp timestamp_ntz, x double, _load_id bigint"


def raw(spark, *rows):
    return spark.createDataFrame(
        [(a, dt.datetime(2023, 1, day, hour), x, load) for a, day, hour, x, load in rows], RAW
    )


def content(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- tables ------------------------------------------------------------------


def test_landing_partitions_by_date(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = raw(spark, ("a", 1, 0, 1.0, 1), ("a", 1, 23, 2.0, 1), ("b", 2, 0, 3.0, 1))
    tables.save_landing(rows, path)
    assert sorted(p.name for p in (tmp_path / "landing").glob("date=*")) == [
        "date=2023-01-01", "date=2023-01-02",
    ]
    assert all(".snappy." in p.name for p in (tmp_path / "landing").rglob("*.parquet"))
    stored = tables.read_landing(spark, path)
    assert content(stored, "asset_id", "x") == [("a", 1.0), ("a", 2.0), ("b", 3.0)]
    plain = str(tmp_path / "plain")
    tables.save_landing(rows, plain, partition_by_date=False)
    assert tables.read_landing(spark, plain, rows.schema).columns == rows.columns


def test_upsert_keeps_the_newest_record(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.upsert(spark, path, raw(spark, ("a", 1, 0, 1.0, 1), ("a", 2, 0, 2.0, 1))) == []
    untouched = {p.name for p in (tmp_path / "t" / "date=2023-01-01").glob("*.parquet")}
    late = raw(spark, ("a", 2, 0, 20.0, 2), ("b", 2, 5, 5.0, 2), ("b", 3, 0, 6.0, 2))
    assert tables.upsert(spark, path, late) == []
    want = [("a", 1, 1.0), ("a", 2, 20.0), ("b", 2, 5.0), ("b", 3, 6.0)]
    read = lambda: content(spark.read.parquet(path), "asset_id", F.dayofmonth("timestamp"), "x")
    assert read() == want
    # Days the batch does not touch keep their files.
    assert {p.name for p in (tmp_path / "t" / "date=2023-01-01").glob("*.parquet")} == untouched
    # Repeating a load changes nothing; an older load does not win.
    tables.upsert(spark, path, late)
    tables.upsert(spark, path, raw(spark, ("a", 2, 0, -1.0, 0)))
    assert read() == want
    assert tables.upsert(spark, path, raw(spark).filter("false")) == []


def test_upsert_adds_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, raw(spark, ("a", 1, 0, 1.0, 1), ("b", 2, 0, 1.0, 1)))
    wider = raw(spark, ("a", 1, 1, 2.0, 2)).withColumn("soc_pct", F.lit(50.0))
    assert tables.upsert(spark, path, wider) == ["soc_pct"]
    # A later batch without the column must not lose it.
    tables.upsert(spark, path, raw(spark, ("c", 1, 2, 3.0, 3)))
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    day = stored.filter("date = '2023-01-01'").collect()
    assert len(day) == 3
    assert {(r.asset_id, r.soc_pct) for r in day} == {("a", None), ("a", 50.0), ("c", None)}


def test_day_partition(spark):
    rows = raw(spark, ("a", 1, 0, 1.0, 1), ("a", 1, 23, 2.0, 1), ("a", 2, 0, 3.0, 1))
    assert content(tables.day_partition(rows, "2023-01-01"), "x") == [(1.0,), (2.0,)]
    with pytest.raises(ValueError):
        tables.day_partition(rows, "2023-01-03")


def test_load_day_is_idempotent(spark, tmp_path):
    rows = raw(spark, ("a", 1, 0, 1.0, 1), ("a", 2, 0, 3.0, 1))
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.load_day(spark, rows, path, "2023-01-02")
    assert content(spark.read.parquet(path), "x") == [(3.0,)]


def test_lookback_equals_a_wide_window(spark):
    rows = spark.createDataFrame(
        [("a", dt.date(2023, 1, d), float(d)) for d in range(1, 31)],
        "asset_id string, date date, x double",
    )
    roll = lambda df: ts.add_rolling_stats(df, "x", [7], ["mean"], "asset_id", order_by="date")
    narrow = tables.with_lookback(rows, "2023-01-20", roll, 7).collect()
    assert narrow == roll(rows).filter("date = '2023-01-20'").collect()


def test_guards(spark):
    rows = raw(spark, ("a", 1, 0, 1.0, 1))
    assert tables.require_mart(rows, ["x"], 1) is rows
    with pytest.raises(ValueError):
        tables.require_mart(rows, ["x"], 2)
    with pytest.raises(ValueError):
        tables.require_mart(rows, ["y"])
    assert tables.lower_names(rows.toDF("A", "B", "C", "D")).columns == ["a", "b", "c", "d"]


def test_overwrite_drops_nan_and_skips_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.overwrite_table(raw(spark, ("a", 1, 0, float("nan"), 1)), path)
    assert tables.current_table(spark, path).first().x is None
    assert not tables.overwrite_table(raw(spark).filter("false"), path)
    assert tables.current_table(spark, path).count() == 1


def test_preferred_source(spark):
    real, spare = raw(spark, ("a", 1, 0, 1.0, 1)), raw(spark, ("b", 1, 0, 1.0, 1))
    assert tables.preferred_source(real, spare, "real", "spare") == (real, "real")
    assert tables.preferred_source(None, spare, "real", "spare") == (spare, "spare")
    assert tables.preferred_source(real.filter("false"), spare, "real", "spare")[1] == "spare"


def test_combine_assets(spark):
    one, two = raw(spark, ("b", 1, 0, 1.0, 1)), raw(spark, ("a", 1, 0, 2.0, 1))
    got = tables.combine_assets([one, two], ["asset_id", "x"], ["asset_id"])
    assert [tuple(r) for r in got.collect()] == [("a", 2.0), ("b", 1.0)]


def test_materialisations(spark, tmp_path):
    rows = raw(spark, ("a", 1, 0, 1.0, 1))
    assert tables.as_view(rows, "rows_view").count() == 1
    assert spark.sql("SELECT x FROM rows_view").first().x == 1.0
    assert tables.as_table(rows, str(tmp_path / "t")).schema == rows.schema


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(shared) and one != two


# --- contracts ---------------------------------------------------------------


def test_contract(spark, tmp_path):
    dim = spark.sql(
        "SELECT 8D AS latitude, 9D AS longitude, 'a' AS asset_id, 'n' AS asset_name, "
        "'wind' AS asset_type, 100D AS asset_capacity_mw, 'Large' AS asset_size_category, "
        "'X' AS region"
    )
    checked = contracts.assert_contract(dim, contracts.DIM_ASSET)
    assert checked.columns == contracts.DIM_ASSET.fieldNames()
    for broken in (
        dim.drop("region"),
        dim.withColumn("extra", F.lit(1)),
        dim.withColumn("latitude", F.lit("8")),
        dim.withColumn("asset_name", F.lit(None).cast("string")),
    ):
        with pytest.raises(contracts.ContractError):
            contracts.assert_contract(broken, contracts.DIM_ASSET)
    path = str(tmp_path / "dim")
    contracts.write_with_contract(dim, contracts.DIM_ASSET, path)
    with pytest.raises(contracts.ContractError):
        contracts.write_with_contract(
            dim.withColumn("asset_id", F.lit(None).cast("string")), contracts.DIM_ASSET, path
        )
    stored = tables.current_table(spark, path)
    assert stored.first().asset_id == "a"  # the good table is still there
    assert stored.columns[:3] == ["asset_id", "asset_name", "asset_type"]


# --- JSON and CSV ------------------------------------------------------------


def test_json_ready(spark):
    rows = spark.sql(
        "SELECT DATE '2026-04-10' AS date, double('nan') AS x, 1D AS y "
        "UNION ALL SELECT DATE '2026-04-11', 2D, NULL"
    )
    assert [tuple(r) for r in records.json_ready(rows).orderBy("date").collect()] == [
        ("2026-04-10", None, 1.0), ("2026-04-11", 2.0, None)
    ]


def test_json_keeps_null_fields(spark, tmp_path):
    path = tmp_path / "j"
    records.write_json(spark.sql("SELECT 1 AS a, CAST(NULL AS DOUBLE) AS b"), str(path))
    text = next(path.glob("part-*.json")).read_text()
    assert json.loads(text) == {"a": 1, "b": None}


def test_json_defaults(spark, tmp_path):
    payload = [
        {"asset_id": "a", "date": "2026-04-01", "total_net_generation_mwh": None,
         "daily_capacity_factor": "0.5", "avg_availability_pct": "junk", "avg_soc_pct": None},
        {"asset_id": "b", "date": "2026-04-01", "total_net_generation_mwh": 7,
         "avg_soc_pct": 40.5, "asset_type": "battery"},
        {"asset_id": "c", "date": "2026-04-01", "avg_soc_pct": "junk", "ignored": {"x": 1}},
    ]
    (tmp_path / "d.json").write_text(json.dumps(payload))
    got = {r.asset_id: r for r in records.read_daily_json(spark, str(tmp_path / "d.json"), True).collect()}
    assert got["a"].total_net_generation_mwh == 0.0 and got["a"].daily_capacity_factor == 0.5
    assert got["a"].avg_availability_pct == 0.0 and got["a"].avg_soc_pct is None
    assert got["a"].asset_type == ""
    assert got["b"].total_net_generation_mwh == 7.0 and got["b"].avg_soc_pct == 40.5
    assert got["c"].avg_soc_pct == 0.0
    (tmp_path / "a.json").write_text(json.dumps([{"asset_id": "a", "capacity_mw": 5}]))
    asset = records.read_assets_json(spark, str(tmp_path / "a.json"), True).first()
    assert tuple(asset) == ("a", 5.0, "", "", "a", "")
    (tmp_path / "w.json").write_text(json.dumps([{"asset_id": "a", "date": "d"}]))
    weather = records.read_weather_json(spark, str(tmp_path / "w.json"), True).first()
    assert tuple(weather) == ("a", "d", 0.0, "", "")
    (tmp_path / "m.json").write_text(json.dumps({"date_range": {"start": "s"}, "asset_count": 3}))
    assert tuple(records.read_manifest_json(spark, str(tmp_path / "m.json")).first()) == (
        "", "s", "", 3, "", ""
    )


def test_archive_payload(spark, tmp_path):
    hourly = {
        "time": ["2023-01-01T00:00", "2023-01-01T01:00"],
        "wind_speed_100m": [5.0, None], "wind_direction_100m": [180.0, None],
        "shortwave_radiation": [None, 10.0], "temperature_2m": [None, -1.0],
        "surface_pressure": [None, 1000.0], "relative_humidity_2m": [None, 30.0],
        "cloud_cover": [50, None],
    }
    (tmp_path / "p.json").write_text(json.dumps({"asset_id": "a", "hourly": hourly}))
    payload = records.read_archive_payload(spark, str(tmp_path / "p.json"), whole_file=True)
    rows = records.flatten_hourly(payload).orderBy("timestamp").collect()
    assert tuple(rows[0]) == (dt.datetime(2023, 1, 1), "a", 5.0, 180.0, 0.0, 15.0, 1013.0, 60.0, 50.0)
    assert tuple(rows[1])[2:] == (0.0, 0.0, 10.0, -1.0, 1000.0, 30.0, 0.0)


def test_asset_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        "asset_id,asset_name,asset_type,capacity_mw,latitude,longitude,region\n"
        "A1,North Ridge,wind,150,32.45,-100.54,ERCOT\n"
    )
    seed = records.read_asset_seed(spark, str(path))
    assert tuple(seed.first()) == ("A1", "North Ridge", "wind", 150.0, 32.45, -100.54, "ERCOT")
    records.write_asset_seed(seed, str(tmp_path / "out"))
    assert records.read_asset_seed(spark, str(tmp_path / "out")).collect() == seed.collect()


# --- export and correlation job ----------------------------------------------


def marts(spark, rows=15):
    days = spark.range(rows).withColumn("date", F.date_add(F.lit("2026-04-01").cast("date"), F.col("id").cast("int")))
    texts = {"asset_id", "asset_type", "daily_performance_rating", "performance_category",
             "inferred_asset_type"}
    fill = lambda cols: days.select(
        *[F.col("date") if c == "date" else F.lit("wind").alias(c) if c in texts
          else (F.col("id") * 1.0).alias(c) for c in cols]
    )
    dim = spark.sql(
        "SELECT 'wind' AS ASSET_ID, 'North' AS ASSET_NAME, 'wind' AS ASSET_TYPE, "
        "99.9D AS ASSET_CAPACITY_MW, 'Large' AS ASSET_SIZE_CATEGORY, 1D AS LATITUDE, "
        "2D AS LONGITUDE, 'X' AS REGION"
    )
    daily, weather = fill(export.DAILY_COLUMNS), fill(export.WEATHER_COLUMNS)
    return daily.toDF(*[c.upper() for c in daily.columns]), weather, dim.unionByName(dim)


def test_export(spark, tmp_path):
    daily, weather, dim = marts(spark)
    export.write_export(daily, weather, dim, str(tmp_path), "run-7", "warehouse", "2026-04-20T00:00:00Z")
    assert records.read_daily_json(spark, str(tmp_path / "daily_performance")).count() == 15
    assert records.read_weather_json(spark, str(tmp_path / "weather_performance")).count() == 15
    asset = records.read_assets_json(spark, str(tmp_path / "assets")).collect()
    assert [(a.asset_id, a.display_name) for a in asset] == [("wind", "North (99 MW wind)")]
    text = next((tmp_path / "manifest").glob("part-*.json")).read_text()
    assert json.loads(text) == {
        "generated_at": "2026-04-20T00:00:00Z", "pipeline_run_id": "run-7",
        "date_range": {"start": "2026-04-01", "end": "2026-04-15"}, "asset_count": 1,
        "asset_type_counts": {"wind": 1}, "weather_source": "warehouse",
        "row_counts": {"daily_performance": 15, "weather_performance": 15},
        "schema_version": "2.0",
    }


def test_export_refuses_small_or_narrow_marts(spark, tmp_path):
    daily, weather, dim = marts(spark, 9)
    with pytest.raises(ValueError):
        export.write_export(daily, weather, dim, str(tmp_path))
    daily, weather, dim = marts(spark)
    with pytest.raises(ValueError):
        export.write_export(daily.drop("AVG_GHI"), weather, dim, str(tmp_path))


def test_correlation_job(spark, tmp_path):
    rows = [("up", i, 10.0 * i, float(i)) for i in range(8)] + [("down", i, -5.0 * i, float(i)) for i in range(8)]
    rows += [("flat", i, 3.0, float(i)) for i in range(2)]
    daily = spark.createDataFrame(rows, "ASSET_ID string, n int, TOTAL_NET_GENERATION_MWH double, AVG_TEMPERATURE_C double")
    daily = daily.withColumn("DATE", F.date_add(F.lit("2023-01-01").cast("date"), F.col("n")))
    out = correlation_job.run_correlation_job(daily, str(tmp_path / "r"), str(tmp_path / "e"))
    assert out["row_count"] == 3 and out["enriched_row_count"] == 18
    assert out["mean_correlation"] == pytest.approx(0.0)
    stored = {r.asset_id: r[correlation_job.RESULT] for r in tables.current_table(spark, str(tmp_path / "r")).collect()}
    assert stored == {"up": pytest.approx(1.0), "down": pytest.approx(-1.0), "flat": None}
    enriched = tables.current_table(spark, str(tmp_path / "e"))
    assert "total_net_generation_mwh_rolling_std_30" in enriched.columns
    assert enriched.filter("asset_id = 'up' AND n = 7").first().total_net_generation_mwh_lag_7 == 0.0
    with pytest.raises(ValueError):
        correlation_job.run_correlation_job(daily.limit(5), str(tmp_path / "r2"), str(tmp_path / "e2"))


def test_upsert_reads_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, raw(spark, *[("a", d, 0, 1.0, 1) for d in range(1, 6)]))
    days = [dt.date(2023, 1, 2), dt.date(2023, 2, 9)]
    touched = tables._days_of(spark, path, tables.stored_schema(spark, path), days)
    assert content(touched, "date") == [(dt.date(2023, 1, 2),)]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date" in plan


def test_upsert_keeps_rows_without_a_timestamp(spark, tmp_path):
    path = str(tmp_path / "t")
    lost = lambda a, x, load: spark.createDataFrame([(a, None, x, load)], RAW)
    tables.upsert(spark, path, lost("a", 1.0, 1))
    tables.upsert(spark, path, lost("b", 2.0, 2))
    tables.upsert(spark, path, lost("a", 3.0, 3))
    stored = tables.read_landing(spark, path)
    assert content(stored, "asset_id", "x", "date") == [("a", 3.0, None), ("b", 2.0, None)]


def test_added_columns_are_reported_once_and_read_back(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = lambda day: raw(spark, ("a", day, 0, 1.0, day)).withColumn("y", F.lit(float(day)))
    tables.upsert(spark, path, raw(spark, ("a", 1, 0, 1.0, 1)))
    assert tables.upsert(spark, path, wide(2)) == ["y"]
    assert tables.upsert(spark, path, wide(3)) == []
    assert sorted(r.y or 0.0 for r in tables.read_landing(spark, path).collect()) == [0.0, 2.0, 3.0]


def test_staged_files_follow_tasks_not_days(spark, tmp_path):
    rows = raw(spark, *[("a", 1 + d, h, 1.0, 1) for d in range(28) for h in range(24)]).repartition(8)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(Path(shared).glob("upsert-*"))
    tables.upsert(spark, str(tmp_path / "t"), rows)
    (staged,) = set(Path(shared).glob("upsert-*")) - before
    assert len(list(staged.rglob("*.parquet"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_refused_or_repeated_write_keeps_versions_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(raw(spark, ("a", 1, 0, 1.0, 1)), path)
    with pytest.raises(ZeroDivisionError):
        tables.replace_table(raw(spark, ("b", 1, 0, 2.0, 1)), path, check=lambda df: 1 / 0)
    assert content(tables.current_table(spark, path), "asset_id") == [("a",)]
    tables.replace_table(raw(spark, ("c", 1, 0, 3.0, 1)), path)
    assert content(tables.current_table(spark, path), "asset_id") == [("c",)]
    with pytest.raises(ValueError):
        tables.current_table(spark, str(tmp_path / "none"))


def test_manifest_with_a_missing_technology(spark):
    assets = spark.createDataFrame([("a", None), ("b", "wind")], "asset_id string, asset_type string")
    daily = spark.createDataFrame([(dt.date(2023, 1, 1),)], "date date")
    row = export.manifest(daily, daily, assets, "r", "w", "now").first()
    assert row.asset_type_counts == {"unknown": 1, "wind": 1}
