"""Registered queries: one per operator, over the frames derived from ``events``.

Every query reads the whole table. Values that the operator itself does not round
are rounded to six digits at the end, for comparison with another engine.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.functions import engineering as eng
from voltseries.functions.numeric import round_dec
from voltseries.operators import kpis, metrics, quality
from voltseries.operators import timeseries as ts
from voltseries.operators.dedup import keep_latest
from voltseries.operators.joins import align_to_hours, select_assets, with_technology
from voltseries.operators.ordering import rank_share, with_position
from voltseries.plans import correlation_job, daily, export, fleet_balance, model_state
from voltseries.plans import local_flavour as local
from voltseries.plans import staging, weather_score
from voltseries.session import scratch_path
from voltseries.sources import contracts, records, tables
from voltseries.sources import events_adapter as adapter

NOW = dt.datetime(2024, 2, 1)
LOOKBACK_DAY = "2024-01-20"
KEYS = ["asset_id", "timestamp"]


class Fleet:
    """The model chain over one data folder; every frame is a lazy plan."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.events = adapter.read_events(spark, folder)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    @cached_property
    def raw_generation(self) -> DataFrame:
        return adapter.generation_frame(self.events)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return adapter.weather_frame(self.events)

    @cached_property
    def assets(self) -> DataFrame:
        return adapter.asset_frame(self.events)

    @cached_property
    def generation(self) -> DataFrame:
        """Newest raw generation record per asset and hour."""
        return keep_latest(self.raw_generation, KEYS).drop("_load_id")

    @cached_property
    def weather(self) -> DataFrame:
        """Newest raw weather record per asset and hour."""
        return keep_latest(self.raw_weather, KEYS).drop("_load_id")

    @cached_property
    def stg_generation(self) -> DataFrame:
        return staging.stg_generation(self.raw_generation)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.stg_weather(self.raw_weather)

    @cached_property
    def generation_daily(self) -> DataFrame:
        return daily.int_generation_daily(self.stg_generation)

    @cached_property
    def weather_daily(self) -> DataFrame:
        return daily.int_weather_daily(self.stg_weather)

    @cached_property
    def joined(self) -> DataFrame:
        return staging.int_asset_weather_join(self.stg_generation, self.stg_weather)

    @cached_property
    def hours(self) -> DataFrame:
        return weather_score.complete_hours(self.joined)

    @cached_property
    def dim_asset(self) -> DataFrame:
        return staging.dim_asset(self.assets)

    @cached_property
    def daily_mart(self) -> DataFrame:
        return daily.mart_asset_performance_daily(self.generation_daily, self.weather_daily)

    @cached_property
    def weather_mart(self) -> DataFrame:
        return weather_score.mart_asset_weather_performance(self.joined)

    @cached_property
    def marts(self) -> Mapping[str, DataFrame]:
        """Both marts by name; one is planned, and its hours staged, only when it is asked for."""
        return metrics.LazyTables(
            {
                "mart_asset_performance_daily": lambda: self.daily_mart,
                "mart_asset_weather_performance": lambda: self.weather_mart,
            }
        )

    @cached_property
    def daily_export(self) -> DataFrame:
        return export.daily_payload(self.daily_mart)

    @cached_property
    def weather_export(self) -> DataFrame:
        return export.weather_payload(self.weather_mart)

    @cached_property
    def assets_export(self) -> DataFrame:
        return export.assets_payload(self.dim_asset)

    @cached_property
    def local_daily(self) -> DataFrame:
        return local.daily_frame_observed_hours(self.generation, self.weather)

    @cached_property
    def potential(self) -> DataFrame:
        return fleet_balance.renewable_potential(self.weather, self.assets)

    @cached_property
    def balance(self) -> DataFrame:
        return fleet_balance.hourly_balance(self.potential, self.weather, self.assets)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            round_dec(f"`{f.name}`", digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else f.name
            for f in df.schema.fields
        ]
    )


QUERIES: dict[str, Callable[[Fleet], DataFrame]] = {}


def _query(build: Callable[[Fleet], DataFrame]) -> Callable[[Fleet], DataFrame]:
    QUERIES[build.__name__] = build
    return build


# --- staging -----------------------------------------------------------------


@_query
def stg_weather(f: Fleet) -> DataFrame:
    return f.stg_weather


@_query
def stg_generation(f: Fleet) -> DataFrame:
    return f.stg_generation


@_query
def dedup_latest_load(f: Fleet) -> DataFrame:
    return rounded(keep_latest(f.raw_generation, KEYS))


@_query
def time_features(f: Fleet) -> DataFrame:
    return ts.add_time_features(f.generation.select(*KEYS))


@_query
def categories(f: Fleet) -> DataFrame:
    return f.stg_weather.groupBy(
        "wind_speed_category", "irradiance_category", "temperature_category"
    ).agg(F.count(F.lit(1)).alias("hours"))


@_query
def quality_flags(f: Fleet) -> DataFrame:
    return f.stg_generation.groupBy("asset_type", "asset_size_category").agg(
        F.count(F.lit(1)).alias("hours"),
        F.count_if(F.col("is_data_valid")).alias("valid_hours"),
        F.count_if(F.col("is_zero_generation_anomaly")).alias("anomaly_hours"),
        F.count_if(F.col("meets_availability_target")).alias("target_hours"),
    )


@_query
def capacity_factor_unrounded(f: Fleet) -> DataFrame:
    hours = f.generation.select(*KEYS, "net_generation_mwh", "asset_capacity_mw")
    return rounded(
        ts.calculate_capacity_factor(hours, "net_generation_mwh", "asset_capacity_mw", 2.0)
    )


# --- daily roll-ups and joins ------------------------------------------------


@_query
def int_weather_daily(f: Fleet) -> DataFrame:
    return f.weather_daily


@_query
def int_generation_daily(f: Fleet) -> DataFrame:
    return f.generation_daily


@_query
def daily_frame_observed_hours(f: Fleet) -> DataFrame:
    return rounded(f.local_daily)


@_query
def int_asset_weather_join(f: Fleet) -> DataFrame:
    return f.joined


@_query
def dim_asset(f: Fleet) -> DataFrame:
    return f.dim_asset


@_query
def dim_lookup_fallback(f: Fleet) -> DataFrame:
    """Rows of odd days lose their own technology and fall back to the dimension's."""
    rows = f.daily_mart.select(
        "asset_id",
        "date",
        F.when(F.dayofmonth("date") % 2 == 0, F.col("asset_type")).otherwise("").alias(
            "asset_type"
        ),
    )
    return with_technology(rows, f.assets_export, "unknown")


@_query
def align_hour_axis(f: Fleet) -> DataFrame:
    return rounded(align_to_hours(f.generation, f.assets, "gross_generation_mwh"))


@_query
def select_by_technology(f: Fleet) -> DataFrame:
    return select_assets(
        f.daily_export, f.assets_export, "solar", start="2024-01-05", end="2024-01-20"
    )


# --- marts -------------------------------------------------------------------


@_query
def mart_asset_performance_daily(f: Fleet) -> DataFrame:
    return f.daily_mart


@_query
def mart_asset_weather_performance(f: Fleet) -> DataFrame:
    return f.weather_mart


@_query
def expected_generation(f: Fleet) -> DataFrame:
    models = weather_score.asset_models(f.hours).drop("asset_type", "asset_capacity_mw")
    joined = f.joined.filter("is_complete_record")
    return weather_score.expected_generation(joined, models).select(
        "asset_id", "timestamp", "expected_generation_from_wind",
        "expected_generation_from_solar", "expected_generation_mwh",
    )


@_query
def performance_ratio(f: Fleet) -> DataFrame:
    return weather_score.daily_scores(f.hours, weather_score.asset_models(f.hours)).select(
        "asset_id", "date", "hourly_observations", "avg_expected_generation_mwh",
        "avg_actual_generation_mwh", "avg_performance_ratio_pct",
        "daily_total_net_generation_mwh", "daily_avg_capacity_factor",
    )


@_query
def technology_score(f: Fleet) -> DataFrame:
    return weather_score.daily_scores(f.hours, weather_score.asset_models(f.hours)).select(
        "asset_id", "date", "asset_type", "performance_score"
    )


@_query
def combined_assets(f: Fleet) -> DataFrame:
    """Frames of the four technologies put together again, in an order that is kept as a column."""
    columns = ["timestamp", "asset_id", "gross_generation_mwh"]
    kinds = ("wind", "solar", "battery", "gas")
    # Stored once: a union of four unstored frames would de-duplicate and sort four times in each task.
    newest = tables.as_table(f.generation.select(*columns, "asset_type"), f.scratch("newest"))
    frames = [newest.filter(F.col("asset_type") == kind) for kind in kinds]
    rows = tables.combine_assets(frames, columns, order_by=["timestamp", "asset_id"])
    path = f.scratch("combined")
    rows.write.parquet(path)
    # Sorted files: the position of a row is read off the stored order, and checked by the SQL.
    return rounded(with_position(f.spark.read.parquet(path), ["timestamp", "asset_id"], "position"))


@_query
def source_preference(f: Fleet) -> DataFrame:
    """Measured weather where there is any, else the fallback, with its label."""
    weather = tables.as_table(f.weather.select(*KEYS), f.scratch("newest"))
    none = weather.filter("timestamp IS NULL")
    found, label = tables.preferred_source(none, weather, "measured", "modelled")
    first, own = tables.preferred_source(weather, none, "measured", "modelled")
    parts = found.withColumn("source", F.lit(label)).unionByName(first.withColumn("source", F.lit(own)))
    return parts.groupBy("source", "asset_id").agg(F.count(F.lit(1)).alias("hours"))


@_query
def materialised_alike(f: Fleet) -> DataFrame:
    """One model inline, as a view and as a table: the same rows each time."""
    view = tables.as_view(f.generation_daily, f"generation_daily_{uuid.uuid4().hex}")
    table = tables.as_table(f.generation_daily, f.scratch("generation-daily"))
    kinds = {"inline": f.generation_daily, "view": view, "table": table}
    counted = [
        df.groupBy("asset_type").agg(F.count(F.lit(1)).alias("days")).withColumn("kind", F.lit(kind))
        for kind, df in kinds.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@_query
def stg_weather_distinct(f: Fleet) -> DataFrame:
    """Raw rows loaded twice: the distinct staging gives each of them once."""
    return staging.stg_weather(f.raw_weather.unionByName(f.raw_weather), distinct=True)


@_query
def sorted_series(f: Fleet) -> DataFrame:
    """Daily generation of the fleet in the order of a chart, with the place of each point."""
    days = kpis.generation_by_date(f.daily_export)
    return rounded(with_position(days, ["date"], "position"))


# --- statistics --------------------------------------------------------------


@_query
def asset_correlations(f: Fleet) -> DataFrame:
    return weather_score.asset_models(f.hours)


@_query
def asset_models_incremental(f: Fleet) -> DataFrame:
    """The same models from a state that three loads of days have filled, one after the other."""
    path = f.scratch("model-state")
    for part in range(3):
        model_state.update_state(f.hours.filter(F.dayofmonth("date") % 3 == part), path)
    return model_state.models_of(model_state.read_state(f.spark, path))


@_query
def linfit_by_asset(f: Fleet) -> DataFrame:
    return rounded(
        local.fit_by_asset(local.hourly_with_driver(f.generation, f.weather, f.assets))
    )


@_query
def static_correlation(f: Fleet) -> DataFrame:
    return rounded(ts.calculate_correlation(f.joined, "wind_speed_mps", "net_generation_mwh"))


@_query
def correlation_by_asset(f: Fleet) -> DataFrame:
    return rounded(correlation_job.correlation_results(f.daily_mart))


@_query
def correlation_enriched(f: Fleet) -> DataFrame:
    rows = f.daily_mart.select("asset_id", "date", "total_net_generation_mwh")
    return rounded(correlation_job.enriched_daily(rows))


@_query
def correlation_job_summary(f: Fleet) -> DataFrame:
    """The whole job: both tables stored, the summary taken from what is stored."""
    results, enriched = f.scratch("correlation"), f.scratch("enriched")
    correlation_job.run_correlation_job(f.daily_mart, results, enriched)
    stored = tables.current_table(f.spark, results), tables.current_table(f.spark, enriched)
    return rounded(correlation_job.job_summary(*stored))


# --- windows -----------------------------------------------------------------


def _daily_net(f: Fleet) -> DataFrame:
    return f.generation_daily.select("asset_id", "date", "total_net_generation_mwh")


@_query
def lag_features(f: Fleet) -> DataFrame:
    return ts.add_lag_features(
        _daily_net(f), "total_net_generation_mwh", [1, 3, 7], "asset_id", order_by="date"
    )


@_query
def lead_features(f: Fleet) -> DataFrame:
    return ts.add_lead_features(
        _daily_net(f), "total_net_generation_mwh", [1, 2], "asset_id", order_by="date"
    )


@_query
def rolling_stats(f: Fleet) -> DataFrame:
    return rounded(
        ts.add_rolling_stats(
            _daily_net(f), "total_net_generation_mwh", [3, 7],
            ["mean", "std", "min", "max", "unknown"], "asset_id", order_by="date",
        )
    )


@_query
def rolling_correlation(f: Fleet) -> DataFrame:
    rows = f.daily_mart.select(
        "asset_id", "date", "total_net_generation_mwh", "avg_temperature_c"
    )
    return rounded(
        ts.calculate_correlation(
            rows, "total_net_generation_mwh", "avg_temperature_c", 7, "asset_id",
            order_by="date",
        )
    )


@_query
def lag_lead_whole_table(f: Fleet) -> DataFrame:
    """Lag and lead without a series key: the table is one series, cut into blocks."""
    rows = f.stg_generation.select("timestamp", "asset_id", "gross_generation_mwh")
    order = ["timestamp", "asset_id"]
    lagged = ts.add_lag_features(
        rows, "gross_generation_mwh", [1, 5], order_by=order, block_rows=2000
    )
    return ts.add_lead_features(
        lagged, "gross_generation_mwh", [2], order_by=order, block_rows=2000
    )


@_query
def rolling_stats_whole_table(f: Fleet) -> DataFrame:
    rows = f.stg_generation.select("timestamp", "asset_id", "gross_generation_mwh")
    return rounded(
        ts.add_rolling_stats(
            rows, "gross_generation_mwh", [24], ["mean", "std", "min", "max"],
            order_by=["timestamp", "asset_id"], block_rows=2000,
        )
    )


@_query
def rolling_stats_year(f: Fleet) -> DataFrame:
    """Frames of a year of hours over the whole table."""
    rows = f.stg_generation.select("timestamp", "asset_id", "gross_generation_mwh")
    return rounded(
        ts.add_rolling_stats(
            rows, "gross_generation_mwh", [8760], ["mean", "std", "min", "max"],
            order_by=["timestamp", "asset_id"], block_rows=20_000,
        )
    )


@_query
def rolling_correlation_month(f: Fleet) -> DataFrame:
    """Wind against output over the last 720 hours of a technology."""
    rows = f.joined.select("asset_type", "timestamp", "asset_id", "wind_speed_mps", "capacity_factor")
    return rounded(
        ts.calculate_correlation(
            rows, "wind_speed_mps", "capacity_factor", 720, "asset_type",
            order_by=["timestamp", "asset_id"], block_rows=5_000,
        )
    )


@_query
def rolling_stats_split_series(f: Fleet) -> DataFrame:
    """Rolling statistics per technology, whose series are long: cut into blocks."""
    rows = f.stg_generation.select(
        "asset_type", "timestamp", "asset_id", "gross_generation_mwh"
    )
    return rounded(
        ts.add_rolling_stats(
            rows, "gross_generation_mwh", [12], ["mean", "max"], "asset_type",
            order_by=["timestamp", "asset_id"], block_rows=1000,
        )
    )


@_query
def rolling_7d_30d(f: Fleet) -> DataFrame:
    return f.weather_mart.select(
        "asset_id", "date", "rolling_7d_avg_generation", "rolling_7d_avg_cf",
        "rolling_30d_avg_generation", "rolling_30d_avg_cf",
    )


@_query
def rank_signal(f: Fleet) -> DataFrame:
    rows = f.stg_generation.select("timestamp", "asset_id", "gross_generation_mwh")
    return rounded(rank_share(rows, "gross_generation_mwh", ["timestamp", "asset_id"]))


@_query
def cumulative_mix(f: Fleet) -> DataFrame:
    return rounded(kpis.cumulative_mix(kpis.generation_mix(f.daily_export, f.assets_export)))


# --- second flavour ----------------------------------------------------------


@_query
def weather_performance_local(f: Fleet) -> DataFrame:
    return rounded(
        local.weather_performance_local(f.generation, f.weather, f.assets, f.local_daily)
    )


@_query
def operational_ratio(f: Fleet) -> DataFrame:
    hours = local.hourly_with_driver(f.generation, f.weather, f.assets)
    return rounded(
        hours.select(
            "asset_id", "timestamp", "technology",
            local.operational_ratio().alias("operational_ratio"),
        )
    )


# --- engineering -------------------------------------------------------------


@_query
def air_density(f: Fleet) -> DataFrame:
    density = eng.air_density(F.col("temperature_c"), F.col("pressure_hpa"))
    return rounded(f.weather.select(*KEYS, density.alias("air_density")))


@_query
def wind_theoretical(f: Fleet) -> DataFrame:
    return rounded(
        f.potential.filter(F.col("asset_type") == "wind").select(*KEYS, "potential_mwh")
    )


@_query
def solar_theoretical(f: Fleet) -> DataFrame:
    return rounded(
        f.potential.filter(F.col("asset_type") == "solar").select(*KEYS, "potential_mwh")
    )


@_query
def gas_fuel_co2(f: Fleet) -> DataFrame:
    gas = eng.GAS_DEFAULTS
    rate = eng.part_load_heat_rate(
        F.col("net_generation_mwh"), F.col("asset_capacity_mw"),
        F.lit(gas["heat_rate_btu_kwh"]), F.lit(gas["part_load_a"]), F.lit(gas["part_load_b"]),
    )
    units = f.generation.filter(F.col("asset_type") == "gas").withColumn("heat_rate", rate)
    fuel = eng.fuel_mmbtu(F.col("net_generation_mwh"), F.col("heat_rate"))
    return rounded(
        units.withColumn("fuel", fuel).select(
            *KEYS, "heat_rate", "fuel", eng.co2_tonnes(F.col("fuel")).alias("co2")
        )
    )


@_query
def clear_sky_ghi(f: Fleet) -> DataFrame:
    sites = f.weather.select(*KEYS).join(f.assets.select("asset_id", "latitude"), "asset_id")
    clear = eng.clear_sky_ghi(
        F.col("latitude"), F.dayofyear("timestamp"), F.hour("timestamp")
    )
    return rounded(sites.select(*KEYS, clear.alias("clear_sky_ghi")))


@_query
def demand_curve(f: Fleet) -> DataFrame:
    return rounded(f.balance.select("timestamp", "demand_mw"))


@_query
def net_load(f: Fleet) -> DataFrame:
    # Rounded before ranking, so that the last bits of a sum cannot swap two hours.
    return rounded(fleet_balance.net_load_signal(rounded(f.balance)))


@_query
def curtailment_allocation(f: Fleet) -> DataFrame:
    return rounded(fleet_balance.allocate_curtailment(f.potential, f.balance))


# --- data quality ------------------------------------------------------------


@_query
def range_violations_weather(f: Fleet) -> DataFrame:
    return quality.weather_range_check(f.stg_weather)


@_query
def range_violations_generation(f: Fleet) -> DataFrame:
    return quality.generation_range_check(f.stg_generation)


@_query
def row_count_check(f: Fleet) -> DataFrame:
    frames = {
        "raw_weather": f.raw_weather,
        "raw_generation": f.raw_generation,
        "daily_mart": f.daily_mart,
        "correlation": correlation_job.correlation_results(f.daily_mart),
    }
    out = None
    for name, frame in frames.items():
        checked = quality.row_count_check(frame).select(F.lit(name).alias("table_name"), "*")
        out = checked if out is None else out.unionByName(checked)
    return out


@_query
def freshness_check(f: Fleet) -> DataFrame:
    weather = quality.freshness(f.stg_weather, NOW).select(F.lit("weather").alias("t"), "*")
    generation = quality.freshness(f.stg_generation, NOW).select(
        F.lit("generation").alias("t"), "*"
    )
    return weather.unionByName(generation)


@_query
def data_age_badge(f: Fleet) -> DataFrame:
    return quality.data_age(f.daily_mart, NOW)


@_query
def rule_report(f: Fleet) -> DataFrame:
    return quality.rule_report(f.raw_generation, quality.RAW_GENERATION_RULES)


def _report_query(table: str, frame: str, rules: str) -> None:
    def report(f: Fleet) -> DataFrame:
        return quality.rule_report(getattr(f, frame), getattr(quality, rules))

    QUERIES[f"rule_report_{table}"] = report


for _table, _frame, _rules in (
    ("raw_weather", "raw_weather", "RAW_WEATHER_RULES"),
    ("stg_weather", "stg_weather", "STG_WEATHER_RULES"),
    ("stg_generation", "stg_generation", "STG_GENERATION_RULES"),
    ("weather_daily", "weather_daily", "INT_WEATHER_DAILY_RULES"),
    ("generation_daily", "generation_daily", "INT_GENERATION_DAILY_RULES"),
    ("join", "joined", "INT_JOIN_RULES"),
    ("daily_mart", "daily_mart", "DAILY_MART_RULES"),
    ("dim_asset", "dim_asset", "DIM_ASSET_RULES"),
):
    _report_query(_table, _frame, _rules)


@_query
def stored_failures(f: Fleet) -> DataFrame:
    """Failing rows written for review and read back."""
    folder = f.scratch("failures")
    quality.store_failures(f.stg_generation, quality.STG_GENERATION_RULES, folder)
    rows = f.spark.read.parquet(f"{folder}/rows")
    return rows.select(*KEYS, F.concat_ws(",", "failed_rules").alias("failed_rules"))


@_query
def rule_report_weather_mart(f: Fleet) -> DataFrame:
    return quality.rule_report(f.weather_mart, quality.WEATHER_MART_RULES)


@_query
def failing_rows(f: Fleet) -> DataFrame:
    rules = [r for r in quality.STG_GENERATION_RULES if isinstance(r, quality.ColumnRule)]
    return quality.failing_rows(f.stg_generation, rules).select(
        *KEYS, F.array_join("failed_rules", ",").alias("failed_rules")
    )


@_query
def unique_violations(f: Fleet) -> DataFrame:
    return quality.unique_violations(f.raw_generation, KEYS)


UNIQUE_RULES = (
    quality.unique(*KEYS, severity="warn"),
    quality.unique("_load_id"),
    quality.unique("asset_id", "timestamp", "net_generation_mwh", severity="warn"),
)


@_query
def unique_report(f: Fleet) -> DataFrame:
    """All uniqueness rules of the raw records in one shuffle."""
    return quality.unique_report(f.raw_generation, UNIQUE_RULES)


@_query
def report_during_write(f: Fleet) -> DataFrame:
    """Contract and rules of the daily mart, counted while it is written."""
    rules = [r for r in quality.DAILY_MART_RULES if isinstance(r, quality.ColumnRule)]
    rows = contracts.published_dates(f.daily_mart)
    watched, watch = quality.observed(rows, rules)
    tables.replace_table(watched, f.scratch("watched-mart"))
    return quality.observed_report(f.spark, watch, rules)


# --- metrics -----------------------------------------------------------------


@_query
def metric_daily_generation(f: Fleet) -> DataFrame:
    return rounded(
        metrics.query_metric(f.marts, "daily_generation", ["asset_size_category"], "week")
    )


@_query
def metric_generation_efficiency(f: Fleet) -> DataFrame:
    return rounded(
        metrics.query_metric(
            f.marts, "generation_efficiency", ["daily_performance_rating"], "month",
            where="asset_type <> 'battery'",
        )
    )


@_query
def metric_weather_adjusted_score(f: Fleet) -> DataFrame:
    return rounded(
        metrics.query_metric(
            f.marts, "weather_adjusted_score", ["inferred_asset_type"], "day"
        )
    )


@_query
def metric_measures(f: Fleet) -> DataFrame:
    """All measures of both models in total, a row each; one pass per model."""
    parts = []
    for name, model in metrics.MODELS.items():
        measures = list(model["measures"])
        totals = metrics.query_metric(f.marts, measures)
        entries = F.array(
            *[
                F.struct(
                    F.lit(name).alias("model"),
                    F.lit(m).alias("measure"),
                    F.col(m).alias("value"),
                )
                for m in measures
            ]
        )
        parts.append(totals.select(F.inline(entries)))
    return rounded(parts[0].unionByName(parts[1]))


@_query
def time_spine(f: Fleet) -> DataFrame:
    return tables.day_spine_of(f.stg_generation)


@_query
def metric_on_spine(f: Fleet) -> DataFrame:
    """All days of the metric on a spine that is wider than the data."""
    metric = metrics.query_metric(f.marts, "daily_generation", grain="day")
    spine = tables.day_spine_of(f.stg_generation).select(F.explode(F.array(
        F.date_sub("date_day", 40), "date_day", F.date_add("date_day", 40)
    )).alias("date_day")).distinct()
    return rounded(metrics.on_spine(metric, spine, "date"))


# --- dashboard ---------------------------------------------------------------


@_query
def fleet_kpis(f: Fleet) -> DataFrame:
    return rounded(kpis.fleet_kpis(f.daily_export, f.assets_export))


@_query
def figures_by_grouping(f: Fleet) -> DataFrame:
    return rounded(kpis.figures_by_grouping(f.daily_export, f.assets_export))


@_query
def generation_by_date(f: Fleet) -> DataFrame:
    return rounded(kpis.generation_by_date(f.daily_export))


@_query
def capacity_factor_by_date(f: Fleet) -> DataFrame:
    return rounded(kpis.capacity_factor_by_date(f.daily_export, f.assets_export))


@_query
def score_by_date(f: Fleet) -> DataFrame:
    return rounded(kpis.score_by_date(f.weather_export))


@_query
def battery_soc_by_date(f: Fleet) -> DataFrame:
    return rounded(kpis.battery_soc_by_date(f.daily_export, f.assets_export))


@_query
def emissions_by_date(f: Fleet) -> DataFrame:
    return rounded(kpis.emissions_by_date(f.daily_export, f.assets_export))


@_query
def series_summary(f: Fleet) -> DataFrame:
    return rounded(kpis.series_summary(kpis.generation_by_date(f.daily_export)))


@_query
def asset_bars(f: Fleet) -> DataFrame:
    return rounded(kpis.asset_bars(f.daily_export, f.assets_export))


@_query
def type_split(f: Fleet) -> DataFrame:
    return rounded(kpis.type_split(f.daily_export, f.assets_export))


@_query
def generation_mix(f: Fleet) -> DataFrame:
    return rounded(kpis.generation_mix(f.daily_export, f.assets_export))


@_query
def fleet_roster(f: Fleet) -> DataFrame:
    return rounded(kpis.fleet_roster(f.daily_export, f.assets_export))


# --- sources and sinks -------------------------------------------------------


@_query
def upsert_latest(f: Fleet) -> DataFrame:
    """Two loads merged into one stored table, the newer record of an hour winning."""
    path = f.scratch("raw-generation")
    early = f.raw_generation.filter(F.col("_load_id") % 3 != 0)
    late = f.raw_generation.filter(F.col("_load_id") % 3 == 0)
    tables.upsert(f.spark, path, early)
    tables.upsert(f.spark, path, late)
    return rounded(tables.read_landing(f.spark, path))


@_query
def upsert_weather(f: Fleet) -> DataFrame:
    """The same for weather."""
    path = f.scratch("raw-weather")
    tables.upsert(f.spark, path, f.raw_weather.filter(F.col("_load_id") % 5 != 0))
    tables.upsert(f.spark, path, f.raw_weather.filter(F.col("_load_id") % 5 == 0))
    return rounded(tables.read_landing(f.spark, path))


@_query
def schema_evolution(f: Fleet) -> DataFrame:
    """A later load brings a column, a last one lacks it, and some rows have no timestamp."""
    path = f.scratch("raw-evolving")
    columns = ["timestamp", "asset_id", "gross_generation_mwh", "_load_id"]
    third = F.col("_load_id") % 3
    lost = F.when(F.col("_load_id") % 11 != 0, F.col("timestamp")).alias("timestamp")
    rows = f.raw_generation.select("*", third.alias("_third"))
    pick = lambda k, *more: rows.filter(F.col("_third") == k).select(lost, *columns[1:], *more)
    tables.upsert(f.spark, path, pick(0))
    tables.upsert(f.spark, path, pick(1, "availability_pct"))
    tables.upsert(f.spark, path, pick(2))
    return rounded(tables.read_landing(f.spark, path))


@_query
def lookback_window(f: Fleet) -> DataFrame:
    def smooth(df: DataFrame) -> DataFrame:
        return ts.add_rolling_stats(
            df, "total_net_generation_mwh", [3], ["mean"], "asset_id", order_by="date"
        )

    return rounded(tables.with_lookback(_daily_net(f), LOOKBACK_DAY, smooth))


@_query
def day_partition(f: Fleet) -> DataFrame:
    return rounded(tables.day_partition(f.generation, LOOKBACK_DAY))


@_query
def filter_date_range(f: Fleet) -> DataFrame:
    return ts.filter_by_date_range(
        f.stg_generation.select(*KEYS, "date", "net_generation_mwh"),
        "timestamp", "2024-01-05 00:00:00", "2024-01-10 12:00:00", partition_col="date",
    )


@_query
def parquet_roundtrip(f: Fleet) -> DataFrame:
    path = f.scratch("landing-weather")
    tables.save_landing(f.weather, path)
    return rounded(tables.read_landing(f.spark, path))


@_query
def json_export_roundtrip(f: Fleet) -> DataFrame:
    path = f.scratch("daily-json")
    records.write_json(f.daily_export, path)
    return records.read_daily_json(f.spark, path)


@_query
def weather_json_roundtrip(f: Fleet) -> DataFrame:
    path = f.scratch("weather-json")
    records.write_json(f.weather_export, path)
    return records.read_weather_json(f.spark, path)


@_query
def assets_json_roundtrip(f: Fleet) -> DataFrame:
    path = f.scratch("assets-json")
    records.write_json(f.assets_export, path)
    return records.read_assets_json(f.spark, path)


@_query
def manifest(f: Fleet) -> DataFrame:
    one = export.manifest(
        f.daily_export, f.weather_export, f.assets_export, "run-1", "warehouse",
        "2024-02-01T00:00:00Z",
    )
    return one.select(
        "generated_at", "pipeline_run_id",
        F.col("date_range.start").alias("first_day"), F.col("date_range.end").alias("last_day"),
        "asset_count", F.to_json("asset_type_counts").alias("asset_type_counts"),
        "weather_source",
        F.col("row_counts.daily_performance").alias("daily_rows"),
        F.col("row_counts.weather_performance").alias("weather_rows"),
        "schema_version",
    )


@_query
def flatten_hourly_payload(f: Fleet) -> DataFrame:
    path = f.scratch("archive")
    records.hourly_payload(f.weather).write.json(path)
    return rounded(records.flatten_hourly(records.read_archive_payload(f.spark, path)))


@_query
def csv_seed_roundtrip(f: Fleet) -> DataFrame:
    path = f.scratch("assets-csv")
    records.write_asset_seed(f.assets, path)
    return records.read_asset_seed(f.spark, path)


@_query
def contract_checked_mart(f: Fleet) -> DataFrame:
    """The weather mart written under its contract and read back."""
    path = f.scratch("weather-mart")
    mart = contracts.published_dates(f.weather_mart)
    contracts.write_with_contract(mart, contracts.WEATHER_PERFORMANCE, path)
    return tables.current_table(f.spark, path)


@_query
def contract_daily_mart(f: Fleet) -> DataFrame:
    """The daily mart published under its contract; days without a total cannot keep it."""
    path = f.scratch("daily-mart")
    must = [c.name for c in contracts.PERFORMANCE_DAILY if not c.nullable]
    contracts.write_with_contract(
        contracts.published_dates(f.daily_mart.dropna(subset=must)), contracts.PERFORMANCE_DAILY, path
    )
    return tables.current_table(f.spark, path)


@_query
def contract_dim_asset(f: Fleet) -> DataFrame:
    path = f.scratch("dim-asset")
    contracts.write_with_contract(f.dim_asset, contracts.DIM_ASSET, path)
    return tables.current_table(f.spark, path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Fleet], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Fleet(spark, folder))

    return {name: bind(build) for name, build in QUERIES.items()}
