"""Column contracts of the published tables, and their enforcement on write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.operators.quality import ColumnRule, not_null, observed, observed_report
from voltseries.sources.tables import replace_table

# Names, types and NOT NULL columns of the published tables, in their order.
PERFORMANCE_DAILY = T.StructType(
    [
        T.StructField("asset_id", T.StringType(), False),
        T.StructField("date", T.TimestampNTZType(), False),
        T.StructField("asset_type", T.StringType(), False),
        T.StructField("asset_capacity_mw", T.DoubleType(), True),
        T.StructField("asset_size_category", T.StringType(), True),
        T.StructField("total_gross_generation_mwh", T.DoubleType(), True),
        T.StructField("total_net_generation_mwh", T.DoubleType(), False),
        T.StructField("total_curtailment_mwh", T.DoubleType(), True),
        T.StructField("avg_hourly_net_mwh", T.DoubleType(), True),
        T.StructField("peak_hourly_net_mwh", T.DoubleType(), True),
        T.StructField("avg_soc_pct", T.DoubleType(), True),
        T.StructField("total_charge_mwh", T.DoubleType(), True),
        T.StructField("total_discharge_mwh", T.DoubleType(), True),
        T.StructField("total_fuel_mmbtu", T.DoubleType(), True),
        T.StructField("avg_heat_rate_btu_kwh", T.DoubleType(), True),
        T.StructField("total_co2_tonnes", T.DoubleType(), True),
        T.StructField("daily_capacity_factor", T.DoubleType(), False),
        T.StructField("avg_hourly_capacity_factor", T.DoubleType(), True),
        T.StructField("avg_availability_pct", T.DoubleType(), True),
        T.StructField("min_availability_pct", T.DoubleType(), True),
        T.StructField("daily_loss_percentage", T.DoubleType(), True),
        T.StructField("daily_curtailment_percentage", T.DoubleType(), True),
        T.StructField("total_hours", T.LongType(), True),
        T.StructField("generating_hours", T.LongType(), True),
        T.StructField("high_output_hours", T.LongType(), True),
        T.StructField("generating_hours_pct", T.DoubleType(), True),
        T.StructField("excellent_hours", T.LongType(), True),
        T.StructField("good_hours", T.LongType(), True),
        T.StructField("fair_hours", T.LongType(), True),
        T.StructField("poor_hours", T.LongType(), True),
        T.StructField("avg_wind_speed_mps", T.DoubleType(), True),
        T.StructField("max_wind_speed_mps", T.DoubleType(), True),
        T.StructField("avg_ghi", T.DoubleType(), True),
        T.StructField("max_ghi", T.DoubleType(), True),
        T.StructField("total_ghi", T.DoubleType(), True),
        T.StructField("avg_temperature_c", T.DoubleType(), True),
        T.StructField("strong_wind_hours", T.LongType(), True),
        T.StructField("daylight_hours", T.LongType(), True),
        T.StructField("data_validity_pct", T.DoubleType(), True),
        T.StructField("data_completeness_pct", T.DoubleType(), True),
        T.StructField("zero_generation_anomaly_count", T.LongType(), True),
        T.StructField("daily_performance_rating", T.StringType(), True),
        T.StructField("meets_availability_target", T.BooleanType(), True),
        T.StructField("has_high_quality_data", T.BooleanType(), True),
        T.StructField("first_generation_timestamp", T.TimestampNTZType(), True),
        T.StructField("last_generation_timestamp", T.TimestampNTZType(), True),
    ]
)

WEATHER_PERFORMANCE = T.StructType(
    [
        T.StructField("asset_id", T.StringType(), False),
        T.StructField("date", T.TimestampNTZType(), False),
        T.StructField("asset_capacity_mw", T.DoubleType(), True),
        T.StructField("wind_generation_correlation", T.DoubleType(), True),
        T.StructField("solar_generation_correlation", T.DoubleType(), True),
        T.StructField("wind_cf_correlation", T.DoubleType(), True),
        T.StructField("solar_cf_correlation", T.DoubleType(), True),
        T.StructField("wind_r_squared", T.DoubleType(), True),
        T.StructField("solar_r_squared", T.DoubleType(), True),
        T.StructField("wind_regression_slope", T.DoubleType(), True),
        T.StructField("wind_regression_intercept", T.DoubleType(), True),
        T.StructField("solar_regression_slope", T.DoubleType(), True),
        T.StructField("solar_regression_intercept", T.DoubleType(), True),
        T.StructField("avg_expected_generation_mwh", T.DoubleType(), True),
        T.StructField("avg_actual_generation_mwh", T.DoubleType(), True),
        T.StructField("avg_performance_ratio_pct", T.DoubleType(), True),
        T.StructField("performance_score", T.DoubleType(), False),
        T.StructField("performance_category", T.StringType(), True),
        T.StructField("rolling_7d_avg_generation", T.DoubleType(), True),
        T.StructField("rolling_7d_avg_cf", T.DoubleType(), True),
        T.StructField("rolling_30d_avg_generation", T.DoubleType(), True),
        T.StructField("rolling_30d_avg_cf", T.DoubleType(), True),
        T.StructField("inferred_asset_type", T.StringType(), False),
        T.StructField("total_hourly_observations", T.LongType(), True),
    ]
)

DIM_ASSET = T.StructType(
    [
        T.StructField("asset_id", T.StringType(), False),
        T.StructField("asset_name", T.StringType(), False),
        T.StructField("asset_type", T.StringType(), False),
        T.StructField("asset_capacity_mw", T.DoubleType(), True),
        T.StructField("asset_size_category", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("region", T.StringType(), True),
    ]
)


class ContractError(ValueError):
    """A frame does not match the contract of the table it is written to."""


def published_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """The day as a midnight timestamp, the type the contracts publish."""
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def assert_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Check names, types and NOT NULL columns; returns the columns in contract order.

    Names and types come from the plan. NULLs are counted, all columns in one pass.
    """
    _check_names(df, contract)
    required = [f.name for f in contract.fields if not f.nullable]
    if required:
        nulls = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in required]).first()
        broken = [f"{n}: {nulls[n]} NULLs" for n in required if nulls[n]]
        if broken:
            raise ContractError("; ".join(broken))
    return df.select(*contract.fieldNames())


def _check_names(df: DataFrame, contract: T.StructType) -> None:
    """Raise if the columns of the plan are not those of the contract, by name and type."""
    wanted = {f.name: f for f in contract.fields}
    found = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing {n}" for n in wanted if n not in found]
    problems += [f"unexpected {n}" for n in found if n not in wanted]
    problems += [
        f"{n} is {found[n].simpleString()}, not {f.dataType.simpleString()}"
        for n, f in wanted.items()
        if n in found and found[n] != f.dataType
    ]
    if problems:
        raise ContractError("; ".join(problems))


def write_with_contract(
    df: DataFrame, contract: T.StructType, path: str, rules: Sequence[ColumnRule] = ()
) -> DataFrame:
    """Store a new version of a table that keeps its contract; returns the report of ``rules``.

    Names and types are checked before anything is written. NULLs in required columns and
    the rows that break a rule are counted while the table is written, so there is one job,
    and neither the input nor the stored table is read again. The version becomes current
    only if no required value is missing: readers of ``tables.current_table`` see the old one
    until then. Rules only report.
    """
    _check_names(df, contract)
    names = contract.fieldNames()
    required = [not_null(f.name) for f in contract.fields if not f.nullable]
    watched, watch = observed(df.select(*names), [*required, *rules])

    def check(_: DataFrame) -> None:
        counts = watch.get
        broken = [f"{r.column}: {counts[f'r{i}']} NULLs" for i, r in enumerate(required) if counts[f"r{i}"]]
        if broken:
            raise ContractError("; ".join(broken))

    replace_table(watched, path, check=check)
    return observed_report(df.sparkSession, watch, [*required, *rules])
