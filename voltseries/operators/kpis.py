"""Fleet figures and series of the dashboard, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltseries.functions.categories import GENERATING, WEATHER_DRIVEN
from voltseries.operators.joins import with_technology

# Stacking order of the generation mix.
MIX_ORDER = ("wind", "solar", "gas", "battery")
MIN_BAR_PCT = 1.5
FIGURES = (
    "net_generation", "capacity_factor", "mean_capacity_factor", "battery_soc", "gas_emissions",
    "battery_throughput", "curtailment",
)


def _zero(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0))


def _sum0(c: Column | str) -> Column:
    return _zero(F.sum(c))


def fleet_totals(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """One row of headline figures, from one pass over the daily rows."""
    rows = with_technology(daily, assets)
    kind, net = F.col("technology"), F.col("total_net_generation_mwh")
    generating = kind.isin(*GENERATING)
    served = _sum0(F.when(generating, net))
    renewable = _sum0(F.when(kind.isin(*WEATHER_DRIVEN), net))
    return rows.agg(
        _sum0(net).alias("net_generation"),
        _zero(F.avg(F.when(generating, _zero("daily_capacity_factor")))).alias("capacity_factor"),
        F.when(served > 0, F.try_divide(renewable, served) * 100.0)
        .otherwise(F.lit(0.0))
        .alias("renewable_share"),
        _sum0("total_co2_tonnes").alias("co2_emissions"),
        _sum0(F.when(kind == "battery", F.col("total_discharge_mwh"))).alias(
            "battery_throughput"
        ),
        _sum0("total_curtailment_mwh").alias("curtailment"),
    )


def fleet_kpis(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Six rows: key, label, value, display text and unit."""
    # Keys, labels and units of the headline strip.
    strip = [
        ("net_generation", "net generation", "MWh"),
        ("capacity_factor", "fleet capacity factor", "wind · solar · gas"),
        ("renewable_share", "renewable share", "of served load"),
        ("co2_emissions", "CO₂ emissions", "tonnes"),
        ("battery_throughput", "battery discharge", "MWh delivered"),
        ("curtailment", "curtailment", "MWh"),
    ]

    def display(key: str) -> Column:
        if key == "capacity_factor":
            return F.concat(F.format_number(F.col(key) * 100, 1), F.lit("%"))
        if key == "renewable_share":
            return F.concat(F.format_number(key, 0), F.lit("%"))
        return F.format_number(key, 0)

    entries = F.array(
        *[
            F.struct(
                F.lit(key).alias("key"),
                F.lit(label).alias("label"),
                F.col(key).alias("value"),
                display(key).alias("display"),
                F.lit(unit).alias("unit"),
            )
            for key, label, unit in strip
        ]
    )
    return fleet_totals(daily, assets).select(F.inline(entries))


def figures_by_grouping(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """The figures of the whole fleet and per day, asset and technology, from one pass.

    ``scope`` says what a row is about: total, date, asset or technology; the columns of the
    other groupings are NULL. A row of ``daily`` goes to one partial sum per grouping before the
    only shuffle.
    """
    kind, net = F.col("technology"), F.col("total_net_generation_mwh")
    rows = with_technology(daily, assets, "unknown")
    factor = _zero("daily_capacity_factor")
    values = [
        _sum0(net).alias("net_generation"),
        F.avg(F.when(kind.isin(*GENERATING), factor)).alias("capacity_factor"),
        F.avg(factor).alias("mean_capacity_factor"),
        F.avg(F.when(kind == "battery", F.col("avg_soc_pct"))).alias("battery_soc"),
        _sum0(F.when(kind == "gas", F.col("total_co2_tonnes"))).alias("gas_emissions"),
        _sum0(F.when(kind == "battery", F.col("total_discharge_mwh"))).alias("battery_throughput"),
        _sum0("total_curtailment_mwh").alias("curtailment"),
    ]
    # The grouped columns are NULL in the other sets, so the figures read a copy of the technology.
    keyed = rows.withColumn("_kind", kind)
    sets = keyed.groupingSets([["date"], ["asset_id"], ["_kind"], []], "date", "asset_id", "_kind")
    number = F.grouping_id("date", "asset_id", "_kind")
    scope = F.element_at(F.lit(["technology", "asset", "date", "total"]), F.col("_set"))
    place = F.when(number == 6, 1).when(number == 5, 2).when(number == 3, 3).otherwise(4)
    return (
        sets.agg(place.alias("_set"), *values)
        .withColumn("scope", scope)
        .select("scope", "date", "asset_id", F.col("_kind").alias("technology"), *FIGURES)
    )


def generation_by_date(daily: DataFrame) -> DataFrame:
    return daily.groupBy("date").agg(_sum0("total_net_generation_mwh").alias("value"))


def capacity_factor_by_date(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Mean capacity factor of wind, solar and gas."""
    rows = with_technology(daily, assets).filter(F.col("technology").isin(*GENERATING))
    return rows.groupBy("date").agg(F.avg(_zero("daily_capacity_factor")).alias("value"))


def score_by_date(weather: DataFrame) -> DataFrame:
    return weather.groupBy("date").agg(F.avg(_zero("performance_score")).alias("value"))


def battery_soc_by_date(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Mean state of charge of the batteries that report one."""
    rows = with_technology(daily, assets).filter(
        (F.col("technology") == "battery") & F.col("avg_soc_pct").isNotNull()
    )
    return rows.groupBy("date").agg(F.avg("avg_soc_pct").alias("value"))


def emissions_by_date(daily: DataFrame, assets: DataFrame) -> DataFrame:
    rows = with_technology(daily, assets).filter(F.col("technology") == "gas")
    return rows.groupBy("date").agg(_sum0("total_co2_tonnes").alias("value"))


def _with_bar(rows: DataFrame, value: str = "value") -> DataFrame:
    """Add the share of the largest value in percent, at least 1.5; 0 if that is 0."""
    largest = rows.agg(_zero(F.max(value)).alias("m")).scalar()
    share = F.try_divide(F.col(value), F.col("_max")) * 100.0
    return (
        rows.withColumn("_max", largest)
        .withColumn(
            "pct",
            F.when(F.col("_max") != 0, F.greatest(F.lit(MIN_BAR_PCT), share)).otherwise(
                F.lit(0.0)
            ),
        )
        .drop("_max")
    )


def asset_bars(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Mean capacity factor per asset, its name and technology, and the bar length."""
    means = daily.groupBy("asset_id").agg(F.avg(_zero("daily_capacity_factor")).alias("value"))
    names = assets.select("asset_id", "display_name", "asset_type")
    return (
        _with_bar(means)
        .join(names, "asset_id", "left")
        .select(
            "asset_id",
            F.coalesce("display_name", "asset_id").alias("name"),
            F.coalesce("asset_type", F.lit("")).alias("asset_type"),
            "value",
            "pct",
        )
    )


def type_split(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Net generation per technology and the bar length."""
    rows = with_technology(daily, assets, "unknown")
    totals = rows.groupBy(F.col("technology").alias("asset_type")).agg(
        _sum0("total_net_generation_mwh").alias("value")
    )
    return _with_bar(totals)


def generation_mix(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Output per day and technology: batteries by discharge, others not below 0.

    Every day has every technology that produced anything at all.
    """
    rows = with_technology(daily, assets, "unknown")
    output = F.when(
        F.col("technology") == "battery", _zero("total_discharge_mwh")
    ).otherwise(F.greatest(F.lit(0.0), _zero("total_net_generation_mwh")))
    wide = (
        rows.withColumn("_output", output)
        .groupBy("date")
        .agg(
            *[
                _sum0(F.when(F.col("technology") == kind, F.col("_output"))).alias(kind)
                for kind in MIX_ORDER
            ]
        )
    )
    # One row with a flag per technology.
    flags = wide.agg(
        F.struct(
            *[F.coalesce(F.max(kind) > 0, F.lit(False)).alias(kind) for kind in MIX_ORDER]
        ).alias("flags")
    ).scalar()
    series = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"_present.{kind}"),
                    F.struct(
                        F.lit(i).alias("series"),
                        F.lit(kind).alias("asset_type"),
                        F.col(kind).alias("value"),
                    ),
                )
                for i, kind in enumerate(MIX_ORDER)
            ]
        )
    )
    return wide.withColumn("_present", flags).select("date", F.inline(series))


def cumulative_mix(mix: DataFrame) -> DataFrame:
    """Lower and upper edge of each technology's band when stacked, per day."""
    stack = Window.partitionBy("date").orderBy("series")
    below = F.sum("value").over(stack.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.sum("value").over(stack.rowsBetween(Window.unboundedPreceding, 0))
    return mix.select("*", _zero(below).alias("lower"), upto.alias("upper"))


def fleet_roster(daily: DataFrame, assets: DataFrame) -> DataFrame:
    """Capacity, region, mean capacity factor and generation per asset.

    Assets without daily rows stay, with 0.
    """
    sums = daily.groupBy("asset_id").agg(
        F.avg(_zero("daily_capacity_factor")).alias("capacity_factor"),
        _sum0("total_net_generation_mwh").alias("net_generation_mwh"),
    )
    return assets.join(sums, "asset_id", "left").select(
        "asset_id",
        F.coalesce("display_name", "asset_id").alias("name"),
        "asset_type",
        _zero("capacity_mw").alias("capacity_mw"),
        F.coalesce(F.nullif("region", F.lit("")), F.lit("—")).alias("region"),
        _zero("capacity_factor").alias("capacity_factor"),
        _zero("net_generation_mwh").alias("net_generation_mwh"),
    )


def series_summary(series: DataFrame) -> DataFrame:
    """First and last label and the largest value of a date series, one row."""
    return series.agg(
        F.min("date").alias("first_label"),
        F.max("date").alias("last_label"),
        F.max("value").alias("y_max"),
    ).filter(F.col("first_label").isNotNull())
