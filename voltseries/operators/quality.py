"""Data-quality rules, evaluated together in one pass per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltseries.functions.categories import TECHNOLOGIES
from voltseries.functions.numeric import true_when

# Limits of the standing checks.
FRESHNESS_HOURS = 48
MIN_ROWS = 100
CURRENT_DAYS = 2
WEATHER_LIMITS = {
    "wind_speed_mps": (0.0, 50.0),
    "temperature_c": (-50.0, 60.0),
    "relative_humidity": (0.0, 100.0),
}
GENERATION_LIMITS = {"net_generation_mwh": (0.0, None), "capacity_factor": (0.0, 1.0)}


@dataclass(frozen=True)
class ColumnRule:
    """A rule on the values of one column; NULLs break only ``not_null``."""

    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    where: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    def broken(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            bad = c.isNull()
        elif self.kind == "accepted_values":
            bad = ~c.isin(list(self.values))
        elif self.kind == "accepted_range":
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | ((c < self.low) if self.inclusive else (c <= self.low))
            if self.high is not None:
                bad = bad | ((c > self.high) if self.inclusive else (c >= self.high))
        else:
            raise ValueError(f"unknown rule {self.kind}")
        if self.where:
            bad = bad & F.expr(self.where)
        return true_when(bad)


@dataclass(frozen=True)
class UniqueRule:
    """No two rows share the values of ``columns``."""

    columns: tuple[str, ...]
    severity: str = "error"

    @property
    def name(self) -> str:
        return "unique:" + ",".join(self.columns)


Rule = ColumnRule | UniqueRule


def not_null(column: str, severity: str = "error") -> ColumnRule:
    return ColumnRule("not_null", column, severity=severity)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> ColumnRule:
    return ColumnRule("accepted_values", column, values=tuple(values), severity=severity)


def accepted_range(
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
    where: str | None = None,
    severity: str = "error",
) -> ColumnRule:
    return ColumnRule(
        "accepted_range", column, low=low, high=high, inclusive=inclusive, where=where,
        severity=severity,
    )


def unique(*columns: str, severity: str = "error") -> UniqueRule:
    return UniqueRule(tuple(columns), severity)


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return (
        df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def repeated_keys(df: DataFrame, rules: Sequence[UniqueRule]) -> DataFrame:
    """(rule_no, key, n_records): the keys of all uniqueness rules that occur more than once.

    Each row is expanded by rule; one grouped count over (rule, key) serves all of them, so
    the input is read, and its keys are shuffled, once. A key is the text of its columns; a
    key with a NULL takes no part.
    """
    keys = []
    for i, rule in enumerate(rules):
        # 0.0 and -0.0 are equal, their texts are not.
        texts = [_key_text(df, c) for c in rule.columns]
        whole = F.array(*texts)
        complete = ~F.exists(whole, lambda x: x.isNull())
        keys.append(F.when(complete, F.struct(F.lit(i).alias("rule_no"), whole.alias("key"))))
    return (
        df.select(F.inline(F.array_compact(F.array(*keys))))
        .groupBy("rule_no", "key")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def _key_text(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)
    return value.cast("string")


def unique_report(df: DataFrame, rules: Sequence[UniqueRule]) -> DataFrame:
    """One row per uniqueness rule: repeated keys, the rows that hold them, and the largest group."""
    found = repeated_keys(df, rules).groupBy("rule_no").agg(
        F.count(F.lit(1)).alias("failures"), F.sum("n_records").alias("n_records"), F.max("n_records").alias("largest")
    )
    entries = [F.struct(F.lit(i).alias("rule_no"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity")) for i, r in enumerate(rules)]
    named = df.sparkSession.range(1).select(F.inline(F.array(*entries)))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("failures", "n_records", "largest")]
    return _with_status(named.join(found, "rule_no", "left").select("rule", "severity", *zero))


def _with_status(report: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return report.withColumn("status", status)


def observed(df: DataFrame, rules: Sequence[ColumnRule]) -> tuple[DataFrame, Observation]:
    """The frame, counting the broken rows of each rule while whatever reads it runs.

    The counts are there once an action has read the whole frame.
    """
    watch = Observation()
    counts = [F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)]
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows"), *counts), watch


def observed_report(spark: SparkSession, watch: Observation, rules: Sequence[ColumnRule]) -> DataFrame:
    """The rows of ``rule_report`` from the counts of a finished action."""
    counts = watch.get
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.lit(int(counts[f"r{i}"])).cast("bigint").alias("failures")) for i, r in enumerate(rules)]
    return _with_status(spark.range(1).select(F.inline(F.array(*rows))))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: failures, severity and status (pass, warn, fail).

    Failures are broken rows, or for uniqueness the keys that occur more than once.
    All column rules share one aggregate, and several uniqueness rules one shuffle.
    """
    parts = []
    column_rules = [r for r in rules if isinstance(r, ColumnRule)]
    if column_rules:
        counts = df.agg(
            *[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(column_rules)]
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.severity).alias("severity"),
                    F.col(f"r{i}").alias("failures"),
                )
                for i, r in enumerate(column_rules)
            ]
        )
        parts.append(counts.select(F.inline(entries)))
    unique_rules = [r for r in rules if isinstance(r, UniqueRule)]
    if len(unique_rules) > 1:
        parts.append(unique_report(df, unique_rules).select("rule", "severity", "failures"))
    elif unique_rules:
        (rule,) = unique_rules
        parts.append(
            unique_violations(df, rule.columns)
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.severity).alias("severity"),
                "failures",
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return _with_status(report)


def failing_rows(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Rows that break any column rule, with the names of the rules they break."""
    names = F.array_compact(
        F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules])
    )
    return df.withColumn("failed_rules", names).filter(F.size("failed_rules") > 0)


def store_failures(df: DataFrame, rules: Sequence[Rule], folder: str) -> None:
    """Write failing rows, and repeated keys per uniqueness rule, for later review.

    The repeated keys of all uniqueness rules are found in one shuffle and stored; a rule's own
    folder, with the columns of its key, is written from these few rows.
    """
    columns = [r for r in rules if isinstance(r, ColumnRule)]
    if columns:
        failing_rows(df, columns).write.mode("overwrite").parquet(f"{folder}/rows")
    unique_rules = [r for r in rules if isinstance(r, UniqueRule)]
    if len(unique_rules) == 1:
        (rule,) = unique_rules
        unique_violations(df, rule.columns).write.mode("overwrite").parquet(f"{folder}/unique_{'_'.join(rule.columns)}")
    elif unique_rules:
        repeated_keys(df, unique_rules).write.mode("overwrite").parquet(f"{folder}/repeated_keys")
        found = df.sparkSession.read.schema("rule_no int, key array<string>, n_records long").parquet(f"{folder}/repeated_keys")
        for i, rule in enumerate(unique_rules):
            names = [F.col("key")[j].cast(df.schema[c].dataType).alias(c) for j, c in enumerate(rule.columns)]
            own = found.filter(F.col("rule_no") == i).select(*names, "n_records")
            own.write.mode("overwrite").parquet(f"{folder}/unique_{'_'.join(rule.columns)}")


def freshness(
    df: DataFrame,
    now: dt.datetime,
    max_hours: int = FRESHNESS_HOURS,
    timestamp_col: str = "timestamp",
) -> DataFrame:
    """One row: newest timestamp, whether it is young enough, and why not.

    ``now`` is UTC; a naive value is read as UTC.
    """
    if now.tzinfo is not None:
        now = now.astimezone(dt.UTC).replace(tzinfo=None)
    cutoff = F.lit((now - dt.timedelta(hours=max_hours)).isoformat()).cast("timestamp_ntz")
    newest = F.col("max_timestamp")
    return df.agg(F.max(timestamp_col).alias("max_timestamp")).select(
        "max_timestamp",
        F.lit(max_hours).alias("threshold_hours"),
        true_when(newest >= cutoff).alias("passed"),
        F.when(newest.isNull(), "no rows").alias("reason"),
    )


def row_count_check(df: DataFrame, minimum: int = MIN_ROWS) -> DataFrame:
    count = F.count(F.lit(1))
    return df.agg(
        count.alias("row_count"),
        F.lit(minimum).alias("minimum"),
        (count >= minimum).alias("passed"),
    )


def _outside(limits: dict[str, tuple[float | None, float | None]]) -> Column:
    bad = F.lit(False)
    for column, (low, high) in limits.items():
        if low is not None:
            bad = bad | (F.col(column) < low)
        if high is not None:
            bad = bad | (F.col(column) > high)
    return bad


def _violations(df: DataFrame, bad: Column) -> DataFrame:
    count = F.count_if(bad)
    return df.agg(count.alias("out_of_range_rows"), (count == 0).alias("passed"))


def weather_range_check(weather: DataFrame) -> DataFrame:
    return _violations(weather, _outside(WEATHER_LIMITS))


def generation_range_check(generation: DataFrame) -> DataFrame:
    """Batteries are left out: a charging battery is a net load."""
    return _violations(
        generation, (F.col("asset_type") != "battery") & _outside(GENERATION_LIMITS)
    )


def data_age(df: DataFrame, now: dt.datetime, date_col: str = "date") -> DataFrame:
    """One row: whole days between the newest day and ``now``, and the badge text."""
    stamp = F.lit(now.replace(tzinfo=None).isoformat()).cast("timestamp_ntz")
    newest = F.max(date_col).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", newest, stamp)
    return df.agg(F.floor(seconds / 86400).alias("days")).select(
        "days",
        F.when(F.col("days") <= CURRENT_DAYS, "data current")
        .otherwise(F.concat(F.lit("data "), F.col("days").cast("string"), F.lit(" days behind")))
        .alias("badge"),
    )


# Standing rules of the tables.
_OUTPUT_RANGE = dict(low=0, high=1.1, where="asset_type <> 'battery'")

RAW_WEATHER_RULES: tuple[Rule, ...] = (
    *[
        not_null(c)
        for c in (
            "timestamp", "asset_id", "wind_speed_mps", "wind_direction_deg", "ghi",
            "temperature_c", "pressure_hpa", "relative_humidity",
        )
    ],
    accepted_range("wind_speed_mps", 0, 50),
    accepted_range("wind_direction_deg", 0, 360),
    accepted_range("ghi", 0, 1500),
    accepted_range("temperature_c", -50, 60),
    accepted_range("pressure_hpa", 900, 1100),
    accepted_range("relative_humidity", 0, 100),
    unique("asset_id", "timestamp", severity="warn"),
)
RAW_GENERATION_RULES: tuple[Rule, ...] = (
    *[
        not_null(c)
        for c in (
            "timestamp", "asset_id", "asset_type", "gross_generation_mwh",
            "net_generation_mwh", "curtailment_mwh", "availability_pct", "asset_capacity_mw",
        )
    ],
    accepted_values("asset_type", TECHNOLOGIES),
    accepted_range("gross_generation_mwh", 0),
    accepted_range("net_generation_mwh", 0, where="asset_type <> 'battery'"),
    accepted_range("curtailment_mwh", 0),
    accepted_range("availability_pct", 0, 100),
    accepted_range("asset_capacity_mw", 0, 1000),
    unique("asset_id", "timestamp", severity="warn"),
)
STG_WEATHER_RULES: tuple[Rule, ...] = (
    *[
        not_null(c)
        for c in ("timestamp", "asset_id", "wind_speed_mps", "ghi", "is_data_complete")
    ],
    unique("asset_id", "timestamp"),
)
STG_GENERATION_RULES: tuple[Rule, ...] = (
    *[
        not_null(c)
        for c in (
            "timestamp", "asset_id", "asset_type", "net_generation_mwh", "capacity_factor",
            "is_data_valid",
        )
    ],
    accepted_values("asset_type", TECHNOLOGIES),
    accepted_range("capacity_factor", **_OUTPUT_RANGE),
    unique("asset_id", "timestamp"),
)
INT_WEATHER_DAILY_RULES: tuple[Rule, ...] = (
    not_null("asset_id"),
    not_null("date"),
    unique("asset_id", "date"),
)
INT_GENERATION_DAILY_RULES: tuple[Rule, ...] = (
    not_null("asset_id"),
    not_null("date"),
    not_null("total_net_generation_mwh"),
    accepted_range("daily_capacity_factor", **_OUTPUT_RANGE),
    unique("asset_id", "date"),
)
INT_JOIN_RULES: tuple[Rule, ...] = (
    not_null("timestamp"),
    not_null("asset_id"),
    not_null("is_complete_record"),
    unique("asset_id", "timestamp"),
)
DAILY_MART_RULES: tuple[Rule, ...] = (
    *[
        not_null(c)
        for c in (
            "asset_id", "date", "asset_type", "total_net_generation_mwh",
            "daily_capacity_factor",
        )
    ],
    accepted_values("asset_type", TECHNOLOGIES),
    accepted_range("daily_capacity_factor", **_OUTPUT_RANGE),
    accepted_range("avg_availability_pct", 0, 100),
    unique("asset_id", "date"),
)
DIM_ASSET_RULES: tuple[Rule, ...] = (
    not_null("asset_id"),
    unique("asset_id"),
    accepted_values("asset_type", TECHNOLOGIES),
)
WEATHER_MART_RULES: tuple[Rule, ...] = (
    *[
        not_null(c)
        for c in ("asset_id", "date", "performance_score", "inferred_asset_type")
    ],
    accepted_range("wind_generation_correlation", -1, 1),
    accepted_range("solar_generation_correlation", -1, 1),
    accepted_range("performance_score", 0, 100),
    accepted_values("inferred_asset_type", TECHNOLOGIES),
    unique("asset_id", "date"),
)
