"""Metrics over the marts: named measures by dimensions, at a time grain."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published models, measures and metrics.
MODELS = {
    "asset_performance": {
        "table": "mart_asset_performance_daily",
        "time": {"date": "date"},
        "dimensions": {
            "asset_id": "asset_id",
            "asset_size_category": "asset_size_category",
            "daily_performance_rating": "daily_performance_rating",
        },
        "measures": {
            "total_generation": ("sum", "total_net_generation_mwh"),
            "avg_capacity_factor": ("average", "daily_capacity_factor"),
            "avg_temperature": ("average", "avg_temperature_c"),
            "avg_availability": ("average", "avg_availability_pct"),
            "total_curtailment": ("sum", "total_curtailment_mwh"),
        },
    },
    "asset_weather_performance": {
        "table": "mart_asset_weather_performance",
        "time": {"weather_date": "date"},
        "dimensions": {
            "asset_id": "asset_id",
            "weather_asset": "asset_id",
            "inferred_asset_type": "inferred_asset_type",
            "performance_category": "performance_category",
        },
        "measures": {
            "avg_performance_score": ("average", "performance_score"),
            "avg_actual_generation": ("average", "avg_actual_generation_mwh"),
            "avg_expected_generation": ("average", "avg_expected_generation_mwh"),
            "avg_performance_ratio": ("average", "avg_performance_ratio_pct"),
        },
    },
}
METRICS = {
    "daily_generation": "total_generation",
    "generation_efficiency": "avg_capacity_factor",
    "weather_adjusted_score": "avg_performance_score",
}
_AGGREGATES = {"sum": F.sum, "average": F.avg}
GRAINS = ("day", "week", "month", "quarter", "year")


def _model_of(measure: str) -> tuple[dict, str, str]:
    for model in MODELS.values():
        if measure in model["measures"]:
            how, column = model["measures"][measure]
            return model, how, column
    raise KeyError(f"unknown measure {measure}")


class LazyTables(Mapping[str, DataFrame]):
    """Tables by name, each planned at its first use and then kept."""

    def __init__(self, plans: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._plans, self._built = dict(plans), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._plans[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


def time_bucket(day: Column, grain: str) -> Column:
    """The first day of the day's week, month, quarter or year."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain}")
    return day.cast("date") if grain == "day" else F.trunc(day.cast("date"), grain)


def query_metric(
    marts: Mapping[str, DataFrame],
    metric: str | Sequence[str],
    group_by: Sequence[str] = (),
    grain: str | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Metrics (or measures) by dimensions, optionally per time bucket, filtered.

    Several metrics of one model share one pass. The time bucket comes out under
    the name of the model's time dimension.
    """
    names = [metric] if isinstance(metric, str) else list(metric)
    found = {name: _model_of(METRICS.get(name, name)) for name in names}
    model = found[names[0]][0]
    if any(m is not model for m, _, _ in found.values()):
        raise KeyError(f"{names} belong to different models")
    rows = marts[model["table"]]
    if where is not None:
        rows = rows.filter(where)
    keys = []
    if grain is not None:
        (name, time_column), = model["time"].items()
        keys.append(time_bucket(F.col(time_column), grain).alias(name))
    for dimension in group_by:
        if dimension not in model["dimensions"]:
            raise KeyError(f"{names} have no dimension {dimension}")
        keys.append(F.col(model["dimensions"][dimension]).alias(dimension))
    values = [_AGGREGATES[how](column).alias(name) for name, (_, how, column) in found.items()]
    return rows.groupBy(*keys).agg(*values) if keys else rows.agg(*values)


def on_spine(metric: DataFrame, spine: DataFrame, time_column: str) -> DataFrame:
    """A daily metric with a row for every day of the spine; gaps are NULL."""
    return spine.join(
        metric.withColumnRenamed(time_column, "date_day"), "date_day", "left"
    )
