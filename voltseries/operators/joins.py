"""Dimension lookup and alignment on a shared hour axis.

No join carries a broadcast hint: Catalyst and AQE broadcast a side whose measured
size is under the threshold, and split skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_technology(rows: DataFrame, assets: DataFrame, default: str = "") -> DataFrame:
    """Add ``technology``: the row's own type, else the dimension's, else a default.

    An own type of empty text counts as missing; the dimension's text is taken as it is.
    """
    lookup = assets.select("asset_id", F.col("asset_type").alias("_dim_type"))
    own = F.nullif(F.col("asset_type"), F.lit("")) if "asset_type" in rows.columns else F.lit(None)
    return (
        rows.join(lookup, "asset_id", "left")
        .withColumn(
            "technology",
            F.coalesce(own, F.col("_dim_type"), F.lit(default)),
        )
        .drop("_dim_type")
    )


def select_assets(
    rows: DataFrame,
    assets: DataFrame | None = None,
    technology: str | None = None,
    asset_ids: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    date_col: str = "date",
) -> DataFrame:
    """Rows of the chosen assets and days; both day bounds inclusive."""
    if technology is not None:
        if assets is None:
            raise ValueError("a technology filter needs the asset dimension")
        chosen = assets.filter(F.col("asset_type") == technology).select("asset_id")
        rows = rows.join(chosen, "asset_id", "left_semi")
    if asset_ids is not None:
        rows = rows.filter(F.col("asset_id").isin(list(asset_ids)))
    if start is not None:
        rows = rows.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return rows


def align_to_hours(
    series: DataFrame,
    assets: DataFrame,
    value: str,
    default: float = 0.0,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Every asset at every timestamp that occurs anywhere; gaps get ``default``.

    The result has assets × timestamps rows by definition, so the axis should be an
    hourly one. Timestamps off the hour are kept, each as a point of the axis. With
    ``start`` and ``end`` (inclusive) a record outside them is an error, as a null
    timestamp always is. Every asset expands the days that occur, and meets the
    timestamps of each day in an equi-join.
    """
    stamp = F.col("timestamp")
    wrong = stamp.isNull()
    for bound, outside in ((start, lambda b: stamp < b), (end, lambda b: stamp > b)):
        if bound is not None:
            wrong = wrong | outside(F.lit(bound).cast(series.schema["timestamp"].dataType))
    checked = F.when(wrong, F.raise_error("a timestamp is null or outside the hour range")).otherwise(stamp)
    rows = series.select("asset_id", checked.alias("timestamp"), value)
    axis = rows.select("timestamp").distinct().withColumn("_day", F.to_date("timestamp"))
    # One entry per calendar day.
    days = axis.agg(F.collect_set("_day").alias("days")).scalar()
    points = (
        assets.select("asset_id")
        .withColumn("_days", days)
        .select("asset_id", F.explode("_days").alias("_day"))
        .join(axis, "_day")
        .drop("_day")
    )
    return points.join(rows, ["asset_id", "timestamp"], "left").withColumn(
        value, F.coalesce(value, F.lit(float(default)))
    )
