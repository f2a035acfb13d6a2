"""Lag, lead, rolling and correlation features of time series.

Functions take the order as an argument, because a DataFrame has none of its own.
``partition_by`` names the series key. Without it, or with ``block_rows``, the
series is cut into blocks (see ``operators.ordering``) and may be of any length;
with it, each series is one window partition, which suits series whose length the
calendar bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from voltseries.functions.calendar import iso_weekday
from voltseries.functions.numeric import nan_to_null, ratio, safe_corr
from voltseries.operators import long_frames
from voltseries.operators.ordering import over_blocks

Names = str | Sequence[str]

DEFAULT_BLOCK_ROWS = 1_000_000
# Longer frames are merged from two growing parts instead of being computed for each row.
LONG_FRAME = 128
ROLLING_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def _names(value: Names | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def _counts(values: Sequence[int], what: str) -> Sequence[int]:
    if any(n < 1 for n in values):
        raise ValueError(f"{what} must be at least 1")
    return values


def _windowed(
    df: DataFrame,
    build: Callable[[WindowSpec], list[Column]],
    order_by: Names,
    partition_by: Names | None,
    back: int,
    ahead: int,
    block_rows: int | None,
    long: Callable[[DataFrame, Sequence[str], Sequence[str]], DataFrame] | None = None,
) -> DataFrame:
    order, keys = _names(order_by), _names(partition_by)
    if not build(Window.orderBy(*order)) and long is None:
        return df
    if keys and block_rows is None:
        plain = df.select("*", *build(Window.partitionBy(*keys).orderBy(*order)))
        return plain if long is None else long(plain, keys, order)
    return over_blocks(df, build, order, keys, back, ahead, block_rows or DEFAULT_BLOCK_ROWS, long)


def add_lag_features(
    df: DataFrame,
    column: str,
    lags: Sequence[int],
    partition_by: Names | None = None,
    *,
    order_by: Names,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ``{column}_lag_{n}``: the value n rows earlier."""
    _counts(lags, "lags")

    def build(w: WindowSpec) -> list[Column]:
        return [F.lag(column, n).over(w).alias(f"{column}_lag_{n}") for n in lags]

    return _windowed(df, build, order_by, partition_by, max(lags, default=0), 0, block_rows)


def add_lead_features(
    df: DataFrame,
    column: str,
    leads: Sequence[int],
    partition_by: Names | None = None,
    *,
    order_by: Names,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ``{column}_lead_{n}``: the value n rows later."""
    _counts(leads, "leads")

    def build(w: WindowSpec) -> list[Column]:
        return [F.lead(column, n).over(w).alias(f"{column}_lead_{n}") for n in leads]

    return _windowed(df, build, order_by, partition_by, 0, max(leads, default=0), block_rows)


def add_rolling_stats(
    df: DataFrame,
    column: str,
    window_sizes: Sequence[int],
    stats: Sequence[str] | None = None,
    partition_by: Names | None = None,
    *,
    order_by: Names,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ``{column}_rolling_{stat}_{n}`` over the last n rows.

    A value appears only where the frame is full and holds no NULL. Unknown
    statistic names are skipped. Features of frames up to ``LONG_FRAME`` share one sort;
    a longer one costs as much whatever its length (``operators.long_frames``).
    """
    chosen = [s for s in (stats or ["mean", "std"]) if s in ROLLING_STATS]
    short = [n for n in window_sizes if n <= LONG_FRAME]
    rest = [n for n in window_sizes if n > LONG_FRAME] if chosen else []

    def build(w: WindowSpec) -> list[Column]:
        out = []
        for size in short:
            frame = w.rowsBetween(-(size - 1), 0)
            full = F.count(column).over(frame) == size
            for stat in chosen:
                value = ROLLING_STATS[stat](column).over(frame)
                out.append(F.when(full, value).alias(f"{column}_rolling_{stat}_{size}"))
        return out

    def long(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        for size in rest:
            rows = long_frames.rolling_stats(rows, column, size, chosen, keys, order)
        return rows

    back = max(window_sizes, default=1) - 1
    found = _windowed(df, build, order_by, partition_by, back, 0, block_rows, long if rest else None)
    if not rest:
        return found
    # Columns in the order the sizes were asked for.
    return found.select(*df.columns, *[f"{column}_rolling_{s}_{n}" for n in window_sizes for s in chosen])


def calculate_correlation(
    df: DataFrame,
    col1: str,
    col2: str,
    window_size: int | None = None,
    partition_by: Names | None = None,
    *,
    order_by: Names | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Pearson correlation: per group, over the table, or rolling over n rows.

    The rolling form adds a column and needs ``order_by``; it is NULL until n rows
    with both values are in the frame. Constant input gives NULL.
    """
    if window_size is None:
        result = safe_corr(col1, col2).alias(f"corr_{col1}_{col2}")
        keys = _names(partition_by)
        return df.groupBy(*keys).agg(result) if keys else df.agg(result)
    if order_by is None:
        raise ValueError("a rolling correlation needs order_by")
    name = f"corr_{col1}_{col2}_rolling_{window_size}"

    def build(w: WindowSpec) -> list[Column]:
        frame = w.rowsBetween(-(window_size - 1), 0)
        both = F.when(F.col(col1).isNotNull() & F.col(col2).isNotNull(), F.lit(1))
        full = F.count(both).over(frame) == window_size
        return [F.when(full, safe_corr(col1, col2, frame)).alias(name)]

    def long(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        x, y = nan_to_null(col1), nan_to_null(col2)
        return long_frames.rolling_correlation(rows, x, y, window_size, name, keys, order)

    if window_size > LONG_FRAME:
        return _windowed(df, lambda w: [], order_by, partition_by, window_size - 1, 0, block_rows, long)
    return _windowed(df, build, order_by, partition_by, window_size - 1, 0, block_rows)


def add_time_features(df: DataFrame, timestamp_col: str = "timestamp") -> DataFrame:
    """Add hour, day, day_of_week (1 = Monday), month, quarter and year."""
    ts = F.col(timestamp_col)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day": F.dayofmonth(ts),
            "day_of_week": iso_weekday(ts),
            "month": F.month(ts),
            "quarter": F.quarter(ts),
            "year": F.year(ts),
        }
    )


def calculate_capacity_factor(
    df: DataFrame, generation_col: str, capacity_col: str, hours: float = 1.0
) -> DataFrame:
    """Add ``capacity_factor``, unrounded; NULL where capacity is 0."""
    return df.withColumn(
        "capacity_factor", ratio(generation_col, F.col(capacity_col) * F.lit(float(hours)))
    )


def filter_by_date_range(
    df: DataFrame,
    timestamp_col: str = "timestamp",
    start_date: str | None = None,
    end_date: str | None = None,
    *,
    partition_col: str | None = None,
) -> DataFrame:
    """Rows between two bounds, both inclusive, either one open.

    ``partition_col`` names a date column the table is partitioned by; the same
    bounds are then also put on it, so that whole partitions are skipped.
    """
    kind = df.schema[timestamp_col].dataType
    if start_date is not None:
        low = F.lit(start_date).cast(kind)
        df = df.filter(F.col(timestamp_col) >= low)
        if partition_col:
            df = df.filter(F.col(partition_col) >= low.cast("date"))
    if end_date is not None:
        high = F.lit(end_date).cast(kind)
        df = df.filter(F.col(timestamp_col) <= high)
        if partition_col:
            df = df.filter(F.col(partition_col) <= high.cast("date"))
    return df
