"""Positions and windows over series too long for one task.

A plain window puts a whole partition of the window into one task. That is right
for a keyed series whose length is bounded by the calendar, and wrong for an
unkeyed table or a key that may hold any share of the rows. The functions here
cut such a series into ranges first:

1. range-partition on the full order, sort each range, number its rows as they are
   written, and keep the ranges as a table in the shared scratch folder (so that ranges
   and numbers stay fixed if executors are lost);
2. count rows per range, and turn the counts into a start position per range;
3. position = start of the range + number inside the range. No second shuffle is needed.

Frames of bounded length then run per fixed block of positions, each block also
getting the few rows before (or after) it that its frames reach into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from voltseries.session import scratch_path

_RANGE = "_range"
_INSIDE = "_inside"
_POSITION = "_position"
_BLOCK = "_block"
_OWN = "_own"


def with_position(
    df: DataFrame,
    order_by: Sequence[str],
    position: str = _POSITION,
    ranges: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the order ``order_by``.

    The order must be total: rows equal in all of ``order_by`` cannot be split
    over ranges. This runs a job, as any range partitioning does.
    """
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() for c in order_by]
    cut = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    path = scratch_path(spark, "ranges")
    # The id holds the partition in its upper 31 bits and the row in the lower 33.
    (
        cut.sortWithinPartitions(*order)
        .withColumn(_INSIDE, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    fixed = spark.read.parquet(path).withColumns(
        {
            _RANGE: F.shiftright(F.col(_INSIDE), 33),
            _INSIDE: F.col(_INSIDE).bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )

    # One row per range: the number of ranges is the number of shuffle
    # partitions, whatever the number of rows.
    starts = (
        fixed.groupBy(_RANGE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_start",
            F.sum("_n").over(
                Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(_RANGE, F.coalesce("_start", F.lit(0)).alias("_start"))
    )
    return (
        fixed.join(F.broadcast(starts), _RANGE)
        .withColumn(position, F.col("_start") + F.col(_INSIDE))
        .drop(_RANGE, _INSIDE, "_start")
    )


def rank_share(
    df: DataFrame, column: str, ties: Sequence[str], name: str = "rank_signal"
) -> DataFrame:
    """Rank of ``column`` over the whole table, scaled to [0, 1].

    Equal values take distinct ranks in the order of ``ties``. A single row ranks 0.
    """
    placed = with_position(df, [column, *ties], "_place")
    total = placed.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(1)).alias("n")).scalar()
    return placed.withColumn(name, F.col("_place") / total).drop("_place")


def over_blocks(
    df: DataFrame,
    build: Callable[[WindowSpec], list[Column]],
    order_by: Sequence[str],
    partition_by: Sequence[str],
    reach_back: int,
    reach_ahead: int,
    block_rows: int,
    long_frames: Callable[[DataFrame, Sequence[str], Sequence[str]], DataFrame] | None = None,
) -> DataFrame:
    """Window columns with frames that reach a bounded number of rows.

    ``build`` gets a window spec and returns the named window columns; ``long_frames``, if
    given, adds further columns to a frame, with the keys and the order to use. Each block
    of ``block_rows`` positions is one window partition; the rows its frames need
    from the neighbour blocks are copied in and dropped again afterwards. The
    result equals the plain window, for any ``block_rows``.
    """
    block_rows = max(block_rows, reach_back, reach_ahead, 1)
    placed = with_position(df, [*partition_by, *order_by])
    block = F.floor(F.col(_POSITION) / block_rows)
    inside = F.col(_POSITION) % block_rows
    none = F.lit(None).cast("bigint")
    homes = F.array_compact(
        F.array(
            block,
            F.when(inside >= block_rows - reach_back, block + 1).otherwise(none),
            F.when(inside < reach_ahead, block - 1).otherwise(none),
        )
    )
    copied = placed.withColumn(_OWN, block).withColumn(_BLOCK, F.explode(homes))
    spec = Window.partitionBy(*partition_by, _BLOCK).orderBy(_POSITION)
    windowed = copied.select("*", *build(spec))
    if long_frames is not None:
        windowed = long_frames(windowed, [*partition_by, _BLOCK], [_POSITION])
    return windowed.filter(F.col(_BLOCK) == F.col(_OWN)).drop(_BLOCK, _OWN, _POSITION)
