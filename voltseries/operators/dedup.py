"""Keep one record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOAD_ID = "_load_id"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    version: str = LOAD_ID,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the highest ``version`` per key.

    Equal versions are decided by the columns ``ties`` (default: all others), so
    that a recomputed task picks the same row. The rank filter lets Spark cut
    every group to one row *before* the shuffle (``WindowGroupLimit``), so a key
    with very many copies costs each map task one row.
    """
    keys = list(keys)
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != version]
    order = [F.col(version).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, any of equal rows; ties by all other columns."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return keep_latest(df, keys, version=rest[0], ties=rest[1:])
