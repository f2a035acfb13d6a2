"""Statistics over the last n rows at a cost that does not grow with n.

A plain frame is computed anew for every row: rows times n steps. Here a series is cut into
stretches of n rows. The frame that ends at a row is what is left of the stretch before,
from the frame's first row to that stretch's end, and the row's own stretch up to the row.
Both are growing frames, which take one step a row, read from the stretch's end backwards
and from its start forwards. The two parts are then merged: counts, minima and maxima as
they are, means and moments by the pairwise update, which adds and never subtracts large
sums. So nothing cancels, whatever the length of the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_ROW, _OLD, _NEW, _SEEN = "_row", "_old", "_new", "_seen"


def _growing(x: Column, y: Column | None, over: WindowSpec) -> list[Column]:
    """Count, extremes, mean and moments of x; with y also those of y and the co-moment."""
    n = F.count(x).over(over)
    parts = [n.alias("n")]
    for name, value in (("x", x), ("y", y)):
        if value is not None:
            parts += [
                F.avg(value).over(over).alias(f"m{name}"),
                (F.var_pop(value).over(over) * n).alias(f"s{name}"),
                F.min(value).over(over).alias(f"low{name}"),
                F.max(value).over(over).alias(f"high{name}"),
            ]
    return parts if y is None else [*parts, (F.covar_pop(x, y).over(over) * n).alias("sxy")]


def _varies(a: Column, b: Column, name: str) -> Column:
    """Whether the frame holds two values; moments of equal ones may be noise above 0."""
    return F.greatest(a[f"high{name}"], b[f"high{name}"]) > F.least(a[f"low{name}"], b[f"low{name}"])


def _moment(a: Column, b: Column, sums: str, first: str, second: str) -> Column:
    """Sum of products of deviations of two parts together."""
    between = (b[first] - a[first]) * (b[second] - a[second]) * a["n"] * b["n"] / (a["n"] + b["n"])
    return F.coalesce(a[sums] + b[sums] + between, b[sums], a[sums])


def _framed(df: DataFrame, x: Column, y: Column | None, size: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_old`` and ``_new``, the two parts of the frame of ``size`` rows, and ``_seen``.

    ``_old`` is NULL where the frame is one whole stretch. ``_seen`` counts the values.
    """
    by_order = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn(_ROW, F.row_number().over(by_order) - 1)
    stretch = F.floor(F.col(_ROW) / size)
    cut = numbered.withColumn("_stretch", stretch)
    own = Window.partitionBy(*keys, "_stretch")
    ahead = own.orderBy(_ROW).rowsBetween(Window.unboundedPreceding, 0)
    back = own.orderBy(F.desc(_ROW)).rowsBetween(Window.unboundedPreceding, 0)
    parts = cut.select(
        "*", F.struct(*_growing(x, y, ahead)).alias(_NEW), F.struct(*_growing(x, y, back)).alias("_tail")
    )
    by_row = Window.partitionBy(*keys).orderBy(_ROW)
    earlier = F.lag("_tail", size - 1).over(by_row) if size > 1 else F.col("_tail")
    last = F.col(_ROW) % size == size - 1
    whole = parts.withColumn("_earlier", earlier).withColumn(_OLD, F.when(~last, F.col("_earlier")))
    seen = F.col(f"{_NEW}.n") + F.coalesce(F.col(f"{_OLD}.n"), F.lit(0))
    return whole.withColumn(_SEEN, seen).drop("_stretch", "_tail", "_earlier")


def rolling_stats(
    df: DataFrame, column: str, size: int, stats: Sequence[str], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Add ``{column}_rolling_{stat}_{size}`` where the frame is full and holds no NULL."""
    framed = _framed(df, F.col(column), None, size, keys, order)
    a, b = F.col(_OLD), F.col(_NEW)
    n = F.col(_SEEN)
    both = (a["n"] > 0) & (b["n"] > 0)
    mean = F.when(both, a["mx"] + (b["mx"] - a["mx"]) * (b["n"] / n)).otherwise(F.coalesce(b["mx"], a["mx"]))
    values = {
        "mean": mean,
        "std": F.when(
            n > 1,
            F.when(_varies(a, b, "x"), F.sqrt(_moment(a, b, "sx", "mx", "mx") / (n - 1))).otherwise(F.lit(0.0)),
        ),
        "min": F.least(a["lowx"], b["lowx"]),
        "max": F.greatest(a["highx"], b["highx"]),
    }
    full = n == size
    return framed.select(
        *df.columns, *[F.when(full, values[s]).alias(f"{column}_rolling_{s}_{size}") for s in stats]
    )


def rolling_correlation(
    df: DataFrame, x: Column, y: Column, size: int, name: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Add the Pearson correlation of the last ``size`` rows, if all of them have both values.

    Constant input gives NULL.
    """
    both = x.isNotNull() & y.isNotNull()
    framed = _framed(df, F.when(both, x), F.when(both, y), size, keys, order)
    a, b = F.col(_OLD), F.col(_NEW)
    sx, sy = _moment(a, b, "sx", "mx", "mx"), _moment(a, b, "sy", "my", "my")
    value = F.try_divide(_moment(a, b, "sxy", "mx", "my"), F.sqrt(sx) * F.sqrt(sy))
    varies = _varies(a, b, "x") & _varies(a, b, "y")
    return framed.select(*df.columns, F.when((F.col(_SEEN) == size) & varies, value).alias(name))
