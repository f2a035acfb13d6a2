"""Rounding, safe division, clamps and guarded statistics."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

_WIDE = "decimal(38,12)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_dec(c: Column | str, digits: int) -> Column:
    """Round half up as a decimal of 12 digits would, NaN and infinities to NULL.

    A finite value beyond the decimal's range (10^26) has no fraction and is itself.

    Binary noise must not decide a tie, so ties are decided in decimal. A value
    that is clearly not near a tie needs no decimal: there the nearest multiple is
    plain double arithmetic, which is several times faster. Text is read as a SQL
    expression.
    """
    # Near a tie is within 1e-6 of it, or within what the product may be off.
    # Adding 0.0 turns -0.0 into 0.0.
    if isinstance(c, str):
        factor = f"{10.0**digits:.0f}D"
        scaled = f"({c}) * {factor}"
        return F.expr(
            f"CASE WHEN abs({scaled} - rint({scaled})) + abs({scaled}) * 1e-15D < 0.499999D "
            f"THEN rint({scaled}) / {factor} + 0D "
            f"ELSE coalesce(CAST(round(try_cast(({c}) AS {_WIDE}), {digits}) AS DOUBLE), "
            f"CASE WHEN abs({c}) < double('Infinity') THEN {c} END) END"
        )
    factor = F.lit(10.0**digits)
    scaled = c * factor
    nearest = F.rint(scaled)
    clear = F.abs(scaled - nearest) + F.abs(scaled) * F.lit(1e-15) < 0.499999
    exact = F.round(c.try_cast(_WIDE), digits).cast("double")
    whole = F.when(F.abs(c) < float("inf"), c)
    return F.when(clear, nearest / factor + F.lit(0.0)).otherwise(F.coalesce(exact, whole))


def without_noise(c: Column | str) -> Column:
    """The value at twelve digits, for a comparison that the order of a sum must not decide."""
    c = _col(c)
    return F.coalesce(round_dec(c, 12), c)


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator``; NULL where the denominator is 0."""
    return F.try_divide(_col(numerator), _col(denominator))


def clamp(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high] and keep NULL as NULL (``greatest`` alone skips NULLs)."""
    c = _col(c)
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    return F.when(c.isNotNull(), bounded)


def capacity_factor(generation: str, capacity: str, hours: float = 1.0) -> Column:
    """Generation over capacity times hours, 4 digits, NULL for zero capacity.

    Both arguments are SQL expressions, so this serves rows and aggregates alike.
    """
    return round_dec(f"try_divide({generation}, ({capacity}) * {float(hours)}D)", 4)


def true_when(condition: Column) -> Column:
    """A condition as a flag: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def _pair(x: Column, y: Column) -> tuple[Column, Column]:
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def safe_corr(
    x: Column | str, y: Column | str, over: WindowSpec | None = None
) -> Column:
    """Pearson correlation of the rows where both sides are present.

    NULL where either side does not vary; the built-in ``corr`` raises a division
    error there under ANSI rules. Works as an aggregate or over a frame.
    """
    x, y = _pair(nan_to_null(x), nan_to_null(y))
    var_x, var_y, cov = F.var_pop(x), F.var_pop(y), F.covar_pop(x, y)
    # Merging partial variances leaves noise above 0 even for equal values; the extremes do not.
    ends = [F.max(x), F.min(x), F.max(y), F.min(y)]
    if over is not None:
        var_x, var_y, cov = var_x.over(over), var_y.over(over), cov.over(over)
        ends = [e.over(over) for e in ends]
    varies = (ends[0] > ends[1]) & (ends[2] > ends[3])
    return F.when(varies, F.try_divide(cov, F.sqrt(var_x) * F.sqrt(var_y)))


def safe_slope(y: Column | str, x: Column | str) -> Column:
    """Least-squares slope of y on x; NULL where x does not vary."""
    x, y = _pair(_col(x), _col(y))
    return F.when(F.max(x) > F.min(x), F.try_divide(F.covar_pop(y, x), F.var_pop(x)))


def safe_intercept(y: Column | str, x: Column | str) -> Column:
    """Least-squares intercept of y on x; NULL where x does not vary."""
    slope = safe_slope(y, x)
    x, y = _pair(_col(x), _col(y))
    return F.avg(y) - slope * F.avg(x)


def linear_fit(x: Column | str, y: Column | str, order: Column | str) -> dict[str, Column]:
    """Aggregates ``slope``, ``intercept`` and ``r2`` of a line through (x, y).

    Fewer than two points, or an x that stays within 1e-8 + 1e-5·|first x| of its
    first value (in ``order``), fits the flat line through the mean of y.
    """
    x, y = _pair(_col(x), _col(y))
    first_x = F.min_by(x, F.when(x.isNotNull(), _col(order)))
    tolerance = F.lit(1e-8) + F.lit(1e-5) * F.abs(first_x)
    flat = (
        (F.count(x) < 2)
        | ((F.max(x) - first_x <= tolerance) & (first_x - F.min(x) <= tolerance))
        | (F.var_pop(x) <= 0)
    )
    slope = F.when(flat, F.lit(0.0)).otherwise(F.try_divide(F.covar_pop(x, y), F.var_pop(x)))
    corr = F.when(flat, F.lit(0.0)).otherwise(safe_corr(x, y))
    return {
        "slope": slope,
        "intercept": F.coalesce(F.avg(y) - slope * F.when(flat, F.lit(0.0)).otherwise(F.avg(x)),
                                F.lit(0.0)),
        "r2": F.coalesce(corr * corr, F.lit(0.0)),
    }
