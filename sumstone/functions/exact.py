"""Sums and means whose result does not depend on how the rows are partitioned.

A floating-point sum changes in its last digits with the order of the additions, so two runs over
the same table can disagree.  The first decimals of a value, as many as its column is declared to
have, are therefore scaled to integers before they are added; what is left of it, nothing if the
declaration holds, is added as a double, so no digit is lost if it does not.  NaN, infinities and
values too large to scale are all left to that second sum.  One 64-bit integer would overflow on very large tables, and a wide
decimal is several times slower to add, so each scaled value is split into a high and a low part;
both parts are summed as 64-bit integers and put together once per group.  (An overflow, possible
only beyond 10^12 of the largest values in one group, stops the job.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_BITS = 20


def scaled(col: Column, scale: int) -> Column:
    """``col`` times ``10^scale``, rounded to a 64-bit integer; 0 where that would not fit."""
    value = col.cast("double")
    fits = F.abs(value) < F.lit(9e18 / 10**scale)  # false for NaN, which is above all numbers
    units = F.rint(value * F.lit(float(10**scale)))
    return F.when(fits, F.when(fits, units).cast("bigint")).when(col.isNotNull(), F.lit(0))


def residual(col: Column, scale: int) -> Column:
    """What :func:`scaled` leaves of ``col``; 0 for a value with ``scale`` decimals.

    A product of such values carries rounding noise of a few units in its last binary place, which
    is no more than its own precision; it counts as 0, too.
    """
    value = col.cast("double")
    rest = value - scaled(col, scale).cast("double") / F.lit(float(10**scale))
    finite = F.abs(value) < F.lit(float("inf"))
    noise = finite & (F.abs(rest) <= F.abs(value) * F.lit(2.0**-50))
    return F.when(noise, F.lit(0.0)).otherwise(rest)


def high_part(units: Column) -> Column:
    return F.shiftright(units, LOW_BITS)


def low_part(units: Column) -> Column:
    return units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))


def joined_parts(high: Column, low: Column, scale: int) -> Column:
    """Double closest to the total of both parts, put together as a decimal (once per group)."""
    whole = high.cast("decimal(19,0)") * F.lit(1 << LOW_BITS).cast("decimal(7,0)") + low.cast(
        "decimal(19,0)"
    )
    unit = F.expr(f"CAST(1e-{scale} AS DECIMAL({scale + 1},{scale}))")
    return (whole.cast("decimal(28,0)") * unit).cast("double")


def joined_parts_fast(high: Column, low: Column, scale: int) -> Column:
    """The same in double arithmetic; equal while the total has at most 15 digits."""
    whole = high.cast("double") * F.lit(float(1 << LOW_BITS)) + low.cast("double")
    return whole / F.lit(float(10**scale))


def exact_sum(col: Column, scale: int = 2, wide: bool = True) -> Column:
    """Sum of ``col``, exact in its first ``scale`` decimals, as a double; NULL if nothing to add.

    ``wide=False`` adds single 64-bit integers, half the work, for reports with many small groups:
    a group may hold up to 9 * 10^18 units of ``10^-scale``.  More than that stops the job in ANSI
    mode, Spark's default.
    """
    units = scaled(col, scale)
    rest = F.sum(residual(col, scale))
    if not wide:
        return F.sum(units).cast("double") / F.lit(float(10**scale)) + rest
    return joined_parts(F.sum(high_part(units)), F.sum(low_part(units)), scale) + rest


def exact_mean(col: Column, scale: int = 2, wide: bool = True) -> Column:
    """Mean of the non-null values from an exact sum; NULL for a group without values."""
    return F.try_divide(exact_sum(col, scale, wide), F.count(col).cast("double"))
