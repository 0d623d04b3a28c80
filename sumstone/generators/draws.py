"""Pseudo-random draws that depend on the row number and a salt only.

``rand(seed)`` depends on how the rows are partitioned.  These draws are integer arithmetic on the
row number, so any number of tasks, a repeated task or another SQL engine gives the same table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIME = 2_147_483_647  # 2^31 - 1; all intermediate products stay below 2^63
_SALT_STEP = 715_225_741


def row_numbers(spark: SparkSession, n: int, tasks: int | None = None) -> DataFrame:
    """``n`` rows with a column ``id`` = 0 … n-1."""
    return spark.range(0, n, 1, tasks) if tasks else spark.range(n)


def draw(row: Column, salt: int) -> Column:
    """Integer in ``[0, PRIME)``; independent streams for different salts."""
    prime = F.lit(PRIME).cast("bigint")
    row = row.cast("bigint")
    high = F.call_function("div", row, prime)
    x = ((row % prime) * 48_271 + (high % prime) * 69_621 + (salt * _SALT_STEP) % PRIME) % prime
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * 1_597_334_677) % prime
    x = x.bitwiseXOR(F.shiftright(x, 13))
    return (x * 741_103_597 + salt) % prime


def draw_sql(row: str, salt: int) -> str:
    """:func:`draw` as SQL text for engines with ``//`` and ``xor``; used to check the tables."""
    start = (salt * _SALT_STEP) % PRIME
    x = f"((({row}) % {PRIME}) * 48271 + (({row}) // {PRIME} % {PRIME}) * 69621 + {start}) % {PRIME}"
    y = f"(xor({x}, ({x}) >> 15) * 1597334677) % {PRIME}"
    return f"((xor({y}, ({y}) >> 13) * 741103597 + {salt}) % {PRIME})"


def uniform(row: Column, salt: int) -> Column:
    """Double in ``[0, 1)``."""
    return draw(row, salt) / F.lit(float(PRIME))


def below(row: Column, salt: int, n: int) -> Column:
    """Integer in ``[0, n)``; a second draw is mixed in where one has too few values."""
    if n < 1_000_000:
        return draw(row, salt) % n
    return (draw(row, salt) * 1_000 + draw(row, salt + 500) % 1_000) % n


def integer(row: Column, salt: int, low: int, high: int) -> Column:
    """Integer in ``[low, high)``."""
    return below(row, salt, high - low) + low


def decimal(row: Column, salt: int, low: float, high: float, digits: int) -> Column:
    """Double in ``[low, high]`` on a grid of ``digits`` decimals."""
    unit = 10**digits
    first, last = round(low * unit), round(high * unit)
    return integer(row, salt, first, last + 1) / F.lit(float(unit))


def choice(row: Column, salt: int, values: Sequence[Any]) -> Column:
    """One of the values, all equally likely."""
    position = (below(row, salt, len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def weighted(row: Column, salt: int, weights: dict[Any, float]) -> Column:
    """One of the keys with the given probabilities (cumulative thresholds on one draw)."""
    u = uniform(row, salt)
    items = list(weights.items())
    reached = 0.0
    out = None
    for value, weight in items[:-1]:
        reached += weight
        condition = u < F.lit(round(reached, 9))
        out = F.when(condition, F.lit(value)) if out is None else out.when(condition, F.lit(value))
    last = F.lit(items[-1][0])
    return last if out is None else out.otherwise(last)


def normal(row: Column, salt: int, mean: float, deviation: float) -> Column:
    """Normal draw from two uniform ones (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln((draw(row, salt) + 1) / F.lit(float(PRIME))))
    return F.lit(mean) + F.lit(deviation) * radius * F.cos(
        F.lit(2.0 * math.pi) * uniform(row, salt + 500)
    )


def gamma_two(row: Column, salt: int, scale: float) -> Column:
    """Gamma draw of shape 2: the sum of two exponential draws."""
    first = F.ln((draw(row, salt) + 1) / F.lit(float(PRIME)))
    second = F.ln((draw(row, salt + 500) + 1) / F.lit(float(PRIME)))
    return F.lit(-scale) * (first + second)
