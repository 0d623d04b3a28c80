"""Exact quantiles and box-plot statistics per group, by narrowing to the wanted positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sumstone.operators.ordered import join_per_group, small_or_lazy

#: Relative accuracy of the sketch that finds the brackets is one in so many.
ACCURACY = 10_000


def quantiles_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    approximate: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Quantiles with linear interpolation per key, one output column per entry.

    Two passes and no sort of the table.  A sketch of fixed size per group brackets each wanted
    position; the second pass counts the values inside the brackets one by one and all others by
    the gap they fall into, before anything is shuffled.  What is ordered in the end is the share of
    a group between its brackets (about 6 / ``accuracy`` of it per quantile), so a group may hold
    any share of the rows.  NULL has no position, NaN is the largest value, a group without values
    has NULL quantiles.  ``approximate`` takes the sketch's own answer, in one pass.
    """
    if approximate:
        cols = [F.percentile_approx(value, p, accuracy).alias(n) for n, p in quantiles.items()]
        return df.groupBy(*keys).agg(*cols)
    return _picked(_cells(df, keys, value, quantiles.values(), accuracy), keys, quantiles)


def _orderable(df: DataFrame, value: str) -> Column:
    """The value with NaN as infinity, which the sketch can compare."""
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(value), F.lit(float("inf")).cast(df.schema[value].dataType))
    return F.col(value)


def _cells(
    df: DataFrame, keys: Sequence[str], value: str, wanted: Sequence[float], accuracy: int
) -> DataFrame:
    """Disjoint cells that cover each group: single values in a bracket, and the gaps between.

    ``_low, _high``: smallest and largest value of the cell; ``_n``: its values; ``_upto``: those up
    to and with it; ``_size``: all of the group.
    """
    margin = 3.0 / accuracy
    wanted = sorted(set(wanted))
    ends = [min(max(p + m, 0.0), 1.0) for p in wanted for m in (-margin, margin)]
    brackets = df.groupBy(*keys).agg(
        F.percentile_approx(_orderable(df, value), F.array(*map(F.lit, ends)), F.lit(accuracy)).alias("_ends")
    )
    held = df.select(*keys, F.col(value).alias("_v"), _orderable(df, value).alias("_o"))
    held = join_per_group(held, small_or_lazy(brackets), keys)
    inside, gap = F.lit(False), F.lit(0)
    for i in range(len(wanted)):
        low, high = F.get("_ends", F.lit(2 * i)), F.get("_ends", F.lit(2 * i + 1))
        inside = inside | ((F.col("_o") >= low) & (F.col("_o") <= high))
        gap = gap + (F.col("_o") > high).cast("int")
    cells = held.groupBy(*keys, gap.alias("_gap"), F.when(inside, F.col("_v")).alias("_single")).agg(
        F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("_v").alias("_n")
    )
    ordered = Window.partitionBy(*keys).orderBy("_low")
    return cells.withColumns(
        {
            "_upto": F.sum("_n").over(ordered),
            "_size": F.sum("_n").over(Window.partitionBy(*keys)),
        }
    )


def _picked(cells: DataFrame, keys: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    picks: list[Column] = []
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    # A gap is known at both of its ends; the brackets leave no position within one.
    lost = F.raise_error(F.lit("a quantile fell between its brackets: ask for more accuracy"))
    for i, p in enumerate(quantiles.values()):
        at = (F.col("_size") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (first <= index) & (index <= last)
            found = (
                F.when(index == first, F.col("_low"))
                .when((index == last) | (F.col("_low") == F.col("_high")), F.col("_high"))
                .otherwise(lost)
            )
            picks.append(F.max(F.when(here, found)).alias(f"_{side}{i}"))
    picked = cells.groupBy(*keys).agg(F.max("_size").alias("_size"), *picks)

    out = []
    for i, (name, p) in enumerate(quantiles.items()):
        at = (F.col("_size") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        between = (F.ceil(at) - at) * lo + (at - F.floor(at)) * hi
        out.append(F.when(F.floor(at) == F.ceil(at), lo).otherwise(between).alias(name))
    return picked.select(*keys, *out)


def box_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    approximate: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Quartiles, whiskers and number of outliers per group: the data behind a box plot.

    Whiskers are the extreme values within 1.5 times the inter-quartile range of the box; values
    beyond them are outliers.  Three passes over the value column, each an aggregation that is
    combined before its shuffle; nothing is sorted or written.
    """
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxes = small_or_lazy(quantiles_by(df, keys, value, quartiles, approximate, accuracy))
    measured = join_per_group(df.select(*keys, F.col(value).alias("_v")), boxes, keys)
    v = F.col("_v")
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = (v >= low) & (v <= high)
    return measured.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if((v < low) | (v > high)).alias("outliers"),
    )
