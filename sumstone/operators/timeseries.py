"""Rolling means over a time range and resampling to fixed buckets."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumstone.functions.exact import high_part, joined_parts_fast, low_part, residual, scaled
from sumstone.functions.scalar import epoch_micros
from sumstone.operators.ordered import range_count

_SECOND = 1_000_000


def rolling_mean(
    df: DataFrame,
    ts: str,
    value: str,
    width: dt.timedelta,
    out: str = "rolling_mean",
    scale: int = 6,
    ranges: int | None = None,
) -> DataFrame:
    """Mean of ``value`` over ``(t - width, t]`` for every row, rows of equal time included.

    A value enters the sum at its time and leaves it ``width`` later, so the sum over the range is
    a running total of entries and leavings, and the cost per row does not grow with the width.
    Rows of one instant are added up before anything is shuffled.  Time is cut into ``ranges`` of
    about as many entries and leavings each, at boundaries from a sketch of the times; each range
    runs its own totals, and the totals of the ranges before are added.

    The first ``scale`` decimals are added exactly (see ``sumstone.functions.exact``), so nothing is
    lost in what leaves; what a value has beyond them is added as a double.  NaN and infinities
    count within their own range only.  A row without time gets NULL, as does a range without
    values.
    """
    micros = round(width.total_seconds() * _SECOND)
    keyed = df.withColumn("_t", epoch_micros(df, ts))
    units = scaled(F.col(value), scale)
    v = F.col(value).cast("double")
    points = (
        keyed.filter(F.col("_t").isNotNull())
        .groupBy("_t")
        .agg(
            F.sum(high_part(units)).alias("_h"),
            F.sum(low_part(units)).alias("_l"),
            F.sum(F.when(F.abs(v) < _INF, residual(F.col(value), scale))).alias("_r"),
            F.count_if(v.isNotNull() & ~(v < _INF)).alias("_p"),
            F.count_if(F.isnan(v) | (v == -_INF)).alias("_m"),
            F.count(value).alias("_n"),
        )
    )
    enters = F.struct(
        F.col("_t").alias("_at"), F.lit(True).alias("_own"), *[_zero(c).alias(c) for c in _SUMS]
    )
    leaves = F.struct(
        (F.col("_t") + F.lit(micros)).alias("_at"),
        F.lit(False).alias("_own"),
        *[(-_zero(c)).alias(c) for c in _SUMS],
    )
    bounds = _time_bounds(keyed.select("_t"), micros, ranges)
    entries = points.select(F.inline(F.array(enters, leaves)))
    entries = entries.withColumn("_range", _range_of(F.col("_at"), bounds))

    # One row a range: the only window without a partition key.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = entries.groupBy("_range").agg(*[F.sum(c).alias(c) for c in _SUMS]).select(
        F.col("_range").alias("_of"), *[F.sum(c).over(earlier).alias(f"_before{c}") for c in _SUMS]
    )
    upto = Window.partitionBy("_range").orderBy("_at")  # equal times see each other
    local = entries.select("_at", "_own", "_range", *[F.sum(c).over(upto).alias(c) for c in _SUMS])
    placed = local.filter("_own").join(F.broadcast(before), F.col("_range") == F.col("_of"))
    s = {c: F.col(c) + _zero(f"_before{c}") for c in _SUMS}
    total = joined_parts_fast(s["_h"], s["_l"], scale) + s["_r"]
    above, below = s["_p"] > 0, s["_m"] > 0
    total = F.when(above & below, F.lit(float("nan"))).when(above, _INF).when(below, -_INF).otherwise(total)
    mean = F.try_divide(total, s["_n"].cast("double"))
    means = placed.select("_at", mean.alias(out))
    return keyed.join(means, F.col("_t") == F.col("_at"), "left").drop("_t", "_at")


_SUMS = ["_h", "_l", "_n", "_r", "_p", "_m"]
_INF = float("inf")
_MOST_RANGES = 4096


def _time_bounds(times: DataFrame, micros: int, ranges: int | None) -> list[int]:
    """Where the ranges begin: as many times as times plus ``micros`` lie in each, about."""
    wanted = min(ranges or range_count(times.sparkSession), _MOST_RANGES)
    if wanted < 2:
        return []
    shares = [i / wanted for i in range(1, wanted)]
    marks = times.agg(F.percentile_approx("_t", shares, 20 * wanted)).first()[0] or []
    return sorted({*marks, *[m + micros for m in marks]})[1::2]


def _range_of(at: Column, bounds: list[int]) -> Column:
    """Number of the range, found in two steps of about the square root of their number."""

    def passed(starts: Column) -> Column:
        return F.size(F.filter(starts, lambda x: x <= at))

    if not bounds:
        return F.lit(0)
    side = math.isqrt(len(bounds) - 1) + 1
    coarse = passed(F.array(*[F.lit(b) for b in bounds[::side]]))
    rows = [bounds[i : i + side] for i in range(0, len(bounds), side)]
    fine = F.array(*[F.array(*[F.lit(b) for b in row]) for row in rows])
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * side + passed(F.get(fine, coarse - 1)))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def tumbling(
    df: DataFrame,
    ts: str,
    width: dt.timedelta,
    aggregates: dict[str, Column],
    keys: Sequence[str] = (),
    bucket: str = "bucket",
) -> DataFrame:
    """Aggregates per fixed time bucket that holds at least one row; the label is its start."""
    return (
        df.groupBy(*keys, F.window(ts, _span_text(width)).alias("_w"))
        .agg(*[c.alias(n) for n, c in aggregates.items()])
        .select(*keys, F.col("_w.start").alias(bucket), *aggregates)
    )


def resample(
    df: DataFrame,
    ts: str,
    width: dt.timedelta,
    aggregates: dict[str, Column],
    bucket: str = "bucket",
) -> DataFrame:
    """:func:`tumbling` plus the empty buckets between the first and the last one.

    The list of buckets depends on the time span only.  It is laid out in chunks that are spread
    over the tasks, so a long span costs rows, not the memory of one task.
    """
    filled = tumbling(df, ts, width, aggregates, bucket="_filled")
    step = width.total_seconds()
    ends = filled.agg(F.min("_filled").alias("_first"), F.max("_filled").alias("_last"))
    chunks = ends.select(
        "_last",
        F.explode(F.sequence("_first", "_last", _interval(step * _CHUNK))).alias("_chunk"),
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk_end = F.least(F.col("_chunk") + _interval(step * (_CHUNK - 1)), F.col("_last"))
    spine = chunks.repartition(tasks, "_chunk").select(
        F.explode(F.sequence(F.col("_chunk"), chunk_end, _interval(step))).alias(bucket)
    )
    return spine.join(filled, F.col(bucket) == F.col("_filled"), "left").drop("_filled")


_CHUNK = 1000


def _span_text(width: dt.timedelta) -> str:
    return f"{round(width.total_seconds() * _SECOND)} microseconds"


def _interval(seconds: float) -> Column:
    return F.expr(f"INTERVAL '{seconds:.6f}' SECOND")
