"""Grouped and whole-table aggregates, value counts, top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    drop_null_keys: bool = False,
) -> DataFrame:
    """``GROUP BY keys`` with named aggregates; without keys, one row for the whole table.

    NULL is a key like any other unless ``drop_null_keys`` is set.
    """
    if drop_null_keys:
        df = df.na.drop("any", subset=list(keys))
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def distinct_count(col: str | Column, null_as_value: bool = False, approximate: bool = False) -> Column:
    """Number of distinct values, exact unless ``approximate``; NULL counts only on request.

    The exact form is planned in phases that are spread over (key, value), so one group with most
    of the rows is still counted by many tasks.
    """
    col = F.col(col) if isinstance(col, str) else col
    n = F.approx_count_distinct(col) if approximate else F.count_distinct(col)
    if null_as_value:
        n = n + F.coalesce(F.max(col.isNull().cast("bigint")), F.lit(0).cast("bigint"))
    return n


def distinct_counts(df: DataFrame, columns: dict[str, str]) -> dict[str, Column]:
    """Exact distinct counts of several columns of a table: ``{result: column}`` to scalar columns.

    Each count reads its own column and shuffles its own distinct values, combined before.  Several
    ``COUNT(DISTINCT ...)`` in one aggregation would read them together and write every row once for
    each instead.
    """
    counts = {}
    for name, column in columns.items():
        values = df.select(F.col(column).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
        counts[name] = values.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return counts


def grouped_with_dense_ids(
    df: DataFrame, keys: Sequence[str], id: str, out: str, sums: dict[str, Column]
) -> DataFrame:
    """Exact distinct count of an integer id per key, together with sums and counts.

    Ids are collected in bitmaps of 32,768 neighbouring values before the shuffle, so what is moved
    depends on the range of ids and not on the rows.  Meant for ids that fill their range, such as
    consecutive user numbers; widely scattered ids cost 4 KB each, for those use
    :func:`distinct_count`.  ``sums`` may hold only aggregates whose partial results are added up
    (``sum``, ``count``).
    """
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id)))
    per_block = df.groupBy(*keys, F.bitmap_bucket_number(F.col(id)).alias("_block")).agg(
        bits.alias("_bits"), *[c.alias(n) for n, c in sums.items()]
    )
    distinct = F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0).cast("bigint"))
    return per_block.groupBy(*keys).agg(distinct.alias(out), *[F.sum(n).alias(n) for n in sums])


def rows() -> Column:
    """Number of rows, NULLs included."""
    return F.count(F.lit(1))


def sample_std(col: str | Column) -> Column:
    """Standard deviation with n-1 in the denominator; NULL for a single row."""
    return F.stddev_samp(col)


def descending(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def mixed_sort(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """Global sort by ``(column, ascending?)`` pairs with NULL last in both directions.

    Spark range-partitions by the whole key and sorts each range, so the result is written as
    ordered part files and no task sees more than its range.
    """
    return df.orderBy(
        *[F.col(n).asc_nulls_last() if up else F.col(n).desc_nulls_last() for n, up in order]
    )


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal values are ordered by ``ties``.

    Each task keeps its own ``k`` best rows, so only ``k`` rows per task are moved.
    """
    return df.orderBy(*descending(by), *ascending(*ties)).limit(k)


def value_counts(df: DataFrame, column: str, k: int | None = None, name: str = "count") -> DataFrame:
    """Rows per non-null value, most frequent first, optionally only the first ``k``."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(rows().alias(name))
    if k is not None:
        return top_k(counts, name, k, [column])
    return counts.orderBy(*descending(name), *ascending(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, NULL included, in no particular order."""
    return df.select(column).distinct()


def histogram(df: DataFrame, columns: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per combination of category columns: the data behind a count chart."""
    return df.groupBy(*columns).agg(rows().alias(name))


def ratio_to_baseline(df: DataFrame, key: str, baseline: str, measure: str, out: str) -> DataFrame:
    """Measure of the baseline row divided by each row's measure (a speed-up column).

    ``key`` must identify rows; the baseline value enters the plan as a scalar subquery, so
    nothing is joined.
    """
    base = df.filter(F.col(key) == F.lit(baseline)).select(measure).scalar()
    return df.withColumn(out, F.try_divide(base, F.col(measure)))


def run_statistics(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Mean, best (smallest) and median of a measure per key."""
    from sumstone.operators.quantiles import quantiles_by

    stats = df.groupBy(key).agg(
        F.avg(measure).alias("mean"), F.min(measure).alias("best"), rows().alias("runs")
    )
    medians = quantiles_by(df, [key], measure, {"median": 0.5}).withColumnRenamed(key, "_key")
    return stats.join(medians, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
