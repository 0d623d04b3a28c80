"""Cross-tabs and pivots: one output column per category."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _listed(category: Column, values: Sequence[Any] | None, rest: str | None) -> Column:
    """``category``, or ``rest`` for one that is not listed; without ``rest`` that is an error."""
    if values is None:
        return category
    known = category.isin(*values) | category.isNull()
    if rest is None:
        unlisted = F.raise_error(F.concat(F.lit("category not listed: "), category.cast("string")))
        return F.when(known, category).otherwise(unlisted)
    return F.when(known, category.cast("string")).otherwise(F.lit(rest))


def crosstab(
    df: DataFrame,
    rows: str,
    columns: str,
    values: Sequence[Any] | None = None,
    fill_value: int | None = None,
    rest: str | None = None,
) -> DataFrame:
    """Row counts of two categories; a combination that never occurs is NULL.

    ``values`` names the output columns; without it a job of its own finds the categories in the
    data.  Rows of categories that are not listed are counted in the column ``rest``; if that is not
    named either they stop the job, as they must not vanish.  NULL categories have no column.
    """
    given = df.select(rows, _listed(F.col(columns), values, rest).alias("_category"))
    if values is None:
        out = given.filter(F.col("_category").isNotNull()).groupBy(rows).pivot("_category").count()
        # Groups whose categories are all NULL keep their row.
        bare = given.groupBy(rows).agg(F.count("_category").alias("_n")).filter("_n = 0")
        out = out.union(bare.select(rows, *[F.lit(None).cast("long")] * (len(out.columns) - 1)))
    else:
        named = [*values, *([rest] if rest is not None else [])]
        out = given.groupBy(rows).pivot("_category", named).count()
    return out if fill_value is None else out.na.fill(fill_value)


def pivot_aggregate(
    df: DataFrame,
    rows: str,
    bucket: Column,
    values: Sequence[Any] | None,
    aggregate: Column,
) -> DataFrame:
    """Pivot any aggregate over a computed bucket; one output column per entry of ``values``.

    Without ``values`` the buckets found in the data.  Rows in no listed bucket stop the job.
    """
    marked = df.withColumn("_bucket", bucket)
    if values is not None:
        known = F.col("_bucket").isin(*values) | F.col("_bucket").isNull()
        outside = F.raise_error(F.concat(F.lit("bucket not listed: "), F.col("_bucket").cast("string")))
        marked = marked.withColumn("_bucket", F.when(known, F.col("_bucket")).otherwise(outside))
    return marked.groupBy(rows).pivot("_bucket", list(values) if values is not None else None).agg(aggregate)


def pivot_mean(
    df: DataFrame, rows: str, bucket: Column, values: Sequence[Any] | None, measure: str
) -> DataFrame:
    """Mean of ``measure`` per row category and bucket."""
    return pivot_aggregate(df, rows, bucket, values, F.avg(measure))
