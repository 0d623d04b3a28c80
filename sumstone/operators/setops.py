"""Union, summary rows, comparison of two results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def append_summary(
    detail: DataFrame, key: str, aggregates: dict[str, Column], suffix: str = "_AVG"
) -> DataFrame:
    """Detail rows followed by one summary row per key, named key plus ``suffix``.

    ``aggregates`` gives the summary of each remaining column by name.
    """
    summary = detail.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])
    summary = summary.withColumn(key, F.concat(F.col(key), F.lit(suffix)))
    types = {f.name: f.dataType for f in detail.schema}
    summary = summary.select(*[F.col(c).cast(types[c]).alias(c) for c in detail.columns])
    return detail.unionByName(summary)


def differences(left: DataFrame, right: DataFrame, digits: int | None = None) -> DataFrame:
    """Rows that do not occur equally often on both sides, with the surplus on the left.

    One aggregation over both frames, combined before the shuffle, instead of two set differences.
    With ``digits``, floating-point columns are rounded first.  No rows means the frames are equal,
    in any order.
    """
    if left.columns != right.columns:
        raise ValueError("the frames have different columns")
    columns = left.columns

    def signed(df: DataFrame, sign: int) -> DataFrame:
        shaped = []
        for f in df.schema:
            c = F.col(f"`{f.name}`")
            if digits is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                c = F.round(c, digits)
            shaped.append(c.alias(f.name))
        return df.select(*shaped, F.lit(sign).cast("bigint").alias("_sign"))

    return (
        signed(left, 1)
        .unionByName(signed(right, -1))
        .groupBy(*[F.col(f"`{c}`") for c in columns])
        .agg(F.sum("_sign").alias("surplus"))
        .filter("surplus <> 0")
    )


def difference_count(left: DataFrame, right: DataFrame, digits: int | None = None) -> DataFrame:
    """One row: how many rows differ between two frames (0 = equal)."""
    total = F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).cast("bigint")
    return differences(left, right, digits).agg(total.alias("differing_rows"))


def frames_equal(left: DataFrame, right: DataFrame, digits: int | None = None) -> bool:
    return differences(left, right, digits).isEmpty()
