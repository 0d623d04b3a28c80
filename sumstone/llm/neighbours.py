"""The next row in ascending key order, without sorting a table in one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of text in one range of keys, about.
PART = 16 << 20


def with_next(docs: DataFrame, key: str, text: str, part_bytes: int = PART) -> DataFrame:
    """``docs`` (``key``, ``text``) with ``next_text``: that of the next key; the first's for the last.

    Null keys come first and equal keys in order of their texts.  Keys are cut into ranges at
    quantiles, one range to a window; the first row of each range is also sent to the range before
    it, so each text moves once, and one row a range twice.  The driver holds one key a range.
    """
    rank = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    total, low = docs.agg(F.sum(F.octet_length(text)), F.min(rank)).first()
    if low is None:
        return docs.select(key, text, F.lit(None).cast("string").alias("next_text"))
    ranges = max(1, -(-(total or 0) // part_bytes))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = docs.agg(F.percentile_approx(rank, shares, 100 * ranges)).first()[0] if ranges > 1 else []
    bounds = np.unique(np.array([low, *cuts], np.int64))

    @F.pandas_udf("array<long>")
    def spots(ranks: pd.Series) -> pd.Series:
        """Twice the row's own range, and twice the one before plus 1 for a range's first key."""
        values = ranks.to_numpy(np.int64)
        own = np.searchsorted(bounds, values, "right") - 1
        first = bounds[own] == values
        before = (own - 1) % len(bounds)
        return pd.Series(
            [[2 * o, 2 * b + 1] if f else [2 * o] for o, b, f in zip(own, before, first)]
        )

    placed = docs.select(key, text, rank.alias("_rank"), F.explode(spots(rank)).alias("_spot"))
    guest = (F.col("_spot") % 2).alias("_guest")
    placed = placed.select(key, text, "_rank", F.shiftright("_spot", 1).alias("_range"), guest)
    order = Window.partitionBy("_range").orderBy("_guest", "_rank", F.col(text).asc_nulls_first())
    # The text itself is led, not an expression of it: that would be moved beside the text.
    led = placed.withColumn("next_text", F.coalesce(F.lead(text).over(order), F.lit("")))
    return led.filter("_guest = 0").select(key, text, "next_text")
