"""Sharding by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumstone.llm.common import freeze, offsets_by_part, row_places


def jump_buckets(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key (Lamping and Veach, "A fast, minimal memory, consistent hash").

    A key jumps forward through the shard counts at which it would move; the last jump below
    ``shards`` is its place.  About ``ln(shards)`` rounds over the whole array.
    """
    state = keys.astype(np.int64).view(np.uint64).copy()
    place = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        place[live] = target[live]
        with np.errstate(over="ignore"):
            state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        target[live] = ((place[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
        live = live[target[live] < shards]
    return place.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key of any type: its 64-bit hash, then the jumps.  A null key is a key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def jump(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump_buckets(hashes.to_numpy(np.int64), shards))

    return jump(F.xxhash64(key))


def shard(
    df: DataFrame, key: str, shards: int, payload: dict[str, Column] | None = None
) -> DataFrame:
    """Give each row its shard, its slot there, and its shard if one more were appended.

    Returns the key, the ``payload`` columns, ``shard``, ``slot`` and ``grown_shard``.  The shard
    depends on the key and the number of shards only, so rows with one key stay together and an
    appended shard takes rows only into itself.  Slots run without gap from 0 in each shard, in the
    order in which tasks read the rows.  No shard is gathered in one task: places are counted by
    task first and only narrow rows move.  Repeated rows each get a slot; an empty table gives an
    empty result.
    """
    part, seq = row_places()
    rows = df.select(
        F.col(key),
        *[c.alias(name) for name, c in (payload or {}).items()],
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
    )
    rows = freeze(rows.select("*", part, seq), "shards")
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = offsets_by_part(counts, ["shard"], "_rows").drop("_rows")
    in_part = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_seq"))
    placed = rows.join(before, ["shard", "_part"])
    return placed.withColumn("slot", F.col("_before") + in_part - 1).drop(
        "_part", "_seq", "_before"
    )
