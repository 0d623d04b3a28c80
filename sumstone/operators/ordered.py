"""Running totals and ranks that do not need a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sumstone.session import scratch_path

#: Rows of one key that one task orders; keys beyond it that are cut, and the ranges of each.
HOT, MOST_HOT, RANGES = 4_000_000, 10_000, 64


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on equal keys in which NULL equals NULL."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def small_or_lazy(per_group: DataFrame, most: int = 10_000) -> DataFrame:
    """A frame of one row per group, as local rows to broadcast if there are at most ``most``.

    Spark doesn't know the size of local rows and would shuffle both sides of a join with them, all
    rows of a frequent group into one task.  Beyond ``most`` nothing is kept, and the frame stays
    part of the plan, to be joined in a shuffle.
    """
    rows = per_group.limit(most + 1).collect()
    if len(rows) > most:
        return per_group
    return F.broadcast(per_group.sparkSession.createDataFrame(rows, per_group.schema))


def join_per_group(
    df: DataFrame, per_group: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Attach one row per group to every row of the group; NULL keys match.

    Adaptive execution splits the partitions of hot groups: each part meets the one group row.
    """
    renamed = per_group.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return df.join(renamed, condition, how).drop(*[f"_g_{k}" for k in keys])


def range_count(spark: SparkSession) -> int:
    """Number of ranges: as many as a shuffle has partitions, which grows with the cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    totals: dict[str, Column],
    parts: int | None = None,
    group_totals: dict[str, str] | None = None,
) -> DataFrame:
    """Running sums per key in ``order_by`` order, whatever the size of a group.

    The table is range-partitioned by key *and* order, so a hot key spans many partitions of equal
    size, and written once to the shared scratch folder together with the partition number.  Each
    partition then computes its own running sums.  Only a key that crosses from one partition into
    the next needs what came before; partitions are in key order, so there are fewer than twice as
    many such (key, partition) pairs as partitions, and they are broadcast.

    ``group_totals`` maps a name in ``totals`` to an output column with the sum of the whole key.
    Rows with equal (key, order) stay in one partition and follow each other in any order there.  Writing the partition number makes it a fact of the
    data, so a task that is run again after a lost executor cannot see another numbering.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    (
        df.withColumns({f"_add_{name}": col for name, col in totals.items()})
        .repartitionByRange(parts or range_count(spark), *keys, *order_by)
        .withColumn("_part", F.spark_partition_id())
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path)

    names = list(totals)
    per_part = ranged.groupBy(*keys, "_part").agg(
        *[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in names]
    )
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    crossing = F.broadcast(
        per_part.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_part").alias("_p"),
            F.count(F.lit(1)).over(of_key).alias("_parts"),
            *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in names],
            *[F.sum(f"_sum_{n}").over(of_key).alias(f"_all_{n}") for n in names],
        ).filter("_parts > 1")
    )

    in_part = Window.partitionBy(*keys, "_part")
    here = in_part.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns(
        {
            **{n: F.sum(f"_add_{n}").over(here) for n in names},
            **{f"_here_{n}": F.sum(f"_add_{n}").over(in_part) for n in group_totals or {}},
        }
    )
    condition = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(crossing, condition, "left")
    before = {n: F.col(f"_before_{n}") for n in names}
    return joined.select(
        *df.columns,
        *[
            F.when(before[n].isNull(), F.col(n)).otherwise(F.col(n) + before[n]).alias(n)
            for n in names
        ],
        *[
            F.coalesce(F.col(f"_all_{n}"), F.col(f"_here_{n}")).alias(out)
            for n, out in (group_totals or {}).items()
        ],
    )


def ordinal_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tie_key: str,
    out: str = "rank",
    hot: int = HOT,
) -> DataFrame:
    """1, 2, 3 … by ``value`` within each key; equal values are ordered by ``tie_key``.

    Spark has no row order to fall back on, hence the explicit tie key.  A NULL value has a NULL
    rank.  Rows are moved once, by key.  A key with more than ``hot`` rows is cut into ranges of
    value and tie at boundaries from a sample of it, and the numbers of rows in the ranges before
    are added, so a key may hold any share of the rows.  Only counts by key, and the boundaries of
    the hot keys, reach the driver: at most ``MOST_HOT`` keys with ``RANGES`` ranges each.
    """
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = counts.filter(F.col("_n") > hot).orderBy(F.col("_n").desc()).limit(MOST_HOT).collect()
    number = F.row_number()
    ordering = [F.col(value).asc_nulls_last(), F.col(tie_key).asc_nulls_first()]
    known = F.col(value).isNotNull()
    if not large:
        within = Window.partitionBy(*keys).orderBy(*ordering)
        return df.withColumn(out, F.when(known, number.over(within).cast("bigint")))

    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_n", T.LongType())])
    large = F.broadcast(spark.createDataFrame([tuple(r) for r in large], schema))
    place = F.struct(F.col(value).alias("v"), F.col(tie_key).alias("t"))
    # About 100 rows of a hot key for each of its ranges, whatever its size.
    chance = F.lit(100.0 * RANGES) / F.col("_n")
    drawn = join_per_group(df.filter(known).select(*keys, place.alias("_at")), large, keys)
    drawn = drawn.filter(F.rand(1) < chance)
    every = F.greatest(F.ceil(F.size("_drawn") / RANGES), F.lit(1)).cast("int")
    bounds = drawn.groupBy(*keys).agg(F.sort_array(F.collect_list("_at")).alias("_drawn"))
    bounds = bounds.withColumn("_every", every)
    bounds = bounds.select(*keys, F.expr("filter(_drawn, (x, i) -> (i + 1) % _every = 0)").alias("_bounds"))
    bounds = F.broadcast(spark.createDataFrame(bounds.collect(), bounds.schema))

    ranged = join_per_group(df.withColumn("_at", place), bounds, keys, "left")
    part = F.when(known, F.size(F.expr("filter(_bounds, x -> x <= _at)"))).otherwise(F.lit(RANGES * 200))
    ranged = ranged.withColumn("_part", F.when(F.col("_bounds").isNull(), 0).otherwise(part))
    ranged = ranged.drop("_at", "_bounds")
    per_part = join_per_group(ranged.select(*keys, "_part"), bounds.select(*keys), keys)
    per_part = per_part.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.withColumn("_before", F.sum("_rows").over(earlier)).drop("_rows")
    within = Window.partitionBy(*keys, "_part").orderBy(*ordering)
    local = ranged.withColumn(out, number.over(within).cast("bigint"))
    joined = join_per_group(local, F.broadcast(before), [*keys, "_part"], "left")
    rank = F.col(out) + F.coalesce("_before", F.lit(0))
    return joined.select(*df.columns, F.when(known, rank).alias(out))
