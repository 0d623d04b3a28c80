"""File streams, incremental aggregates, file-to-file conversion.

Each function starts a query that takes everything available, stops, and can be started again on
the same checkpoint: input files are then processed once, whatever fails in between.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sumstone.sources.readers import DIALECT


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    file_glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of files as a stream; ``file_glob`` selects files by name."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.options(**DIALECT, header=True, mode="FAILFAST", enforceSchema=False)
    if file_glob is not None:
        reader = reader.option("pathGlobFilter", file_glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def complete_result(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Run an aggregated stream over all available input and return its whole result.

    Every batch writes the complete result to a folder named after the batch number, so a batch
    that is repeated after a failure overwrites itself; the last folder is the answer.  The one
    before it is kept until the next batch is written, older ones go.  Nothing passes through the
    driver.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        _remove(batch.sparkSession, f"{target}/batch={number - 2}")

    _finish(
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
    )
    spark = stream.sparkSession
    results = spark.read.schema(
        T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    ).parquet(target)
    last = results.agg(F.max("batch")).first()[0]
    return results.filter(F.col("batch") == F.lit(last)).drop("batch")


def changed_result(
    stream: DataFrame, keys: Sequence[str], target: str, checkpoint: str, merge_every: int = 20
) -> DataFrame:
    """Run an aggregated stream over all available input; each batch writes only the keys it changed.

    A batch's rows go to a folder named after its number, so a batch that is repeated after a failure
    overwrites itself.  The result is read by taking the row of the latest batch for each key, NULL
    being a key.  Every ``merge_every`` batches the folder of a batch holds all keys instead; older
    folders go with the batch after it, when that one cannot be repeated any more.  So what is
    written follows the changes, and what is read is bounded by the keys and the changes of
    ``merge_every`` batches.
    """
    rows = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    values = [f.name for f in stream.schema if f.name not in keys]

    def latest(changes: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*values), "batch").alias("_row")
        return changes.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*stream.columns)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number and number % merge_every == 0:
            earlier = spark.read.schema(rows).parquet(target).filter(F.col("batch") < number)
            batch = latest(earlier.unionByName(batch.withColumn("batch", F.lit(number).cast("bigint"))))
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        if number > merge_every and number % merge_every == 1:
            for old in range(max(0, number - 2 * merge_every - 1), number - 1):
                _remove(spark, f"{target}/batch={old}")

    _finish(
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
    )
    return latest(stream.sparkSession.read.schema(rows).parquet(target))


def appended_result(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Run a stream in append mode into Parquet and return what has been written so far.

    With a watermark only closed windows appear; open ones are held back until later input
    closes them.
    """
    _finish(
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


def incremental_aggregate(
    stream: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]
) -> DataFrame:
    """The streaming twin of ``grouped``: state is one row per key."""
    return stream.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def incremental_tumbling(
    stream: DataFrame,
    ts: str,
    width: dt.timedelta,
    aggregates: dict[str, Column],
    late: dt.timedelta,
    bucket: str = "bucket",
) -> DataFrame:
    """Aggregates per fixed time bucket with a bound on lateness.

    In append mode a row older than the newest time less ``late`` is dropped and a bucket is
    released once it can no longer change.  In complete mode all buckets are kept.  Watermarks
    need a zoned timestamp, so a zone-less one is read in the session's zone (keep that at UTC).
    """
    micros = round(width.total_seconds() * 1_000_000)
    zoned = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        zoned.withWatermark(ts, f"{round(late.total_seconds())} seconds")
        .groupBy(F.window(ts, f"{micros} microseconds").alias("_w"))
        .agg(*[c.alias(n) for n, c in aggregates.items()])
        .select(F.col("_w.start").cast("timestamp_ntz").alias(bucket), *aggregates)
    )


def convert_stream(
    stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet"
) -> DataFrame:
    """Copy a file stream to another format, each input row exactly once."""
    writer = stream.writeStream.outputMode("append").format(fmt).option("path", target)
    if fmt == "csv":
        writer = writer.options(**DIALECT, header=True)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True))
    reader = stream.sparkSession.read.schema(stream.schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**DIALECT, header=True, mode="FAILFAST", enforceSchema=False)
    return reader.load(target)


def _remove(spark: SparkSession, folder: str) -> None:
    """Drop a result of this module that a later one has replaced."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _finish(writer) -> None:
    running = writer.start()
    running.awaitTermination()
