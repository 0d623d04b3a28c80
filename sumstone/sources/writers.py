"""CSV and Parquet sinks, conversion, results for the client."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sumstone.sources.readers import DIALECT, read_csv


def write_csv(df: DataFrame, path: str, append: bool = False, files: int | None = None) -> None:
    """Folder of CSV part files, each with a header.

    ``files`` merges or splits the output to that many files, without sorting.
    """
    if files is not None:
        df = df.repartition(files)
    # Trailing and leading blanks are content, and an empty text is not a null.
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""'}
    writer = df.write.mode("append" if append else "errorifexists")
    writer.options(**DIALECT, **plain, header=True).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = "zstd",
    level: int | None = None,
    max_rows_per_file: int | None = None,
    row_group_bytes: int | None = None,
    partition_by: list[str] | None = None,
    append: bool = False,
) -> None:
    """Folder of Parquet part files; every task streams its own rows into its own file.

    Memory is bounded by ``row_group_bytes`` per open file and file size by ``max_rows_per_file``.
    """
    writer = df.write.mode("append" if append else "errorifexists").option("compression", codec)
    if level is not None:
        writer = writer.option(f"parquet.compression.codec.{codec}.level", level)
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def packed_csv(
    spark: SparkSession, glob: str, files: int, schema: str | None = None
) -> DataFrame:
    """CSV files as ``files`` partitions of about equal bytes, without moving a row.

    The file source packs its files, and pieces of large ones, into read tasks by size; told to make
    eight for each wanted partition, it leaves pieces fine enough to be put together evenly.  The
    frame belongs to a session of its own, whose settings ask for that.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.minPartitionNum", 8 * files)
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 40))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return read_csv(own, glob, schema=schema, all_text=schema is None).coalesce(files)


#: Bytes that one task of a compaction reads and writes.
MOST_PACKED = 256 * 1024 * 1024


def compact_csv(
    spark: SparkSession,
    glob: str,
    target: str,
    files: int,
    schema: str | None = None,
    most_bytes: int = MOST_PACKED,
) -> None:
    """Many CSV files with the same header into at most ``files`` larger ones of like size.

    A file is written by one task, so there are more of them where one would hold more than about
    ``most_bytes`` otherwise.
    """
    total = folder_bytes(spark, glob).first()["bytes"]
    write_csv(packed_csv(spark, glob, max(files, -(-total // most_bytes)), schema), target)


def append_once(df: DataFrame, folder: str, batch: str) -> bool:
    """Add the rows of a result to a folder of CSV results; a batch that is there adds nothing.

    The rows are written beside the folder's batches and renamed into place as a whole, so readers
    see a batch completely or not at all, and a run that is repeated after a failure leaves one copy.
    Returns whether the batch was added.  :func:`read_results` reads all batches.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{folder}/batch={batch}")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(target):
        return False
    staged = f"{folder}/_staged-{uuid.uuid4().hex}"
    write_csv(df, staged)
    # A rename onto a folder that came up meanwhile would put ours inside it, so it is looked for
    # once more; one writer at a time is assumed per batch, as for a file.
    added = not store.exists(target) and store.rename(hadoop.Path(staged), target)
    if not added:
        store.delete(hadoop.Path(staged), True)
    return bool(added)


def read_results(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All batches of :func:`append_once`; one header is read for all files."""
    return read_csv(spark, f"{folder}/batch=*", schema=schema)


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row: number and total size of the data files below a path, from the file listing."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"),
        )
    )


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    schema: str | None = None,
    codec: str = "zstd",
    level: int | None = 3,
) -> DataFrame:
    """Convert CSV to Parquet and report rows, both sizes and their ratio as one row.

    Rows are counted while they are written; sizes come from the file listings.
    """
    seen = Observation()
    rows = read_csv(spark, source, schema=schema).observe(seen, F.count(F.lit(1)).alias("rows"))
    write_parquet(rows, target, codec=codec, level=level)
    before, after = (folder_bytes(spark, path).first()["bytes"] for path in (source, target))
    report = [(seen.get["rows"], before, after, before / after if after else None)]
    return spark.createDataFrame(
        report, "rows bigint, csv_bytes bigint, parquet_bytes bigint, ratio double"
    )


def to_rows(df: DataFrame) -> list[dict[str, Any]]:
    """A report as a list of dicts: for results that are small by construction (a top-k, a total by
    month); :func:`iterate` hands over others, and the writers store them."""
    return [r.asDict() for r in df.collect()]


def to_pandas(df: DataFrame):
    """A small report as a pandas frame."""
    return to_arrow(df).to_pandas()


def to_arrow(df: DataFrame):
    """A small report as an Arrow table."""
    return df.toArrow()


def iterate(df: DataFrame):
    """Row iterator that holds one partition at a time on the driver."""
    return df.toLocalIterator(prefetchPartitions=True)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
