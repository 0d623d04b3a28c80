"""Data checks and profiles of tables and files."""

from __future__ import annotations

import datetime as dt
import decimal
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class RowCountError(ValueError):
    """A table does not have the expected number of rows."""


def dataset_summary(df: DataFrame) -> DataFrame:
    """File name, rows, columns and size for every file a frame was read from.

    A file without rows is there with zero of them: the first task of a write leaves one, with a
    header only, if it has no rows.  Names and sizes are those of the file listing.
    """
    path, file, size = (F.col(f"_metadata.{c}") for c in ("file_path", "file_name", "file_size"))
    seen = [path.alias("_path"), file.alias("file"), size.alias("_bytes")]
    per_file = df.select(*seen, F.lit(1).alias("_row"))
    # The names come encoded, and a reader takes them as globs.
    names = [re.sub(r"([][{}*?\\])", r"\\\1", unquote(name)) for name in df.inputFiles()]
    if names:
        listed = df.sparkSession.read.format("binaryFile").load(names)
        per_file = per_file.unionByName(listed.select(*seen, F.lit(0).alias("_row")))
    return (
        per_file.groupBy("_path", "file", "_bytes")
        .agg(F.sum("_row").alias("rows"))
        .select(
            "file",
            "rows",
            F.lit(len(df.columns)).alias("columns"),
            F.round(F.col("_bytes") / F.lit(1024) / F.lit(1024), 2).alias("size_mb"),
            F.col("_bytes").alias("bytes"),
        )
    )


def require_rows(df: DataFrame, expected: int) -> DataFrame:
    """Return ``df`` if it has ``expected`` rows, else raise :class:`RowCountError`."""
    found = df.count()
    if found != expected:
        raise RowCountError(f"expected {expected} rows, found {found}")
    return df


def row_count_check(df: DataFrame, expected: int) -> DataFrame:
    """One row with the expected and the found number of rows and whether they agree."""
    return df.agg(F.count(F.lit(1)).alias("found")).select(
        F.lit(expected).cast("bigint").alias("expected"),
        "found",
        (F.col("found") == F.lit(expected)).alias("ok"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, rows and non-null rows; one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("non_null"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.inline(entries))


FOOTER = (
    "path string, file string, bytes bigint, rows bigint, columns int, row_groups int, position int, "
    "column_name string, data_type string, nulls bigint, least double, most double, "
    "first_text string, last_text string, column_bytes bigint"
)


def footer_facts(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per Parquet file and column, from the footers alone.

    File: ``bytes, rows, columns, row_groups``.  Column: ``position, column_name, data_type`` (as the
    file declares it), ``nulls``, the smallest and largest value (``least, most`` of numbers and, in
    seconds since 1970, of times; ``first_text, last_text`` of texts) and ``column_bytes``
    (compressed).  What a writer left out of its statistics is NULL.  Files are listed without their
    content, footers are read by the executors.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    names = [part.split()[0] for part in FOOTER.split(", ")]

    def number(value) -> float | None:
        if isinstance(value, bool) or value is None:
            return None
        if isinstance(value, dt.datetime):
            zoned = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
            return zoned.timestamp()
        if isinstance(value, dt.date):
            return float((value - dt.date(1970, 1, 1)).days * 86_400)
        return float(value) if isinstance(value, (int, float, decimal.Decimal)) else None

    def facts(meta, position: int) -> tuple:
        nulls, low, high, size = 0, [], [], 0
        for group in range(meta.num_row_groups):
            column = meta.row_group(group).column(position)
            size += column.total_compressed_size
            stats = column.statistics
            full = stats is not None and stats.has_null_count
            nulls = nulls + stats.null_count if full and nulls is not None else None
            if full and stats.null_count == column.num_values:
                continue  # nothing but nulls
            known = stats is not None and stats.has_min_max
            low.append(stats.min if known else None)
            high.append(stats.max if known else None)
        whole = bool(low) and None not in low and None not in high
        least, most = (min(low), max(high)) if whole else (None, None)
        text = isinstance(least, str)
        return (
            nulls, number(least), number(most), least if text else None, most if text else None, size
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            for uri, size in zip(*(batch.column(c).to_pylist() for c in ("path", "length"))):
                store, inner = pafs.FileSystem.from_uri(uri)
                meta = pq.read_metadata(inner, filesystem=store)
                types = meta.schema.to_arrow_schema()
                rows = []
                for i in range(meta.num_columns):
                    field = meta.schema.column(i)
                    kind = str(types.field(field.name).type) if field.name in types.names else field.physical_type
                    rows.append(
                        (uri, uri.rsplit("/", 1)[-1], size, meta.num_rows, meta.num_columns,
                         meta.num_row_groups, i, field.path, kind, *facts(meta, i))
                    )
                columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _FOOTER_TYPES)], names
                )

    return listed.select("path", "length").mapInArrow(read, FOOTER)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
_FOOTER_TYPES = [_ARROW[part.split()[1]] for part in FOOTER.split(", ")]


def parquet_footers(spark: SparkSession, *paths: str) -> DataFrame:
    """Size, rows, columns and row groups of every Parquet file, from the footers alone."""
    first = footer_facts(spark, *paths).filter("position = 0")
    return first.select("file", "rows", "columns", "row_groups", "bytes")


def parquet_summary(spark: SparkSession, *paths: str) -> DataFrame:
    """:func:`dataset_summary` of Parquet files without reading a row."""
    megabytes = F.round(F.col("bytes") / F.lit(1024) / F.lit(1024), 2)
    return parquet_footers(spark, *paths).select("file", "rows", "columns", megabytes.alias("size_mb"))


def parquet_columns(spark: SparkSession, *paths: str) -> DataFrame:
    """Type, rows, nulls and extreme values of every column over all files, from the footers."""
    by_column = footer_facts(spark, *paths).groupBy("position", "column_name", "data_type")

    def known(name: str, value: Column) -> Column:
        # One file without a statistic leaves the whole unknown, unless the file has only nulls.
        bare = F.col(name).isNull() & ~F.col("nulls").eqNullSafe(F.col("rows"))
        return F.when(F.count_if(bare) == 0, value)

    return by_column.agg(
        F.sum("rows").alias("rows"),
        F.when(F.count("nulls") == F.count(F.lit(1)), F.sum("nulls")).alias("nulls"),
        known("least", F.min("least")).alias("least"),
        known("most", F.max("most")).alias("most"),
        known("first_text", F.min("first_text")).alias("first_text"),
        known("last_text", F.max("last_text")).alias("last_text"),
        F.sum("column_bytes").alias("column_bytes"),
    )


def result_sizes(results: dict[str, DataFrame]) -> DataFrame:
    """Row count of several results side by side, to compare runs."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("result"), "rows")
        for name, df in results.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
