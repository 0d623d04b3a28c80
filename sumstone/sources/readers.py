"""Tables from CSV, Parquet and local data."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Quoting of CSV files (RFC 4180), for reading and writing alike.
DIALECT = {"quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = True,
    null_marker: str | None = None,
    date_format: str | None = None,
    timestamp_format: str | None = None,
    all_text: bool = False,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV with a header line; ``path`` may be a file, a folder, a glob or a list of them.

    Fields are quoted with ``"`` and a quote inside is doubled, as other tools write them; with
    ``multi_line`` a quoted field may hold line breaks (such a file is read by one task).  A schema
    names columns of the header, in any order; files read together have one order, or the job stops.
    A value of the wrong type or a row of the wrong
    length stops the job; ``mode="PERMISSIVE"`` turns it into NULL instead.

    With a schema (preferred for large inputs) the files are read once and only the columns a query
    uses are parsed.  Without one, ``infer`` reads the files a first time to find the types.
    An empty field reads as NULL, quoted or not.  ``null_marker`` reads as NULL, so that the column can still be a number; ``all_text`` keeps
    every column as text.
    """
    reader = spark.read.options(**DIALECT, header=True, mode=mode, multiLine=multi_line)
    if null_marker is not None:
        reader = reader.option("nullValue", null_marker)
    if date_format is not None:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format is not None:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is not None:
        return _by_name(reader, path, schema)
    return reader.option("inferSchema", infer and not all_text).csv(path)


def _by_name(reader: DataFrameReader, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Columns of ``schema`` by their names in the header, which is read first (one line)."""
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    header = reader.option("inferSchema", False).csv(path).columns
    missing = [f.name for f in declared if f.name not in header]
    if missing:
        raise ValueError(f"not in the header of {path}: {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in declared}
    ordered = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in header])
    found = reader.schema(ordered).option("enforceSchema", False).csv(path)
    return found.select(*[F.col(f"`{f.name}`") for f in declared])


def csv_view(
    spark: SparkSession, name: str, path: str, schema: str | None = None
) -> DataFrame:
    """Make a CSV file a table of the session's SQL under ``name``."""
    options = "header 'true', quote '\"', escape '\"', mode 'FAILFAST'"
    options += ", enforceSchema 'false'" if schema else ", inferSchema 'true'"
    columns = f" ({schema})" if schema else ""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}`{columns} USING csv "
        f"OPTIONS (path '{path}', {options})"
    )
    return spark.table(name)


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Parquet; with ``schema`` the footers are not consulted for types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*path) if isinstance(path, list) else reader.parquet(path)
    return df if columns is None else df.select(*columns)


def read_parquet_nanos(
    spark: SparkSession, path: str, schema: str, nano_columns: Sequence[str]
) -> DataFrame:
    """Parquet that holds nanosecond timestamps, which Spark's type inference refuses.

    ``schema`` lists the nanosecond columns as ``bigint``.  They come back as zone-less timestamps
    cut to microseconds.  ``spark.sql.legacy.parquet.nanosAsLong`` must be ``true`` in the session;
    leave the columns out of the schema where it cannot be set.
    """
    df = spark.read.schema(schema).parquet(path)
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    micros = {
        c: epoch
        + F.make_dt_interval(
            secs=(F.floor(F.col(c) / F.lit(1000)) / F.lit(1_000_000)).cast("decimal(18,6)")
        )
        for c in nano_columns
    }
    return df.withColumns(micros)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a frame a table of the session's SQL."""
    df.createOrReplaceTempView(name)
    return df


def register_files(spark: SparkSession, tables: dict[str, str]) -> None:
    """A view per Parquet path: ``{name: path}``."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def query(
    spark: SparkSession, text: str, args: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """SQL over frames passed by name: ``query(spark, "SELECT … FROM {sales}", sales=df)``.

    ``args`` binds the values of named parameters (``:least``) without writing them into the text.
    """
    return spark.sql(text, args, **frames)


def from_columns(spark: SparkSession, columns: dict[str, Sequence], schema: str) -> DataFrame:
    """A small table from local lists, one per column.

    Up to 10,000 rows are broadcast to a join: Spark doesn't know the size of local rows and would
    shuffle the other side too, all rows of a frequent key into one task.
    """
    rows = list(zip(*columns.values(), strict=True))
    made = spark.createDataFrame(rows, schema)
    return F.broadcast(made) if len(rows) <= 10_000 else made


def schema_table(df: DataFrame) -> DataFrame:
    """Position, name and type of every column; reads no data."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string"
    )
