"""Arrow IPC files: parallel read by record batch, one file per task on write."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema


def read_arrow_ipc(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    batches_per_task: int = 16,
    tasks: int | None = None,
) -> DataFrame:
    """Arrow IPC files below ``path`` (file, folder or glob) as one table.

    Files are listed without content and opened by the executors.  A file is split into runs of
    record batches that are spread over ``tasks`` (four per core by default), so one large file is
    read by many of them.  Only the wanted columns are decoded.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    first = files.first()
    if first is None:
        raise FileNotFoundError(f"no Arrow IPC file below {path}")
    with _open(first["path"]) as source:
        arrow_schema = pa.ipc.open_file(source).schema
    wanted = list(columns) if columns is not None else arrow_schema.names
    out_schema = from_arrow_schema(
        pa.schema([arrow_schema.field(c) for c in wanted]), prefer_timestamp_ntz=True
    )
    target = to_arrow_schema(out_schema)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris, starts = [], []
            for uri in batch.column("path").to_pylist():
                with _open(uri) as source:
                    n = pa.ipc.open_file(source).num_record_batches
                for start in range(0, n, batches_per_task):
                    uris.append(uri)
                    starts.append(start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uris, pa.string()), pa.array(starts, pa.int32())], names=["path", "start"]
            )

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _open(uri) as source:
                    names = pa.ipc.open_file(source).schema.names  # files may order them anew
                    options = pa.ipc.IpcReadOptions(included_fields=[names.index(c) for c in wanted])
                    reader = pa.ipc.open_file(source, options=options)
                    stop = min(start + batches_per_task, reader.num_record_batches)
                    for i in range(start, stop):
                        data = pa.Table.from_batches([reader.get_batch(i)]).select(wanted)
                        yield from data.cast(target).to_batches()

    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    runs = files.mapInArrow(plan, "path string, start int")
    return runs.repartition(tasks, "path", "start").mapInArrow(load, out_schema)


def write_arrow_ipc(df: DataFrame, path: str, rows_per_batch: int = 65_536) -> DataFrame:
    """Write one Arrow IPC file per partition to a new folder and return a manifest (file, rows).

    A folder that exists is refused, so files of two writes never mix.  A task writes under a name of
    its own attempt and renames at the end, so a task that runs twice leaves one complete file.  The
    manifest, one row per partition, is stored beside the files.
    """
    spark = df.sparkSession
    schema = to_arrow_schema(df.schema)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(where):
        raise FileExistsError(path)
    path = system.makeQualified(where).toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, folder = _store(path)
        fs.create_dir(folder, recursive=True)
        final = f"{folder}/part-{task.partitionId():05d}.arrow"
        working = f"{folder}/_attempt-{task.partitionId():05d}-{task.taskAttemptId()}"
        rows = 0
        with fs.open_output_stream(working) as sink, pa.ipc.new_file(sink, schema) as writer:
            for batch in batches:
                rows += batch.num_rows
                table = pa.Table.from_batches([batch]).cast(schema)
                writer.write_table(table, max_chunksize=rows_per_batch)
        fs.move(working, final)
        yield pa.RecordBatch.from_arrays(
            [pa.array([final], pa.string()), pa.array([rows], pa.int64())], names=["file", "rows"]
        )

    listed = f"{path}/_manifest"
    df.mapInArrow(write, "file string, rows bigint").write.parquet(listed)
    return spark.read.schema("file string, rows bigint").parquet(listed).orderBy("file")


def _store(uri: str):
    """Arrow's file system for a Hadoop URI, and the path in it."""
    import pyarrow.fs as pafs

    for theirs, ours in (("s3a:", "s3:"), ("s3n:", "s3:"), ("dbfs:", "file:///dbfs")):
        if uri.startswith(theirs):
            uri = ours + uri[len(theirs) :]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def _open(uri: str):
    fs, inner = _store(uri)
    return fs.open_input_file(inner)


# The helpers travel to the executors with the functions that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
