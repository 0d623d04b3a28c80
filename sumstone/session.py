"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime re-planning carries most of the weight at scale: it sizes shuffle partitions from the
# bytes really written, turns sort-merge joins into broadcast joins once a side proves small, and
# splits hot join partitions.  The static broadcast limit stays a *checked* limit (Spark compares
# it with file statistics before planning), so no function here needs an unchecked hint.
DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.csv.filterPushdown.enabled": "true",
}

# Streaming state on disk, as incremental aggregates may have more keys than fit in memory.
LARGE_STATE: dict[str, str] = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "sumstone",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    large_state: bool = True,
) -> SparkSession:
    """Return a session with the defaults above; ``conf`` wins over them.

    The state of streaming aggregates is kept on disk, or in memory without ``large_state``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    chosen = {**DEFAULTS, **(LARGE_STATE if large_state else {}), **(conf or {})}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one beside the warehouse.

    Both are settings of the session, so a cluster names its shared store once; a folder of one
    machine is never made up here.  On a cluster a warehouse on local disks is refused: each machine
    would write to its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local_disk = warehouse.startswith(("file:", "/")) or "://" not in warehouse
    if local_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return warehouse + "/_scratch"


#: Scratch folders named in this process, until they are removed.
_MADE: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub-folder of the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders that this process named, and return how many there were.

    To be called once results are stored elsewhere: frames that still read a folder fail afterwards.
    """
    removed = 0
    while _MADE:
        removed += remove_folder(spark, _MADE[-1])
    return removed


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove one scratch folder that nothing reads any more; whether there was one."""
    _MADE.remove(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(store.exists(folder) and store.delete(folder, True))
