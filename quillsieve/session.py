"""Session settings and the shared folder for materialised intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Folder made for a local session that names none, by application.
_local_folders: dict[str, str] = {}

#: Settings every job wants; all are runtime settings, safe on a shared session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Texts have no length limit, so Arrow batches are bounded by bytes, not only rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    On a cluster shuffles start with several partitions per core, which adaptive execution
    merges where they turn out small.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if not spark.sparkContext.master.startswith("local"):
        configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(configured, 4 * spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillsieve")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read and write, named by ``spark.checkpoint.dir``.

    Where the setting is missing a local master falls back to a new temporary folder; a
    cluster must name one, because a machine-local folder would not be seen by the others.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        app = spark.sparkContext.applicationId
        folder = _local_folders.setdefault(app, "") or tempfile.mkdtemp(prefix="quillsieve-")
        _local_folders[app] = folder
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_folder(spark), "quillsieve", spark.sparkContext.applicationId, f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str = "table", partition_by: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, or to a new ``path`` there, and read it back.

    The written table cuts the lineage and survives the loss of executors, so values that
    could differ between two evaluations (task ids, answers of a responder) are fixed.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, label)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete one intermediate table, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_materialised(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, once their results are written."""
    drop_folder(spark, os.path.join(shared_folder(spark), "quillsieve", spark.sparkContext.applicationId))
