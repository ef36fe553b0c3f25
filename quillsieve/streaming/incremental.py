"""Incremental jobs: new files are processed as they arrive, keys already passed are skipped by keyed state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillsieve.sources.readers import stored_tables

#: Keyed state of seen keys lives in RocksDB on the executors, not in their heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"


def process_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    step: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    key: str | None = None,
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Apply ``step`` to every parquet file not yet seen and append the results.

    ``glob`` names files of ``source``, and folders of part files that are one table each.
    A micro-batch writes one ``batch_id`` folder and replaces it if it is run again, so a restart
    neither loses nor repeats rows. Give ``key`` if the same document can arrive in several
    files: the stream then keeps the keys it has passed as keyed state, partitioned by key over
    the executors and saved with the checkpoint. A batch looks up only its own keys, so no
    batch reads earlier results or all keys; of rows sharing a key the first to arrive stays,
    and a null key counts as one key. Where the session names no state store, RocksDB holds the
    state. Stops when all present files are done.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if stored_tables(spark, source, glob):
        # A filter on names looks at files only; the path is looked up anew for each batch.
        stream = reader.parquet(f"{source}/{glob}")
    else:
        stream = reader.option("pathGlobFilter", glob).parquet(source)
    if key is not None:
        if not spark.conf.get(STATE_STORE_KEY, None) or spark.conf.get(STATE_STORE_KEY).endswith("HDFSBackedStateStoreProvider"):
            spark.conf.set(STATE_STORE_KEY, STATE_STORE)
        stream = stream.dropDuplicates([key])

    def write(batch: DataFrame, batch_id: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
