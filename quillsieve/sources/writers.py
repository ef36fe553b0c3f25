"""Sinks: annotated parquet, shards, metadata-only and result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillsieve.operators.annotate import stats_lines, stats_projection
from quillsieve.operators.layout import place_equal_shards

#: Codec of re-sharded files. Brotli needs a codec jar that Spark does not ship.
DEFAULT_CODEC = "zstd"


def write_parquet(df: DataFrame, folder: str, codec: str = DEFAULT_CODEC, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", codec).parquet(folder)


def write_annotated(df: DataFrame, data_folder: str, stats_folder: str | None = None, mode: str = "error", **stats_options) -> None:
    """Write scored documents and, from what was written, their metadata as JSON lines.

    The second output reads the first, so that no document is scored twice. Unless
    ``metadata_keys`` names some, every key of a ``metadata`` map is written.
    """
    write_parquet(df, data_folder, mode=mode)
    if stats_folder is not None:
        written = df.sparkSession.read.schema(df.schema).parquet(data_folder)
        column = stats_options.get("metadata", "metadata")
        every_key = not stats_options.get("metadata_keys") and isinstance(dict(zip(df.columns, (f.dataType for f in df.schema))).get(column), T.MapType)
        if every_key:
            stats_options.pop("metadata_keys", None)
            stats_lines(written, **stats_options).write.mode(mode).text(stats_folder)
        else:
            stats_projection(written, **stats_options).write.mode(mode).json(stats_folder)


def threshold_folder(out: str, threshold: float, config: str, split: str) -> str:
    """Folder of a filtered dataset; the threshold is part of its name."""
    return f"{out}_threshold_{threshold:g}/data/{config}/{split}"


def write_shards(df: DataFrame, folder: str, total: int, num_shards: int, codec: str = DEFAULT_CODEC, mode: str = "error", rows_per_task: int = 200_000) -> None:
    """Write rows that carry ``row_index`` as equal contiguous shards, one folder each.

    Files sort in row order by path. A shard of more than ``rows_per_task`` rows is written as
    several files by as many tasks.
    """
    placed = place_equal_shards(df, total, num_shards, rows_per_task).drop("row_index")
    placed.write.mode(mode).option("compression", codec).partitionBy("shard").parquet(folder)


def write_results(df: DataFrame, folder: str, partition_by: Sequence[str] = ("run_id",), overwrite: bool = False) -> None:
    """Append result rows to their run as JSON lines, or replace the runs at hand."""
    writer = df.write.partitionBy(*partition_by).option("ignoreNullFields", False)
    if overwrite:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").json(folder)
    else:
        writer.mode("append").json(folder)
