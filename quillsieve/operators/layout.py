"""Shards, splits and the equal re-shard."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX = "row_index"


def contiguous_shard(index: Column, total: int, num_shards: int) -> Column:
    """Shard of each position when ``total`` rows are cut into contiguous, nearly equal shards.

    The first ``total mod num_shards`` shards hold one row more than the others.
    """
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")
    small, larger = divmod(total, num_shards)
    border = larger * (small + 1)
    head = F.floor(index / F.lit(small + 1))
    tail = F.lit(larger) + F.floor((index - F.lit(border)) / F.lit(max(small, 1)))
    return F.when(index < border, head).otherwise(tail).cast("int")


def modulo_shard(index: Column, num_shards: int) -> Column:
    """Shard of each position, dealt out in turn."""
    return F.pmod(index, F.lit(num_shards)).cast("int")


def equal_shard(index: Column, total: int, num_shards: int) -> Column:
    """``floor(total / num_shards)`` rows per shard; the last shard takes the remainder."""
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")
    per_shard = total // num_shards
    if per_shard == 0:
        raise ValueError(f"{num_shards} shards need at least as many rows, got {total}")
    return F.least(F.floor(index / F.lit(per_shard)), F.lit(num_shards - 1)).cast("int")


def place_rows(df: DataFrame, shard: Column, start: Column, biggest: int, num_shards: int, rows_per_task: int = 200_000) -> DataFrame:
    """Add ``shard``, as five digits, and move each contiguous run of rows to the task that writes it.

    ``start`` is the first position of a row's shard and ``biggest`` the most positions a shard
    spans. The task follows from the position by arithmetic, so no sampling pass reads the data,
    and a shard of any size is written by as many tasks as it needs. The sort begins with the
    shard because a partitioned write would otherwise sort by it alone.
    """
    tasks_per_shard = max(1, math.ceil(biggest / rows_per_task))
    chunk = math.ceil(biggest / tasks_per_shard)
    task = shard * F.lit(tasks_per_shard) + F.floor((F.col(INDEX) - start) / F.lit(chunk))
    return (
        df.repartitionById(num_shards * tasks_per_shard, task.cast("int"))
        .withColumn("shard", F.lpad(shard.cast("string"), 5, "0"))
        .sortWithinPartitions("shard", INDEX)
    )


def place_equal_shards(df: DataFrame, total: int, num_shards: int, rows_per_task: int = 200_000) -> DataFrame:
    """Place rows in equal shards, the remainder in the last."""
    per_shard = total // num_shards
    shard = equal_shard(F.col(INDEX), total, num_shards)
    return place_rows(df, shard, shard * F.lit(per_shard), per_shard + total % num_shards, num_shards, rows_per_task)


def place_contiguous_shards(df: DataFrame, total: int, num_shards: int, rows_per_task: int = 200_000) -> DataFrame:
    """Place rows in contiguous, nearly equal shards."""
    small, larger = divmod(total, num_shards)
    shard = contiguous_shard(F.col(INDEX), total, num_shards)
    start = shard * F.lit(small) + F.least(shard, F.lit(larger))
    return place_rows(df, shard, start, small + 1, num_shards, rows_per_task)


def positional_split(index: Column, total: int, train_share: float = 0.9) -> Column:
    """``train`` for the first ``int(train_share * total)`` positions, ``test`` for the rest."""
    return F.when(index < int(train_share * total), F.lit("train")).otherwise(F.lit("test"))


#: Split names accepted as validation data, in order of preference.
VALIDATION_NAMES = ("validation", "val", "test")


def validation_rows(df: DataFrame, split: str = "split", index: str = INDEX, share: float = 0.2) -> DataFrame:
    """The validation rows: a split of that name, else the first fifth of the training rows.

    ``index`` must count the training rows from 0.
    """
    present = df.filter(F.col(split).isin(*VALIDATION_NAMES)).select(split).distinct().collect()
    for wanted in VALIDATION_NAMES:
        if (wanted,) in present:
            return df.filter(F.col(split) == wanted)
    train = df.filter(F.col(split) == "train")
    return train.filter(F.col(index) < int(share * train.count()))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def _hashable(field: T.StructField) -> Column:
    """A column as the hash takes it: maps as their entries in order of the keys."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.MapType) and not _holds_map(field.dataType.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(column) if _holds_map(field.dataType) else column


def content_summary(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash of all cells, as one row.

    Maps are equal whatever the order of their entries, unless they lie inside other values.
    """
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.xxhash64(*[_hashable(f) for f in df.schema]).cast("decimal(38,0)")).alias("content_hash"),
    )


def parity(before: DataFrame, after: DataFrame) -> DataFrame:
    """Compare two scans: files, rows and content, whatever the order of rows. One row."""
    columns = before.columns
    old = content_summary(before).select(
        F.lit(len(before.inputFiles())).alias("files_before"), F.col("num_rows").alias("rows_before"), F.col("content_hash").alias("_old"), F.lit(1).alias("_k")
    )
    new = content_summary(after.select(*columns)).select(
        F.lit(len(after.inputFiles())).alias("files_after"), F.col("num_rows").alias("rows_after"), F.col("content_hash").alias("_new"), F.lit(1).alias("_k")
    )
    return old.join(new, "_k").select(
        "files_before",
        "files_after",
        "rows_before",
        "rows_after",
        (F.col("rows_before") == F.col("rows_after")).alias("rows_equal"),
        F.col("_old").eqNullSafe(F.col("_new")).alias("content_equal"),
    )
