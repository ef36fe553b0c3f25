"""Decisions that depend on the size of the data, taken from a check rather than a guess."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.session import materialise

#: Stored bytes and rows a side may have before it is no longer broadcast. Parquet of keys and
#: numbers grows several times over in memory, so this stays in the tens of megabytes.
BROADCAST_BYTES = 8 * 1024 * 1024
BROADCAST_ROWS = 500_000
#: Bytes of input a task should get, by the planner's estimate.
SPLIT_BYTES = 128 * 1024 * 1024
#: Bytes of input beyond which rows are never dealt out anew just to fill the cores.
SPREAD_BYTES = 16 * 1024 * 1024 * 1024
#: Sizes from here on are the planner's placeholder for an unknown one.
UNKNOWN_BYTES = 1 << 60
#: Partitions of one shuffle the driver can keep track of.
MAX_PARTITIONS = 200_000


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables a frame reads; None where the planner does not know them.

    The planner's estimate for the result itself is of no use here: it multiplies the sides of
    every join.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(size >= UNKNOWN_BYTES for size in sizes) else sum(sizes)


def partitions_for(df: DataFrame) -> tuple[int, ...]:
    """Leading arguments of a repartition: a number where the data needs more than the session's.

    Without a number adaptive execution may merge small partitions; it never cuts large ones.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = math.ceil((input_bytes(df) or 0) / SPLIT_BYTES)
    if needed > MAX_PARTITIONS:
        raise ValueError(f"{needed} partitions of {SPLIT_BYTES} bytes are more than one shuffle can have; read the input in parts")
    return (needed,) if needed > configured else ()


def small_side(df: DataFrame) -> DataFrame:
    """A join side, stored once, and marked for broadcast if what was stored is small.

    The rows are counted from the stored footers. Beyond the bounds the planner joins by shuffle,
    where adaptive execution splits the partitions of hot keys.
    """
    side = materialise(df, "side")
    size = input_bytes(side)
    small = size is not None and size <= BROADCAST_BYTES and side.count() <= BROADCAST_ROWS
    return F.broadcast(side) if small else side


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input over all cores ahead of a Python stage.

    A file with one row group is one task however many cores there are. Inputs with
    several files or one full split per core are left as they are: shuffling them would cost more
    than it gains.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = input_bytes(df)
    small = size is not None and size < min(cores * SPLIT_BYTES, SPREAD_BYTES)
    return df.repartition(cores) if small and len(df.inputFiles()) < 4 * cores else df
