"""Shards of nearly equal bytes by histogram sort.

Rows have a 63-bit key: half from the text, half from the id, so copies of a text stand together
and may still be parted anywhere. Splitters between key ranges are found by counting the exact
bytes below candidate keys in all partitions at once and probing again inside the intervals that
hold a target; then rows are exchanged once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillsieve.functions.text import evaluated_once
from quillsieve.llm.common import ArrowBatches, table
from quillsieve.session import materialise

SHARDS = 40
ROW_BYTES = 16
#: A splitter is good once the bytes before it are this share of a shard's from its target.
TOLERANCE = 0.001
#: New candidates inside each open interval in a round.
PROBES = 16
#: Bytes that one task of the exchange orders, and the most key ranges the driver keeps track of.
CELL_BYTES = 64 * 1024 * 1024
MAX_CELLS = 16_384
_LAST = 1 << 63


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def row_key(row_id: Column, text: Column) -> Column:
    high = F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)), 31)
    return high.bitwiseOR(F.xxhash64(row_id).bitwiseAND(F.lit(0x7FFFFFFF)))


def _counted(keys: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows below each probe, exact; a task sends one row per range it has rows in."""
    edges = np.array(probes, np.uint64)

    def run(batches: ArrowBatches) -> ArrowBatches:
        sizes, rows = np.zeros(len(edges) + 1, np.int64), np.zeros(len(edges) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(edges, batch.column(0).to_numpy().astype(np.uint64), side="right")
            np.add.at(sizes, at, batch.column(1).to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sizes[used]), pa.array(rows[used])], names=["at", "b", "n"])

    counts = keys.mapInArrow(run, "at bigint, b bigint, n bigint").groupBy("at").agg(F.sum("b"), F.sum("n")).collect()
    out = np.zeros((2, len(edges) + 1), np.int64)
    for at, size, n in counts:
        out[:, at] = size, n
    below = out.cumsum(axis=1)[:, :-1]
    return below[0], below[1]


def splitters(keys: DataFrame, parts: int, total: int, rows: int, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """The ``parts - 1`` keys that cut (key, size) rows into ranges of nearly equal bytes.

    Every splitter that bounds a shard is refined until it meets the tolerance or no row lies
    between it and the next candidate, so it is as near as whole rows allow; the others, which only
    part a shard's work, may be off by a tenth of their range. Each round is one pass over the keys.
    """
    targets = [total * j // parts for j in range(1, parts)]
    slack = [tolerance * total / shards if j % (parts // shards) == 0 else 0.1 * total / parts for j in range(1, parts)]
    lows = [(0, 0, 0)] * len(targets)  # key, bytes below, rows below
    highs = [(_LAST, total, rows)] * len(targets)
    opened = set(range(len(targets)))
    first = True
    while opened:
        spaces = {(lows[j][0], highs[j][0]) for j in opened}
        count = PROBES * (len(targets) + 1) if first else PROBES
        probes = sorted({low + (high - low) * i // (count + 1) for low, high in spaces for i in range(1, count + 1)} - {0})
        first = False
        if not probes:
            break
        sizes, ns = _counted(keys, probes)
        for j in list(opened):
            at = int(np.searchsorted(sizes, targets[j], side="right"))  # the first probe with more below it
            if at and probes[at - 1] > lows[j][0]:
                lows[j] = (probes[at - 1], int(sizes[at - 1]), int(ns[at - 1]))
            if at < len(probes) and probes[at] < highs[j][0]:
                highs[j] = (probes[at], int(sizes[at]), int(ns[at]))
            off = min(targets[j] - lows[j][1], highs[j][1] - targets[j])
            if off <= slack[j] or highs[j][2] - lows[j][2] <= 1 or highs[j][0] - lows[j][0] <= 1:
                opened.discard(j)
    nearest = [low if t - low[1] <= high[1] - t else high for t, low, high in zip(targets, lows, highs)]
    return [x[0] for x in nearest]


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in its shard).

    A row weighs the UTF-8 bytes of its text, none for null, plus 16. Shards are ranges of the
    row key; copies of a text are neighbours unless a splitter falls between them. Rows that
    repeat both id and text have one key, so they share a shard, in which their order is left
    open. An empty table gives no rows; existing columns of the two names are replaced.

    The driver holds a bounded number of candidate keys and counts. Keys and sizes are stored
    once; texts move in one exchange.
    """
    spark = docs.sparkSession
    key, size = row_key(F.col(id_col), F.col(text_col)), row_size(F.col(text_col))
    keys = materialise(docs.select(key.alias("k"), size.alias("b")), "keys")
    total, rows = keys.agg(F.coalesce(F.sum("b"), F.lit(0)), F.count("*")).first()
    wanted = max(math.ceil(total / CELL_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = shards * max(1, min(math.ceil(wanted / shards), MAX_CELLS // shards))
    cuts = splitters(keys, parts, total, rows, shards, tolerance) if rows else [0] * (parts - 1)
    cuts = np.maximum.accumulate(np.array(cuts, np.uint64))
    per_shard = parts // shards
    below = _counted(keys, [int(x) for x in cuts])[1].tolist() if rows else [0] * len(cuts)
    starts = [0, *below]
    bases = [(c, c // per_shard, starts[c] - starts[c - c % per_shard]) for c in range(parts)]

    @F.arrow_udf("int")
    def cell_of(k: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, k.to_numpy(zero_copy_only=False).astype(np.uint64), side="right").astype(np.int32))

    plain = docs.drop("shard", "slot")
    placed = plain.withColumn("__k", key).withColumn("__cell", evaluated_once(cell_of)(F.col("__k")))
    order = Window.partitionBy("__cell").orderBy("__k", F.col(id_col))
    numbered = placed.repartition(parts, "__cell").withColumn("__n", F.row_number().over(order))
    # A row per key range, at most MAX_CELLS.
    base = F.broadcast(spark.createDataFrame(bases, "__c int, shard int, __base bigint"))
    joined = numbered.join(base, F.col("__cell") == F.col("__c"))
    return joined.select(*plain.columns, "shard", (F.col("__base") + F.col("__n") - 1).alias("slot"))


def op9_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id",
        row_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op9_histogram_sharding": op9_histogram_sharding}
ORACLES: dict[str, str] = {}
