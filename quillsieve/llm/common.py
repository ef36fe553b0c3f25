"""Helpers the operators of this folder share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillsieve.sizing import input_bytes

#: Fixed patterns: white space that parts words, and the characters of a plain lower-case word.
WORD = r"[^\x20\x09-\x0D]+"

#: Python code may leave this folder's functions alone only if their modules are installed
#: on the executors, as for any package with functions that run there.
ArrowBatches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: what ASCII white space parts. None has no words.

    ``bytes.split()`` parts at exactly the characters x20 and x09 to x0D, so no pattern is needed.
    """
    return [] if text is None else encoded(text).split()


def encoded(text: str) -> bytes:
    """UTF-8 of a text; a lone surrogate, which Spark never makes, becomes a question mark."""
    return text.encode("utf-8", "replace")


def per_batch(df: DataFrame, schema: str, make: Callable[..., list], *columns: str) -> DataFrame:
    """One Arrow batch in, one out: ``make`` gets the named columns as Arrow arrays.

    It returns the arrays of ``schema`` in its order, of any length. Only ``columns`` are sent to
    Python.
    """

    def run(batches: ArrowBatches) -> ArrowBatches:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(make(*batch.columns), names=names)

    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).fieldNames()
    return df.select(*columns).mapInArrow(run, schema)


def tasks_for(df: DataFrame, task_bytes: int, at_least: int = 1) -> int:
    """Partitions so that each gets about ``task_bytes`` of the stored input, or the session's number."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, at_least, math.ceil((input_bytes(df) or 0) / task_bytes))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits (a public finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
