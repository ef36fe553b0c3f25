"""Row positions: the index everything positional is built on.

A parquet scan knows the position of each row in its file, so a position over all files only
needs the row counts of the files before it. Any other frame is sorted by range once, written
out with (task, position in task), and numbered from the row counts of the tasks before it.
Neither way orders the whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.session import materialise
from quillsieve.sizing import partitions_for, small_side

_LOW_BITS = (1 << 33) - 1


def file_row_counts(scan: DataFrame) -> DataFrame:
    """Rows per parquet file of a scan: ``file_path, num_rows``. Reads no column."""
    return scan.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("num_rows"))


def read_parquet_indexed(spark: SparkSession, *paths: str, glob: str = "*.parquet", name: str = "row_index") -> DataFrame:
    """Parquet rows numbered from 0 by file path, then by position in the file."""
    scan = spark.read.option("pathGlobFilter", glob).parquet(*paths)
    position = F.col("_metadata.row_index")
    if len(scan.inputFiles()) == 1:
        return scan.select("*", position.alias(name))
    # One row per file, so one task can sum them up.
    by_path = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = file_row_counts(scan).select(
        F.col("file_path").alias("_file"), F.coalesce(F.sum("num_rows").over(by_path), F.lit(0)).alias("_start")
    )
    rows = scan.select("*", F.col("_metadata.file_path").alias("_file"), position.alias("_pos"))
    # The driver lists these files by name anyway, so a number for each is small.
    return rows.join(F.broadcast(starts), "_file").withColumn(name, F.col("_start") + F.col("_pos")).drop("_file", "_start", "_pos")


def _sorted_and_placed(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted by range and written once, with its task ``_part`` and position ``_seq`` there.

    The sort samples its input first, so pass a stored table where that is costly to compute.
    """
    placed = (
        df.repartitionByRange(*partitions_for(df), *order_by)
        .sortWithinPartitions(*order_by)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)).alias("_seq"),
        )
    )
    return materialise(placed, "placed")


def _part_starts(placed: DataFrame, weight: Column) -> DataFrame:
    """Total weight ahead of each task; one row per task of the sort."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum(weight).alias("_w"))
    return totals.select("_part", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_start"))


def with_ordered_index(
    df: DataFrame,
    order_by: Sequence[Column | str],
    by: Sequence[str] = (),
    name: str = "row_index",
) -> DataFrame:
    """Number the rows from 0 in the given order, within each group of ``by`` if given.

    End ``order_by`` with a unique column: rows with equal keys cannot be parted by range, so
    a hot key without a tiebreak would stay in one task. A group may be of any size.
    """
    placed = _sorted_and_placed(df, [*by, *order_by])
    rows = placed.join(F.broadcast(_part_starts(placed, F.lit(1))), "_part").withColumn(name, F.col("_start") + F.col("_seq"))
    rows = rows.drop("_part", "_seq", "_start")
    if not by:
        return rows
    # Group keys may be null; keep those rows by a null-safe match.
    firsts = rows.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]).agg(F.min(name).alias("_first"))
    match = F.lit(True)
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = rows.join(small_side(firsts), match)
    return joined.withColumn(name, F.col(name) - F.col("_first")).drop("_first", *[f"_g{i}" for i in range(len(by))])


def running_total(df: DataFrame, order_by: Sequence[Column | str], weight: str, name: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to and including each row, in the given order."""
    placed = _sorted_and_placed(df, order_by)
    upto = Window.partitionBy("_part").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.withColumn("_within", F.sum(weight).over(upto))
    rows = rows.join(F.broadcast(_part_starts(placed, F.col(weight))), "_part")
    return rows.withColumn(name, F.col("_start") + F.col("_within")).drop("_part", "_seq", "_start", "_within")


def take_rows(df: DataFrame, n: int, order_by: Sequence[str], descending: bool = False) -> DataFrame:
    """The first ``n`` rows in the order of the named columns; none for ``n <= 0``.

    Only the order columns are sorted, by range; the rows are then picked from the scan by
    comparing their keys with the last one taken, so texts are neither sorted nor moved. The
    columns must part the last row taken from the next one, else it would be open which of the
    rows that tie is meant: that is an error.
    """
    if n <= 0:
        return df.limit(0)
    order = [F.desc(c) if descending else F.asc(c) for c in order_by]
    keys = with_ordered_index(df.select(*order_by), order, name="_take")
    border = {r["_take"]: tuple(r)[:-1] for r in keys.where(F.col("_take").isin(n - 1, n)).select(*order_by, "_take").collect()}
    if n not in border:
        return df
    if border[n - 1] == border[n]:
        raise ValueError(f"rows {n - 1} and {n} have the same {', '.join(order_by)}; order by columns that part them")
    own = F.struct(*[F.col(c) for c in order_by])
    last = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, border[n - 1])])
    # Structs order nulls first, as ascending columns do, and last when descending.
    return df.filter(own >= last if descending else own <= last)


def row_range(df: DataFrame, start: int, end: int, index: str = "row_index") -> DataFrame:
    """Rows at positions ``start`` to ``end - 1``."""
    return df.filter((F.col(index) >= start) & (F.col(index) < end))


def average_ranks(histogram: DataFrame, value: str, count: str, name: str, by: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """Rank of each distinct value from 1, ties sharing the average rank of their rows.

    ``histogram`` has one row per distinct (by, value) with its number of rows. Set ``bounded``
    only where every group is known to be small, as in mini-batches: each is then one window.
    Otherwise the values are sorted by range.
    """
    average = lambda upto: upto - (F.col(count) - 1) / 2
    if bounded:
        upto = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
        return histogram.withColumn(name, average(F.sum(count).over(upto)))
    totals = running_total(histogram, [*by, value], count, "_upto")
    if by:
        starts = totals.groupBy(*by).agg(F.min(F.col("_upto") - F.col(count)).alias("_first"))
        totals = totals.join(small_side(starts), list(by)).withColumn("_upto", F.col("_upto") - F.col("_first")).drop("_first")
    return totals.withColumn(name, average(F.col("_upto"))).drop("_upto")
