"""Connected components of links between 64-bit ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.session import materialise

#: More rounds than any graph needs: their number grows with the logarithm of the longest path.
MAX_ROUNDS = 60


def _links(df: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller id."""
    return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) to rows (id, root): each linked id with the smallest id it can reach.

    Ids without a link to another id have no row. Every round attaches the neighbours of an id to
    the smallest of them; only minima are shuffled unsummed, so an id with any number of links is
    shared among tasks. A round's links are a table in the shared folder, and the driver sees
    only their number and a checksum. An empty table gives an empty result.
    """
    links = materialise(_links(links), "links")
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        both = links.union(links.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialise(_links(small.union(least)), "links")
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
