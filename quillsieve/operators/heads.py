"""Regression heads: two dense layers with a rectifier between them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.schemas import HEAD_WEIGHTS

#: Numbers a head may have: its weights are held by the driver and by every task.
MAX_PARAMETERS = 64_000_000


@dataclass(frozen=True)
class Head:
    """Weights of one head: ``w1`` is hidden × input, ``w2`` has one weight per hidden unit."""

    name: str
    encoder_id: str
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def __post_init__(self):
        hidden, _ = self.w1.shape
        if self.b1.shape != (hidden,) or self.w2.shape != (hidden,):
            raise ValueError(f"head {self.name}: layer shapes do not match")
        if self.w1.size > MAX_PARAMETERS:
            raise ValueError(f"head {self.name}: {self.w1.size} weights are too many to send to every task")

    @property
    def input_dim(self) -> int:
        return self.w1.shape[1]

    @property
    def hidden_dim(self) -> int:
        return self.w1.shape[0]

    def predict(self, vectors: np.ndarray) -> np.ndarray:
        return np.maximum(vectors @ self.w1.T + self.b1, 0.0) @ self.w2 + self.b2


def score_expression(vector: Column, head: Head) -> Column:
    """A small head as a plain column, for plans that should not leave the JVM."""
    hidden = []
    for weights, bias in zip(head.w1, head.b1):
        products = F.zip_with(vector, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
        hidden.append(F.greatest(F.lit(0.0), F.aggregate(products, F.lit(float(bias)), lambda s, x: s + x)))
    return sum((h * F.lit(float(w)) for h, w in zip(hidden, head.w2)), F.lit(float(head.b2)))


def weights_table(spark: SparkSession, *heads: Head) -> DataFrame:
    """Heads as rows: one per hidden unit (layer 1) and one per head (layer 2)."""
    rows = []
    for head in heads:
        shape = (head.name, head.encoder_id, head.input_dim, head.hidden_dim)
        rows += [(*shape, 1, i, [float(x) for x in w], float(b)) for i, (w, b) in enumerate(zip(head.w1, head.b1))]
        rows.append((*shape, 2, 0, [float(x) for x in head.w2], float(head.b2)))
    return spark.createDataFrame(rows, HEAD_WEIGHTS)


def save_heads(spark: SparkSession, path: str, *heads: Head) -> None:
    """Write heads, one folder per name; saving a name again replaces it."""
    (
        weights_table(spark, *heads)
        .repartition("head")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("head")
        .parquet(path)
    )


def heads_from_table(table: DataFrame) -> dict[str, Head]:
    """Heads of a weights table by name. Fails where a head is incomplete."""
    numbers = table.agg(F.sum(F.size("weights"))).first()[0] or 0
    if numbers > MAX_PARAMETERS:
        raise ValueError(f"{numbers} weights are too many for the driver; load fewer heads at a time")
    by_name: dict[str, list] = {}
    for row in table.orderBy("head", "layer", "row").collect():
        by_name.setdefault(row["head"], []).append(row)
    heads = {}
    for name, rows in by_name.items():
        hidden = rows[:-1]
        if len(hidden) != rows[0]["hidden_dim"] or rows[-1]["layer"] != 2:
            raise ValueError(f"head {name}: weights are incomplete")
        heads[name] = Head(
            name,
            rows[0]["encoder_id"],
            np.array([r["weights"] for r in hidden]),
            np.array([r["bias"] for r in hidden]),
            np.array(rows[-1]["weights"]),
            float(rows[-1]["bias"]),
        )
    return heads


def load_heads(spark: SparkSession, path: str, *names: str) -> dict[str, Head]:
    """Saved heads, all of them or those named."""
    table = spark.read.schema(HEAD_WEIGHTS).parquet(path)
    if names:
        table = table.filter(F.col("head").isin(*names))
    heads = heads_from_table(table)
    missing = set(names) - set(heads)
    if missing:
        raise ValueError(f"no saved head named {sorted(missing)}")
    return heads
