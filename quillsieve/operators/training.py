"""Distilling a model's labels into a regression head.

The encoder is frozen, so texts are embedded once. Vectors are written once, grouped into
mini-batches; a step reads only the files of its batch, sums gradients on the executors, and
the driver, which holds nothing but the weights, takes an Adam step. Steps on small batches
follow each other in one task for a bounded number of rows, which hands on weights and optimiser;
their vectors are stored by such runs of steps, anew for the order of each epoch.
"""

from __future__ import annotations

import copy
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quillsieve.functions.answers import score_integer
from quillsieve.functions.display import clamp
from quillsieve.operators.heads import Head
from quillsieve.operators.layout import INDEX, positional_split
from quillsieve.operators.position import with_ordered_index
from quillsieve.session import drop_folder, materialise, new_folder
from quillsieve.sizing import partitions_for, small_side

#: Rows of a mini-batch one task takes, and bytes of gradients the driver may hold at once.
ROWS_PER_TASK = 4096
#: Bytes of vectors that a task holds for the small batches it steps through.
RUN_BYTES = 32 * 1024 * 1024
GRADIENT_BYTES = 512 * 1024 * 1024


def label_pairs(lines: DataFrame, model: str) -> DataFrame:
    """Text and integer score of every line of a model's runs; a score that is none is null."""
    own = lines.filter(F.col("model") == model)
    return own.select("run_id", "line_no", "input_text", score_integer(F.col("score_raw"), F.col("score_json_type")).alias("score"))


def rejected_labels(pairs: DataFrame) -> DataFrame:
    """How many lines hold no integer score. One row."""
    return pairs.agg(F.count_if(F.col("score").isNull()).alias("rejected"))


def trainable(pairs: DataFrame) -> DataFrame:
    """Scores clipped to 0..5, and label 5 left out, which after the clip means 5 and above."""
    return pairs.withColumn("score", clamp(F.col("score"), 0, 5)).filter(F.col("score") != 5)


def collect_labels(lines: DataFrame, model: str, train_share: float = 0.9) -> DataFrame:
    """Labels of a model with their ``split``, the first rows by run and line for training.

    The parsed labels are written once, as the sort samples its input before it reads it.
    """
    pairs = materialise(label_pairs(lines, model).filter(F.col("score").isNotNull()), "labels")
    total = pairs.count()
    if total == 0:
        raise ValueError(f"the runs hold no labels by {model}")
    indexed = with_ordered_index(pairs, ["run_id", "line_no"])
    return indexed.withColumn("split", positional_split(F.col(INDEX), total, train_share))


@dataclass
class Adam:
    """Optimiser state over a list of arrays. The usual decay rates and epsilon."""

    rate: float
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8

    def __post_init__(self):
        self._steps, self._mean, self._square = 0, None, None

    def step(self, weights: list[np.ndarray], gradients: list[np.ndarray]) -> list[np.ndarray]:
        if self._mean is None:
            self._mean = [np.zeros_like(w) for w in weights]
            self._square = [np.zeros_like(w) for w in weights]
        self._steps += 1
        out = []
        for i, (w, g) in enumerate(zip(weights, gradients)):
            self._mean[i] = self.beta1 * self._mean[i] + (1 - self.beta1) * g
            self._square[i] = self.beta2 * self._square[i] + (1 - self.beta2) * g * g
            mean = self._mean[i] / (1 - self.beta1**self._steps)
            square = self._square[i] / (1 - self.beta2**self._steps)
            out.append(w - self.rate * mean / (np.sqrt(square) + self.epsilon))
        return out


def initial_weights(input_dim: int, hidden_dim: int, seed: int) -> list[np.ndarray]:
    """Uniform in ±1/√fan-in: hidden matrix and bias, output weights and bias."""
    rng = np.random.default_rng(seed)
    first, second = 1 / math.sqrt(input_dim), 1 / math.sqrt(hidden_dim)
    return [
        rng.uniform(-first, first, (hidden_dim, input_dim)),
        rng.uniform(-first, first, hidden_dim),
        rng.uniform(-second, second, hidden_dim),
        rng.uniform(-second, second, 1),
    ]


def gradient_sums(weights: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Sum of squared errors over rows and its gradient in every weight."""
    w1, b1, w2, b2 = weights
    before = x @ w1.T + b1
    hidden = np.maximum(before, 0.0)
    error = hidden @ w2 + b2[0] - y
    upstream = 2 * error
    back = np.outer(upstream, w2) * (before > 0)
    return float(error @ error), [back.T @ x, back.sum(axis=0), hidden.T @ upstream, np.array([upstream.sum()])]


def _unflatten(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, start = [], 0
    for w in like:
        out.append(flat[start : start + w.size].reshape(w.shape))
        start += w.size
    return out


def _dealt(examples: DataFrame, steps: int, slots: int, seed: int, vector: str, label: str, index: str) -> DataFrame:
    """Examples dealt at random, but repeatably, into batches, and each batch into task slots."""
    narrow = examples.schema[vector].dataType.simpleString() == "array<float>"
    return examples.select(
        F.col(vector).alias("x") if narrow else F.col(vector).cast("array<double>").alias("x"),
        F.col(label).cast("double").alias("y"),
        F.col(index).alias("i"),
        F.pmod(F.xxhash64(F.col(index), F.lit(seed)), F.lit(steps)).cast("int").alias("batch"),
        F.pmod(F.xxhash64(F.col(index), F.lit(seed + 1)), F.lit(slots)).cast("int").alias("slot"),
    ).filter("x IS NOT NULL AND y IS NOT NULL")


def mini_batches(examples: DataFrame, steps: int, slots: int, seed: int, vector: str, label: str, index: str) -> DataFrame:
    """Examples dealt into batches and slots, and stored by batch."""
    dealt = _dealt(examples, steps, slots, seed, vector, label, index)
    return materialise(dealt.repartition(*partitions_for(dealt), "batch", "slot"), "batches", partition_by=("batch",))


def _stored_by_run(dealt: DataFrame, order: np.ndarray, run: int, folder: str) -> DataFrame:
    """Dealt rows in one folder for each ``run`` batches that follow each other in ``order``."""
    if run >= len(order):
        placed = dealt.withColumn("run", F.lit(0))
    else:
        runs = pa.table({"batch": pa.array(order, pa.int32()), "run": pa.array(np.arange(len(order)) // run, pa.int32())})
        placed = dealt.join(small_side(dealt.sparkSession.createDataFrame(runs)), "batch")
    return materialise(placed.repartition(*partitions_for(placed), "run"), partition_by=("run",), path=folder)


_PARTIAL = "slot int, num_rows long, loss double, flat binary"


def _partial_gradients(batch: DataFrame, sent: Broadcast) -> list[Row]:
    """Gradient sums of one mini-batch, a row per slot. Slots hold a bounded number of rows."""

    def partial(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        loss, gradients = gradient_sums(sent.value, np.stack(rows["x"].to_numpy()), rows["y"].to_numpy())
        flat = np.concatenate([g.ravel() for g in gradients]).tobytes()
        return pd.DataFrame({"slot": [rows["slot"].iloc[0]], "num_rows": [len(rows)], "loss": [loss], "flat": [flat]})

    return batch.groupBy("slot").applyInPandas(partial, _PARTIAL).collect()


_RUN = "step int, num_rows long, loss double, state binary"
_HISTORY = pa.schema([("epoch", pa.int32()), ("step", pa.int32()), ("num_rows", pa.int64()), ("loss", pa.float64())])


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as rows of numbers."""
    if len(lengths := pc.unique(pc.list_value_length(vectors))) != 1:
        raise ValueError(f"vectors of different lengths: {lengths.to_pylist()}")
    return pc.list_flatten(vectors).to_numpy().reshape(len(vectors), -1).astype("float64")


def _run_of_steps(batches: DataFrame, numbers: np.ndarray, weights: list[np.ndarray], adam: Adam) -> tuple[pa.Table | None, list[np.ndarray], Adam]:
    """Adam steps on some small batches, which are all of the rows given, one after the other in one task.

    Returns each step's batch, rows and loss, and the weights and optimiser after the last. A
    step needs the weights of the step before it, so more tasks could not share them.
    """
    sent = batches.sparkSession.sparkContext.broadcast((weights, adam))

    def steps(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [part for part in parts if part.num_rows]
        if not found:
            return
        rows = pa.Table.from_batches(found)
        x, y, index = _matrix(rows["x"]), rows["y"].to_numpy(), rows["i"].to_pandas()
        by_batch = index.groupby(rows["batch"].to_numpy()).indices
        # Copied, as a task that is run again starts from the same state.
        now, own, out = *copy.deepcopy(sent.value), []
        for number in numbers:
            if number not in by_batch:
                continue
            taken = index.iloc[by_batch[number]].sort_values().index.to_numpy()
            loss, gradients = gradient_sums(now, x[taken], y[taken])
            now = own.step(now, [g / len(taken) for g in gradients])
            out.append((number, len(taken), loss / len(taken), None))
        out[-1] = (*out[-1][:-1], pickle.dumps((now, own)))
        types = (pa.int32(), pa.int64(), pa.float64(), pa.binary())
        # A loss that is no number is null in the history.
        columns = [pa.array(v, t, from_pandas=True) for v, t in zip(zip(*out), types)]
        yield pa.RecordBatch.from_arrays(columns, ["step", "num_rows", "loss", "state"])

    taken = batches.select("batch", "i", "x", "y").coalesce(1).mapInArrow(steps, _RUN).toArrow()
    sent.unpersist()
    if not taken.num_rows:
        return None, weights, adam
    return taken.drop_columns("state"), *pickle.loads(taken["state"][-1].as_py())


def _small_steps(dealt: DataFrame, steps: int, run: int, epochs: int, seed: int, weights: list[np.ndarray], adam: Adam) -> tuple[list[pa.Table], list[np.ndarray]]:
    """All epochs of steps on batches so small that one task takes ``run`` of them.

    Every epoch takes the batches in an order of its own, so it stores the rows by its own runs,
    from those of the epoch before, which are then deleted. One run holds any order.
    """
    spark = dealt.sparkSession
    order, history, folder = np.random.default_rng(seed), [_HISTORY.empty_table()], None
    for epoch in range(epochs):
        numbers = order.permutation(steps)
        if folder is None or run < steps:
            before, folder = folder, new_folder(spark, "batches")
            stored = _stored_by_run(dealt, numbers, run, folder)
            if before:
                drop_folder(spark, before)
            dealt = stored.drop("run")
        for k, start in enumerate(range(0, steps, run)):
            taken, weights, adam = _run_of_steps(stored.filter(F.col("run") == k), numbers[start : start + run], weights, adam)
            if taken is not None:
                history.append(taken.add_column(0, "epoch", pa.array(np.full(len(taken), epoch, "int32"))).cast(_HISTORY))
    return history, weights


def train_head(
    examples: DataFrame,
    name: str,
    encoder_id: str,
    hidden_dim: int = 1024,
    rate: float = 1e-3,
    batch_size: int = 256,
    epochs: int = 1,
    seed: int = 0,
    vector: str = "embedding",
    label: str = "score",
    index: str = INDEX,
    max_rows: int | None = None,
) -> tuple[Head, DataFrame]:
    """Train a head on rows with a vector, a label and a unique ``index``.

    All rows are fitted. Only where ``max_rows`` is given and there are more, a repeatable sample of
    about that many is taken, by a hash of ``index``.

    Returns the head and the loss before each step (``epoch, step, num_rows, loss``). Each epoch
    visits all batches in a new order. The same rows and seed give the same weights: a batch is
    summed in order of ``index`` within a slot, and slots are added in order.
    """
    spark = examples.sparkSession
    total, input_dim = examples.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    if not total:
        raise ValueError("no examples to train on")
    if max_rows is not None and total > max_rows:
        share = F.lit(int((1 << 40) * (max_rows / total)))
        examples = examples.filter(F.pmod(F.xxhash64(F.col(index), F.lit(seed + 2)), F.lit(1 << 40)) < share)
        total = max_rows
    steps = max(1, math.ceil(total / batch_size))
    weights = initial_weights(input_dim, hidden_dim, seed)
    gradient_bytes = 8 * sum(w.size for w in weights)
    slots = max(1, min(math.ceil(batch_size / ROWS_PER_TASK), GRADIENT_BYTES // gradient_bytes))
    adam = Adam(rate)
    if slots == 1:
        dealt = _dealt(examples, steps, slots, seed, vector, label, index)
        run = max(1, RUN_BYTES // (8 * max(1, input_dim) * batch_size))
        history, weights = _small_steps(dealt, steps, run, epochs, seed, weights, adam)
    else:
        batches = mini_batches(examples, steps, slots, seed, vector, label, index)
        order = np.random.default_rng(seed)
        taken = []
        for epoch in range(epochs):
            for step in order.permutation(steps):
                sent = spark.sparkContext.broadcast(weights)
                parts = _partial_gradients(batches.filter(F.col("batch") == int(step)), sent)
                sent.unpersist()
                if not parts:
                    continue
                parts.sort(key=lambda r: r["slot"])
                count = sum(r["num_rows"] for r in parts)
                flat = sum(np.frombuffer(r["flat"]) for r in parts) / count
                taken.append((epoch, int(step), count, sum(r["loss"] for r in parts) / count))
                weights = adam.step(weights, _unflatten(flat, weights))
        history = [pa.Table.from_pylist([dict(zip(_HISTORY.names, row)) for row in taken], _HISTORY)]
    head = Head(name, encoder_id, weights[0], weights[1], weights[2], float(weights[3][0]))
    return head, spark.createDataFrame(pa.concat_tables(history).combine_chunks())
