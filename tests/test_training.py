import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.operators import training
from quillsieve.operators.heads import Head, load_heads, save_heads, score_expression
from quillsieve.operators.annotate import annotate_vectors
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.plans.catalog.evaluation import EPOCHS, train_progress
from quillsieve.plans.catalog.layout import indexed


@pytest.fixture(scope="module")
def examples(spark, sf_dir):
    rows = indexed(spark, sf_dir, "embeddings").withColumn("score", F.col("label"))
    return training.trainable(rows).select("embedding", "score", "row_index").cache()


def by_hand(spark, examples, steps, slots, hidden, rate, epochs, seed):
    """The same training in one process, over the same batches."""
    batches = training.mini_batches(examples, steps, slots, seed, "embedding", "score", "row_index").collect()
    weights = training.initial_weights(64, hidden, seed)
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    order, t = np.random.default_rng(seed), 0
    for _ in range(epochs):
        for step in order.permutation(steps):
            rows = sorted((r for r in batches if r.batch == step), key=lambda r: r.i)
            x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
            w1, b1, w2, b2 = weights
            hidden_out = np.maximum(x @ w1.T + b1, 0)
            up = 2 * (hidden_out @ w2 + b2 - y) / len(rows)
            down = np.outer(up, w2) * (hidden_out > 0)
            gradients = [down.T @ x, down.sum(0), hidden_out.T @ up, np.array([up.sum()])]
            t += 1
            for k, g in enumerate(gradients):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                weights[k] = weights[k] - rate * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.999**t)) + 1e-8)
    return weights


@pytest.mark.parametrize("rows_per_task", [4096, 40])
def test_training_equals_one_process_and_repeats(spark, examples, monkeypatch, rows_per_task):
    monkeypatch.setattr(training, "ROWS_PER_TASK", rows_per_task)
    total, batch = examples.count(), 100
    train = lambda: training.train_head(examples, "h", "hashing-64", hidden_dim=8, rate=0.05, batch_size=batch, epochs=2, seed=7)
    head, history = train()
    wanted = by_hand(spark, examples, -(-total // batch), -(-batch // rows_per_task), 8, 0.05, 2, 7)
    for got, want in zip((head.w1, head.b1, head.w2, np.array([head.b2])), wanted):
        np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-11)
    again, _ = train()
    assert np.array_equal(head.w1, again.w1) and head.b2 == again.b2
    assert history.groupBy("epoch").agg(F.sum("num_rows").alias("n")).select("n").distinct().first().n == total


def test_no_examples(spark, examples):
    with pytest.raises(ValueError):
        training.train_head(examples.limit(0), "h", "hashing-64")


def test_labels(spark):
    rows = [("r", i, "m", "text", raw, kind) for i, (raw, kind) in enumerate([("7", "number"), ("-1", "number"), ("3.9", "number"), ("4", "string"), ("3.5", "string"), ("5", "number")])]
    lines = spark.createDataFrame(rows, "run_id string, line_no long, model string, input_text string, score_raw string, score_json_type string")
    labels = training.collect_labels(lines, "m")
    assert sorted((r.line_no, r.score, r.split) for r in labels.collect()) == [(0, 7, "train"), (1, -1, "train"), (2, 3, "train"), (3, 4, "train"), (5, 5, "test")]
    assert sorted(r.score for r in training.trainable(labels).collect()) == [0, 3, 4]
    assert training.rejected_labels(training.label_pairs(lines, "m")).first().rejected == 1
    with pytest.raises(ValueError):
        training.collect_labels(lines, "other")


def test_heads_survive_saving_and_agree_with_their_expression(spark, sf_dir, tmp_path):
    heads = fx.heads()
    save_heads(spark, str(tmp_path), *heads.values())
    save_heads(spark, str(tmp_path), heads["a"])  # replaces only its own folder
    loaded = load_heads(spark, str(tmp_path))
    assert set(loaded) == set(heads)
    for name, head in heads.items():
        assert np.array_equal(loaded[name].w1, head.w1) and loaded[name].b2 == head.b2
    vectors = fx.table(spark, sf_dir, "embeddings")
    both = annotate_vectors(vectors, {"a": loaded["a"]}).withColumn("plain", score_expression(F.col("embedding").cast("array<double>"), heads["a"]))
    assert both.filter("abs(score_a - plain) > 1e-9").count() == 0
    with pytest.raises(ValueError):
        load_heads(spark, str(tmp_path), "missing")


def test_head_shapes_are_checked():
    with pytest.raises(ValueError):
        Head("x", "e", np.zeros((2, 3)), np.zeros(3), np.zeros(2), 0.0)


def test_more_rows_than_the_bound_are_sampled(spark):
    from quillsieve.operators.training import train_head

    rows = spark.range(3000).select(F.array(F.lit(1.0), F.col("id") / 3000).alias("embedding"), F.lit(1.0).alias("score"), F.col("id").alias("row_index"))
    _, history = train_head(rows, "h", "e", hidden_dim=2, batch_size=100, max_rows=500)
    assert 400 < history.agg(F.sum("num_rows")).first()[0] < 600 and history.count() <= 5


def test_small_batches_share_jobs_and_give_the_same_weights(spark, examples, monkeypatch):
    def train(group):
        spark.sparkContext.setJobGroup(group, "training")
        try:
            head, history = training.train_head(examples, "h", "hashing-64", hidden_dim=4, rate=0.05, batch_size=10, epochs=2, seed=3)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return head, sorted(map(tuple, history.collect())), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    together, seen, jobs = train("together")
    monkeypatch.setattr(training, "RUN_BYTES", 3 * 8 * 64 * 10)
    by_threes, seen_again, _ = train("by threes")
    assert np.array_equal(together.w1, by_threes.w1) and np.array_equal(together.w2, by_threes.w2) and together.b2 == by_threes.b2
    assert seen == seen_again and len(seen) > 40
    assert jobs < len(seen) / 2


def test_all_rows_are_fitted_unless_a_number_is_given(spark):
    total = 1_000_400
    rows = spark.range(total).select(F.array(F.col("id") / total).alias("embedding"), F.lit(1.0).alias("score"), F.col("id").alias("row_index"))
    _, history = training.train_head(rows, "h", "e", hidden_dim=2, batch_size=4096)
    assert history.agg(F.sum("num_rows")).first()[0] == total


def test_train_progress_takes_every_row(spark, tmp_path):
    total = 1_000_400
    rows = spark.range(total).select(F.col("id").alias("vec_id"), F.array((F.col("id") / total).cast("float")).alias("embedding"), F.lit(1).alias("label"))
    rows.write.parquet(str(tmp_path / "embeddings.parquet"))
    found = train_progress(spark, str(tmp_path)).select("epoch", "rows_seen").collect()
    assert sorted(map(tuple, found)) == [(epoch, total) for epoch in range(EPOCHS)]


def test_small_batches_are_stored_by_run_for_one_epoch(spark, examples, monkeypatch):
    monkeypatch.setattr(training, "RUN_BYTES", 3 * 8 * 64 * 10)
    stored_by_run, stored = training._stored_by_run, []

    def watched(dealt, order, run, folder):
        table = stored_by_run(dealt, order, run, folder)
        stored.append((folder, len(order), {os.path.dirname(file) for file in table.inputFiles()}))
        return table

    monkeypatch.setattr(training, "_stored_by_run", watched)
    head, history = training.train_head(examples, "h", "hashing-64", hidden_dim=4, rate=0.05, batch_size=10, epochs=3, seed=3)
    assert [os.path.exists(folder) for folder, _, _ in stored] == [False, False, True]
    assert all(len(folders) == -(-steps // 3) for _, steps, folders in stored)
    wanted = by_hand(spark, examples, stored[0][1], 1, 4, 0.05, 3, 3)
    np.testing.assert_allclose(head.w1, wanted[0], rtol=1e-9, atol=1e-11)
    assert history.count() == 3 * stored[0][1]


def test_vectors_of_different_lengths_are_an_error(spark):
    rows = spark.createDataFrame([([1.0, 2.0], 1.0, 0), ([1.0, 2.0, 3.0, 4.0], 1.0, 1), ([1.0, 2.0], 1.0, 2)], "embedding array<double>, score double, row_index long")
    with pytest.raises(Exception, match="different lengths"):
        training.train_head(rows, "h", "e", hidden_dim=2)


def test_losses_that_are_no_number_are_null(spark):
    rows = spark.createDataFrame([([1.0, None], 1.0, 0), ([1.0, 3.0], 2.0, 1)], "embedding array<float>, score double, row_index long")
    _, history = training.train_head(rows, "h", "e", hidden_dim=2)
    assert [tuple(r) for r in history.collect()] == [(0, 0, 2, None)]
    unlabelled = rows.withColumn("score", F.lit(None).cast("double"))
    assert training.train_head(unlabelled, "h", "e", hidden_dim=2)[1].count() == 0
