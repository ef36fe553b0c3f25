import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.operators import evaluate


def f1_by_hand(truth, prediction):
    scores = []
    for label in set(truth) | set(prediction):
        tp = sum(t == p == label for t, p in zip(truth, prediction))
        held = sum(t == label for t in truth) + sum(p == label for p in prediction)
        scores.append(2 * tp / held)
    return sum(scores) / len(scores)


def ranks(values):
    values = np.asarray(values)
    return np.array([(values < v).sum() + ((values == v).sum() + 1) / 2 for v in values])


def rho_by_hand(x, y):
    x, y = ranks(x), ranks(y)
    return float(np.corrcoef(x, y)[0, 1])


def frame(spark, truth, prediction):
    return spark.createDataFrame([(i, float(t), float(p)) for i, (t, p) in enumerate(zip(truth, prediction))], "i long, t double, p double")


def test_f1_takes_labels_of_both_sides(spark):
    truth, prediction = [0, 0, 1, 2, 2, 2], [0, 1, 1, 2, -1, 6]
    df = frame(spark, truth, prediction)
    pairs = evaluate.pair_histogram(df, F.col("t"), F.col("p"))
    swapped = evaluate.pair_histogram(df, F.col("p"), F.col("t"))
    assert evaluate.macro_f1(pairs).first().f1 == pytest.approx(f1_by_hand(truth, prediction))
    assert evaluate.macro_f1(swapped).first().f1 == pytest.approx(f1_by_hand(truth, prediction))


def test_spearman_with_ties(spark):
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 5, 400)
    prediction = np.round(truth + rng.normal(0, 2, 400), 1)
    pairs = evaluate.pair_histogram(frame(spark, truth, prediction), F.col("t"), F.col("p"))
    assert evaluate.spearman(pairs).first().spearman == pytest.approx(rho_by_hand(truth, prediction), abs=1e-12)


def test_spearman_of_a_constant_side(spark):
    pairs = evaluate.pair_histogram(frame(spark, [1, 1, 1], [1, 2, 3]), F.col("t"), F.col("p"))
    assert evaluate.spearman(pairs).first().spearman is None
    assert evaluate.spearman(pairs, on_constant=0.0).first().spearman == 0.0
    assert math.isnan(evaluate.spearman(pairs, on_constant=float("nan")).first().spearman)
    pairs = evaluate.pair_histogram(frame(spark, [1, 2, 3], [1, 2, float("nan")]), F.col("t"), F.col("p"))
    assert evaluate.spearman(pairs, on_constant=0.0).first().spearman == 0.0


def test_validation_by_batch_is_the_mean_of_batches(spark):
    rng = np.random.default_rng(2)
    truth, prediction = rng.integers(0, 5, 300), rng.normal(2, 2, 300)
    truth[128:256] = 3  # a constant batch counts as correlation 0
    got = evaluate.validate(frame(spark, truth, prediction), "t", "p", "i").first()
    parts = [(truth[s : s + 128], prediction[s : s + 128]) for s in range(0, 300, 128)]
    classes = lambda p: np.rint(np.clip(p, 0, 5))
    assert got.loss == pytest.approx(np.mean([((t - p) ** 2).mean() for t, p in parts]))
    assert got.f1 == pytest.approx(np.mean([f1_by_hand(t.tolist(), classes(p).tolist()) for t, p in parts]))
    assert got.spearman == pytest.approx(np.mean([0 if len(set(t)) == 1 else rho_by_hand(t, p) for t, p in parts]))


def test_leaderboard_rounds_without_clamping_and_sorts(spark):
    rng = np.random.default_rng(3)
    truth = rng.integers(0, 5, 200)
    df = frame(spark, truth, truth + rng.normal(0, 0.4, 200)).withColumns({"noise": F.col("p") * 0 + F.rand(1) * 9 - 2})
    board = evaluate.leaderboard(df, "t", {"good": "p", "bad": "noise"}).collect()
    assert [r["head"] for r in board] == ["good", "bad"]
    p = np.array([r.p for r in df.orderBy("i").collect()])
    assert board[0].f1 == pytest.approx(f1_by_hand(truth.tolist(), np.rint(p).tolist()))
    assert board[0].spearman == pytest.approx(rho_by_hand(truth, np.rint(p)))
    assert board[0].loss == pytest.approx(((p - truth) ** 2).mean())
