"""Quality of predicted scores: macro F1, Spearman correlation, squared error.

Every measure is computed from the histogram of (truth, prediction) pairs, which one
aggregation with map-side combining gives. Equal rows cost nothing beyond their count, so a
label or score held by most rows does not slow anything down.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.display import clamp, round_half_even
from quillsieve.operators.position import average_ranks
from quillsieve.session import materialise
from quillsieve.sizing import small_side


def pair_histogram(df: DataFrame, truth: Column, prediction: Column, by: Sequence[str] = ()) -> DataFrame:
    """Number of rows per pair, ``truth, prediction, n``; rows lacking one of them are left out."""
    pairs = df.select(*by, truth.cast("double").alias("truth"), prediction.cast("double").alias("prediction"))
    return pairs.filter("truth IS NOT NULL AND prediction IS NOT NULL").groupBy(*by, "truth", "prediction").agg(F.count(F.lit(1)).alias("n"))


def label_scores(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1 per label over the labels of either side; 0 where a label is never hit."""
    hit = F.col("truth") == F.col("prediction")
    sides = histogram.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("label"), F.col("n").alias("held"), F.when(hit, F.col("n")).otherwise(F.lit(0)).alias("hits")),
                F.struct(F.col("prediction").alias("label"), F.col("n").alias("held"), F.lit(0).cast("long").alias("hits")),
            )
        ).alias("s"),
    )
    totals = sides.groupBy(*by, "s.label").agg(F.sum("s.hits").alias("hits"), F.sum("s.held").alias("held"))
    return totals.select(*by, "label", (2 * F.col("hits") / F.col("held")).alias("f1"))


def macro_f1(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of the labels' F1."""
    return label_scores(histogram, by).groupBy(*by).agg(F.avg("f1").alias("f1"))


def spearman(histogram: DataFrame, by: Sequence[str] = (), on_constant: float | None = None, bounded: bool = False) -> DataFrame:
    """Correlation of average-tie ranks.

    ``on_constant`` is given where it is undefined: one side has a single value, or a NaN. The
    histogram is written first, since each side's ranks read it again. ``bounded`` states that
    each group has few distinct values.
    """
    return _correlation(materialise(histogram, "pairs"), by, on_constant, bounded)


def _correlation(histogram: DataFrame, by: Sequence[str], on_constant: float | None, bounded: bool) -> DataFrame:
    """Spearman correlation from a stored histogram."""
    joined = histogram
    for side in ("truth", "prediction"):
        values = histogram.groupBy(*by, side).agg(F.sum("n").alias("_n"))
        ranks = average_ranks(values, side, "_n", f"rank_{side}", by, bounded).drop("_n")
        joined = joined.join(ranks if bounded else small_side(ranks), [*by, side])
    n, x, y = F.col("n"), F.col("rank_truth"), F.col("rank_prediction")
    sums = joined.groupBy(*by).agg(
        F.sum(n).cast("double").alias("rows"),
        F.sum(n * x * y).alias("xy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"),
        ((F.min(x) == F.max(x)) | (F.min(y) == F.max(y)) | F.bool_or(F.isnan("truth") | F.isnan("prediction"))).alias("undefined"),
    )
    # Average ranks have mean (n + 1) / 2 on either side.
    squared_mean = F.col("rows") * F.pow((F.col("rows") + 1) / 2, F.lit(2))
    covariance = F.col("xy") - squared_mean
    spread = F.sqrt((F.col("xx") - squared_mean) * (F.col("yy") - squared_mean))
    value = F.when(F.col("undefined"), F.lit(on_constant).cast("double")).otherwise(F.try_divide(covariance, spread))
    return sums.select(*by, value.alias("spearman"))


def squared_error(truth: Column, prediction: Column) -> Column:
    """Mean squared error as an aggregate."""
    return F.avg(F.pow(prediction - truth, F.lit(2)))


def class_of(prediction: Column, clamped: bool = False) -> Column:
    """Predicted class: rounded half to even; clamped to 0..5 first while training."""
    return round_half_even(clamp(prediction, 0, 5)) if clamped else round_half_even(prediction)


def leaderboard(df: DataFrame, truth: str, predictions: Mapping[str, str]) -> DataFrame:
    """F1, Spearman and squared error of each head, best correlation first.

    ``predictions`` maps a head's name to its score column. The rows are read once.
    """
    names = F.create_map(*[F.lit(x) for name, column in predictions.items() for x in (column, name)])
    long = df.unpivot([truth], list(predictions.values()), "_column", "_score").select(
        names[F.col("_column")].alias("head"), F.col(truth).cast("double").alias("_truth"), F.col("_score").cast("double").alias("_score")
    )
    usable = long.filter("_truth IS NOT NULL AND _score IS NOT NULL")
    cells = usable.groupBy("head", class_of(F.col("_truth")).alias("truth"), class_of(F.col("_score")).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.pow(F.col("_score") - F.col("_truth"), F.lit(2))).alias("error")
    )
    # One row per head and pair of classes, written because three measures read it.
    cells = materialise(cells, "cells")
    pairs = cells.select("head", "truth", "prediction", "n")
    loss = cells.groupBy("head").agg((F.sum("error") / F.sum("n")).alias("loss"))
    board = macro_f1(pairs, ["head"]).join(_correlation(pairs, ["head"], None, False), "head").join(loss, "head")
    return board.orderBy(F.desc_nulls_last("spearman"), "head")


def validate(df: DataFrame, truth: str, prediction: str, index: str | None = None, batch_size: int = 128) -> DataFrame:
    """Loss, F1 and Spearman of one head as one row.

    With ``index`` the measures are taken per batch of ``batch_size`` rows and then averaged,
    as a training loop reports them; a batch with a constant side counts as correlation 0.
    """
    batch = F.lit(0).cast("long") if index is None else F.floor(F.col(index) / F.lit(batch_size))
    by, t, p = ["batch"], F.col("truth"), F.col("prediction")
    scored = df.select(batch.alias("batch"), F.col(truth).cast("double").alias("truth"), F.col(prediction).cast("double").alias("prediction"))
    # Three narrow columns, written so that the scores are computed once for all measures.
    scored = materialise(scored.filter("truth IS NOT NULL AND prediction IS NOT NULL"), "scored")
    loss = scored.groupBy(*by).agg(squared_error(t, p).alias("loss"))
    f1 = macro_f1(pair_histogram(scored, t, class_of(p, clamped=True), by), by)
    correlation = _correlation(pair_histogram(scored, t, p, by), by, 0.0, bounded=index is not None)
    return loss.join(f1, by).join(correlation, by).agg(
        F.avg("loss").alias("loss"), F.avg("f1").alias("f1"), F.avg("spearman").alias("spearman")
    )
