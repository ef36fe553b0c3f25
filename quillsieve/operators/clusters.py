"""Keyword clusters of a run: vectors of the keywords, two components, k-means."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.answers import score_for_sorting
from quillsieve.functions.display import keyword_text, one_decimal, score_colour
from quillsieve.operators.encoders import embed_documents
from quillsieve.session import materialise
from quillsieve.sizing import small_side

#: Fixed value: number of clusters.
NUM_CLUSTERS = 20


def place_keywords(rows: DataFrame, encoder_id: str = "hashing-64", num_clusters: int = NUM_CLUSTERS, seed: int = 0) -> DataFrame:
    """Add ``x``, ``y`` and ``cluster_label`` from the row's keywords.

    Keywords are embedded once and written with the rows' keys alone, because the fits read the
    vectors many times; the rows are met again at the end. ``run_id`` and ``line_no`` together are unique.
    """
    worded = rows.select("run_id", "line_no", F.coalesce(keyword_text(F.col("keywords")), F.lit("")).alias("_text"))
    vectors = materialise(embed_documents(worded, encoder_id, text="_text", name="_vector").drop("_text"), "keywords")
    vectors = vectors.withColumn("_features", array_to_vector("_vector"))
    plane = PCA(k=2, inputCol="_features", outputCol="_plane").fit(vectors).transform(vectors)
    fitted = KMeans(k=num_clusters, seed=seed, featuresCol="_plane", predictionCol="cluster_label").fit(plane)
    placed = fitted.transform(plane).withColumn("_xy", vector_to_array("_plane"))
    places = placed.select("run_id", "line_no", F.col("_xy")[0].alias("x"), F.col("_xy")[1].alias("y"), "cluster_label")
    return rows.join(materialise(places, "places"), ["run_id", "line_no"]).select(*rows.columns, "x", "y", "cluster_label")


def top_keywords(placed: DataFrame) -> DataFrame:
    """Most frequent keyword of each cluster; the one seen first among equals."""
    words = placed.select("cluster_label", "run_id", "line_no", F.posexplode("keywords").alias("position", "keyword"))
    counted = words.groupBy("cluster_label", "keyword").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("run_id", "line_no", "position")).alias("first_seen")
    )
    rank = F.struct(-F.col("n"), F.col("first_seen"))
    return counted.groupBy("cluster_label").agg(F.min_by("keyword", rank).alias("cluster_top_keyword"))


def cluster_table(placed: DataFrame, highlight_score: int | None = None) -> DataFrame:
    """Rows of the cluster plot, each with its colour and its cluster's top keyword."""
    labelled = placed.join(small_side(top_keywords(placed)), "cluster_label", "left")
    score = score_for_sorting(F.col("score_raw"), F.col("score_json_type"))
    return labelled.withColumns(
        {
            "color": score_colour(score, highlight_score),
            "cluster_top_keyword": F.coalesce("cluster_top_keyword", F.lit("")),
        }
    )


def colour_legend(clusters: DataFrame) -> DataFrame:
    """Mean score of each colour, highest first, with the clusters that show it."""
    number = score_for_sorting(F.col("score_raw"), F.col("score_json_type"))
    # Clusters are few, so the set of them per colour is too.
    cells = clusters.groupBy("color", "cluster_label", "cluster_top_keyword").agg(F.sum(number).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    shown = F.concat_ws(": ", F.col("cluster_label").cast("string"), "cluster_top_keyword")
    legend = cells.groupBy("color").agg(
        (F.sum("_sum") / F.sum("_n")).alias("average_score"),
        F.sum("_n").alias("num_rows"),
        F.array_join(F.array_sort(F.collect_set(shown)), "; ").alias("clusters"),
    )
    return legend.withColumn("average_shown", one_decimal(F.col("average_score"))).orderBy(F.desc("average_score"), "color")
