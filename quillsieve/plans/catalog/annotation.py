"""Embedding, heads, thresholds and the metadata projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.operators.annotate import (
    annotate,
    annotate_vectors,
    compute_score,
    counts_around_filter,
    passes,
    predict_models,
    stats_projection,
    threshold_filter,
)
from quillsieve.operators.encoders import embed_documents, l2_normalised
from quillsieve.operators.heads import score_expression
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.session import new_folder
from quillsieve.plans.jobs import annotate_corpus
from quillsieve.sources.writers import write_annotated
from quillsieve.streaming.incremental import process_files

SCORES = [f"score_{n}" for n in fx.HEAD_NAMES]
#: Passed by a good part of the documents, and far from any rounded score.
THRESHOLD = 0.5


def rounded(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def annotate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = annotate(fx.table(spark, sf_dir, "documents"), "hashing-64", fx.heads())
    return scored.select("doc_id", "lang", *rounded(*SCORES))


def annotate_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = annotate_vectors(fx.table(spark, sf_dir, "embeddings"), fx.heads())
    return scored.select("vec_id", *rounded(*SCORES))


def head_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    scores = {f"score_{n}": score_expression(vector, head) for n, head in fx.heads().items()}
    return fx.table(spark, sf_dir, "embeddings").withColumns(scores).select("vec_id", *rounded(*SCORES))


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = embed_documents(fx.table(spark, sf_dir, "documents").select("doc_id", "text"), "hashing-8")
    values = embedded.select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return values.filter("value <> 0").select("doc_id", "dim", *rounded("value"))


def l2_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform(F.col("embedding"), lambda x, i: x.cast("double") * (i + 1))
    unit = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(l2_normalised(scaled)).alias("dim", "value"))
    return unit.select("vec_id", "dim", *rounded("value"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one score: NaN for some, exactly the threshold for others."""
    scored = compute_score(fx.table(spark, sf_dir, "documents"), fx.head(1))
    slot = F.col("doc_id") % 50
    return scored.withColumn(
        "score", F.when(slot == 0, F.lit(float("nan"))).when(slot == 1, F.lit(THRESHOLD)).otherwise(F.round("score", 6))
    )


def threshold_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_filter(_scored(spark, sf_dir), THRESHOLD).select("doc_id", "score")


def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_around_filter(_scored(spark, sf_dir), THRESHOLD, by=["lang"])


def annotate_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long English documents with a high second score: the first two conditions reach the scan."""
    where = [F.col("n_chars") > 1000, F.col("lang") == "en", passes(F.round("score_b", 6), THRESHOLD)]
    scored = annotate(fx.table(spark, sf_dir, "documents"), "hashing-64", fx.heads(), where=where)
    return scored.select("doc_id", "lang", *rounded(*SCORES))


def kept_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: score every document with three heads, keep what passes, count per language."""
    scored = annotate(fx.table(spark, sf_dir, "documents"), "hashing-64", fx.heads()).select("lang", "n_chars", *rounded(*SCORES))
    kept = threshold_filter(scored, THRESHOLD, "score_b")
    return kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("num_docs"), F.sum("n_chars").alias("num_chars"), F.round(F.avg("score_b"), 5).alias("mean_score")
    )


def _with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir)
    return docs.select(
        F.col("id").cast("string").alias("id"), "text", F.when(F.col("id") % 3 != 0, F.col("url")).otherwise(F.lit("")).alias("url"),
        (F.col("id") % 2).alias("odd"), F.col("source"),
        F.create_map(F.lit("language"), F.col("lang"), F.lit("source"), F.concat(F.lit("meta-"), F.col("source"))).alias("metadata"),
    )


_STATS = {"metadata_keys": ["language", "source"], "kept_as_is": SCORES}


def stats_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = annotate(_with_metadata(spark, sf_dir), "hashing-64", fx.heads())
    return stats_projection(scored, **_STATS).select("id", "url", "odd", "source", "language", *rounded(*SCORES))


def stats_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of an annotation run, the metadata one read back from its JSON lines."""
    scored = annotate(_with_metadata(spark, sf_dir), "hashing-64", fx.heads())
    data, stats = new_folder(spark, "annotated"), new_folder(spark, "stats")
    write_annotated(scored, data, stats, **_STATS)
    schema = "id string, url string, odd long, source string, language string, " + ", ".join(f"{s} double" for s in SCORES)
    return spark.read.schema(schema).json(stats).select("id", "url", "odd", "source", "language", *rounded(*SCORES))


def stats_every_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotation job on documents with a metadata map, none of whose keys is named."""
    source, data, stats = (new_folder(spark, f"every-key-{n}") for n in ("in", "out", "stats"))
    docs = fx.table(spark, sf_dir, "documents")
    # A key by language, and one that a top-level field has too.
    extra = F.create_map(F.concat(F.lit("seen_"), F.col("lang")), F.col("doc_id").cast("string"), F.lit("source"), F.concat(F.lit("meta-"), F.col("source")))
    metadata = F.when(F.col("doc_id") % 5 != 0, extra)
    docs.select(F.col("doc_id").cast("string").alias("id"), "text", "source", "n_chars", metadata.alias("metadata")).write.parquet(source)
    annotate_corpus(spark, source, data, stats, "hashing-64", fx.heads())
    keys = ["id", "source", "seen_en", "seen_fr", "seen_de", "seen_es"]
    schema = ", ".join(f"{k} string" for k in keys) + ", n_chars long, " + ", ".join(f"{s} double" for s in SCORES)
    return spark.read.schema(schema).json(stats).select(*keys, "n_chars", *rounded(*SCORES))


def multi_model_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = {"wide_a": fx.head(0), "wide_b": fx.head(1), "narrow": fx.head(2, 8)}
    predicted = predict_models(fx.table(spark, sf_dir, "documents"), models)
    return predicted.select("doc_id", *rounded("wide_a_score", "wide_b_score", "narrow_score"))


def stream_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "documents").schema
    out, checkpoint = new_folder(spark, "stream"), new_folder(spark, "stream-checkpoint")
    query = process_files(
        spark, sf_dir, schema, lambda batch: annotate(batch, "hashing-64", fx.heads()).drop("text"),
        out, checkpoint, key="doc_id", glob="documents.parquet",
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("doc_id", "lang", *rounded(*SCORES))


QUERIES = {
    "annotate_documents": annotate_documents,
    "annotate_heads": annotate_heads,
    "head_expression": head_expression,
    "hash_embed": hash_embed,
    "l2_normalise": l2_normalise,
    "threshold_filter": threshold_filtered,
    "filter_counts": filter_counts,
    "kept_by_language": kept_by_language,
    "annotate_where": annotate_where,
    "stats_projection": stats_columns,
    "stats_sink": stats_sink,
    "stats_every_key": stats_every_key,
    "multi_model_predict": multi_model_predict,
    "stream_annotate": stream_annotate,
}

_DOCUMENT_SCORES = f"""WITH {fx.document_scores_sql()}
SELECT d.doc_id, d.lang, {fx.score_names()}
FROM document_scores s JOIN documents d USING (doc_id) GROUP BY d.doc_id, d.lang"""

_VECTOR_SCORES = f"WITH {fx.vector_scores_sql()} SELECT vec_id, {fx.score_names()} FROM vector_scores GROUP BY vec_id"

_ONE_SCORE = f"""{fx.document_scores_sql()},
scored AS (
  SELECT doc_id, lang, CASE WHEN doc_id % 50 = 0 THEN CAST('NaN' AS DOUBLE) WHEN doc_id % 50 = 1 THEN {THRESHOLD} ELSE round(score, 6) END AS score
  FROM document_scores JOIN documents USING (doc_id) WHERE k = 1)"""

_STATS_SQL = f"""WITH {fx.document_scores_sql()}
SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE WHEN d.doc_id % 3 <> 0 THEN concat('doc://', source, '/', d.doc_id) END AS url,
       nullif(d.doc_id % 2, 0) AS odd, concat('meta-', source) AS source, lang AS language, {fx.score_names()}
FROM document_scores s JOIN documents d USING (doc_id) GROUP BY d.doc_id, d.source, d.lang"""

ORACLES = {
    "annotate_documents": _DOCUMENT_SCORES,
    "stream_annotate": _DOCUMENT_SCORES,
    "annotate_where": f"""WITH {fx.document_scores_sql()}
SELECT d.doc_id, d.lang, {fx.score_names()}
FROM document_scores s JOIN documents d USING (doc_id) WHERE d.n_chars > 1000 AND d.lang = 'en'
GROUP BY d.doc_id, d.lang HAVING round(max(CASE WHEN k = 1 THEN score END), 6) >= {THRESHOLD}""",
    "annotate_heads": _VECTOR_SCORES,
    "head_expression": _VECTOR_SCORES,
    "hash_embed": f"WITH {fx.embedded_sql(8)} SELECT doc_id, dim, round(v, 6) AS value FROM embedded",
    "l2_normalise": """
WITH scaled AS (
  SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * i)) AS v
  FROM embeddings)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, round(v / sqrt(sum(v * v) OVER (PARTITION BY vec_id)), 6) AS value FROM scaled""",
    "threshold_filter": f"WITH {_ONE_SCORE} SELECT doc_id, score FROM scored WHERE NOT isnan(score) AND score >= {THRESHOLD}",
    "filter_counts": f"""WITH {_ONE_SCORE}
SELECT lang, count(*) AS rows_before, count(*) FILTER (WHERE NOT isnan(score) AND score >= {THRESHOLD}) AS rows_after
FROM scored GROUP BY lang""",
    "kept_by_language": f"""WITH {fx.document_scores_sql()}
SELECT lang, count(*) AS num_docs, CAST(sum(n_chars) AS BIGINT) AS num_chars, round(avg(round(score, 6)), 5) AS mean_score
FROM document_scores JOIN documents USING (doc_id) WHERE k = 1 AND round(score, 6) >= {THRESHOLD} GROUP BY lang""",
    "stats_projection": _STATS_SQL,
    "stats_sink": _STATS_SQL,
    "stats_every_key": f"""WITH {fx.document_scores_sql()}
SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE WHEN d.doc_id % 5 <> 0 THEN concat('meta-', source) ELSE source END AS source,
       {', '.join(f"CASE WHEN lang = '{x}' AND d.doc_id % 5 <> 0 THEN CAST(d.doc_id AS VARCHAR) END AS seen_{x}" for x in ('en', 'fr', 'de', 'es'))},
       nullif(n_chars, 0) AS n_chars, {fx.score_names()}
FROM document_scores s JOIN documents d USING (doc_id) GROUP BY d.doc_id, d.source, d.lang, d.n_chars""",
    "multi_model_predict": f"""WITH {fx.document_scores_sql(64)}, {fx.document_scores_sql(8, '8')}
SELECT a.doc_id, round(a.score, 6) AS wide_a_score, round(b.score, 6) AS wide_b_score, round(c.score, 6) AS narrow_score
FROM document_scores a JOIN document_scores b ON a.doc_id = b.doc_id AND b.k = 1
JOIN document_scores8 c ON c.doc_id = a.doc_id AND c.k = 2 WHERE a.k = 0""",
}
