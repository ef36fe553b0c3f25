"""Resume, requests to a responder, throughput."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.operators.generation import generate, parse_responses, recorded, resume, throughput
from quillsieve.operators.position import running_total
from quillsieve.operators.tasks import CATEGORIES, RESOURCE_CATEGORY, SCORE, SYNTHESIZE, TRANSLATE, TaskSpec, count_words
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.plans.catalog.texts import WORDS, quoted
from quillsieve.plans.jobs import label_corpus
from quillsieve.session import new_folder
from quillsieve.sources.readers import read_results
from quillsieve.streaming.incremental import process_files

MODEL = "rule-model"


def _answer(kind: str, content: str) -> str | Exception:
    """A model that answers by rule: from the words and the md5 of the request."""
    digest, n = hashlib.md5(content.encode()).hexdigest(), len(content.split())
    if digest[0] == "0":
        return RuntimeError("request refused")
    if digest[0] == "1":
        return f"no idea {digest}" if kind != "rewrite" else ""
    if kind == "score":
        return json.dumps({"score": n % 6, "reasoning": digest, "keywords": [str(n), kind]})
    if kind == "category":
        return "```json\n" + json.dumps({"reasoning": digest, "category": CATEGORIES[n % len(CATEGORIES)]}) + "\n```"
    return f"{digest} {content}"


def rule_responder(kind: str):
    """Loader of the rule-based responder."""
    return lambda: lambda requests: [_answer(kind, messages[-1]["content"]) for messages in requests]


def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label. Some ids are null, and so is one finished id."""
    docs = fx.documents(spark, sf_dir).withColumn("id", F.when(F.col("doc_id") % 97 != 0, F.col("doc_id")))
    done = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    return resume(docs, done).select("doc_id", "lang")


def generate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = generate(fx.documents(spark, sf_dir), SCORE, rule_responder("score"), MODEL, "mixed", on_error="default")
    return results.select(
        "id", "url", F.md5("input_text").alias("input_md5"), "score", "reasoning", F.array_join("keywords", " ").alias("keywords"),
        "model", "language", "num_tokens", F.col("error").isNotNull().alias("failed"),
    )


def generate_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.papers(spark, sf_dir).withColumn("abstract", F.coalesce("abstract", F.lit("")))
    results = generate(docs, RESOURCE_CATEGORY, rule_responder("category"), MODEL)
    return results.select("id", "title", "reasoning", "category", F.col("error").isNotNull().alias("failed"))


def _rewrite(task: TaskSpec):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        results = generate(fx.documents(spark, sf_dir), task, rule_responder("rewrite"), MODEL, on_error="default")
        return results.select("id", F.md5("text").alias("text_md5"), F.md5("input_text").alias("input_md5"), "num_tokens", "num_generated_tokens", "model")

    return query


def recorded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers looked up in a table, which lacks those of unlabelled documents."""
    docs = fx.documents(spark, sf_dir)
    labelled = fx.table(spark, sf_dir, "labels").select("doc_id")
    answers = docs.join(labelled, "doc_id", "left_semi").select("id", F.expr(fx.RESPONSE).alias("response"))
    results = parse_responses(recorded(docs, answers), SCORE, MODEL, F.col("lang"))
    return results.select("id", "score", "score_raw", "reasoning", F.col("error").isNotNull().alias("failed"))


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as batches of requests: the value is the time taken, ``k`` the tokens."""
    return fx.table(spark, sf_dir, "events").select(
        "event_id", "event_type", (F.lit(1) + F.col("event_id") % 10).alias("num_rows"),
        F.get_json_object("props", "$.k").cast("long").alias("num_tokens"), F.col("value").alias("elapsed_s"),
    )


def batch_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throughput(_batches(spark, sf_dir), ["event_type"]).select(
        "event_type", F.round("rows_per_second", 5).alias("rows_per_second"), F.round("tokens_per_second", 5).alias("tokens_per_second"), "total_tokens"
    )


def running_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_total(_batches(spark, sf_dir), ["event_id"], "num_tokens", "total_tokens").select("event_id", "total_tokens")


def label_and_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelling job twice: English documents, then all. Finished ones are not asked again."""
    docs = fx.documents(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "url", "text", "lang")
    out = new_folder(spark, "results")
    for part in (docs.filter("lang = 'en'"), docs):
        label_corpus(part, SCORE, rule_responder("score"), MODEL, out, on_error="default", slices=2)
    written = read_results(spark, out)
    return written.groupBy(F.col("id").cast("long").alias("id"), "run_id").agg(
        F.count(F.lit(1)).alias("num_results"), F.max("score").alias("score"), F.max("reasoning").alias("reasoning"), F.max("language").alias("language")
    )


def overwrite_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of all documents replaced by one of the English ones, with other answers."""
    docs = fx.documents(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "url", "text", "lang")
    out = new_folder(spark, "replaced")
    zero = lambda: lambda requests: ['{"score": 5}'] * len(requests)
    label_corpus(docs, SCORE, zero, MODEL, out, slices=1)
    label_corpus(docs.filter("lang = 'en'"), SCORE, rule_responder("score"), MODEL, out, on_error="default", overwrite=True, slices=2)
    return read_results(spark, out).select(F.col("id").cast("long").alias("id"), "run_id", "score", "reasoning")


def results_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewriting with one output folder per input file."""
    docs = fx.documents(spark, sf_dir).withColumn("source_file", F.concat(F.lit("part-"), F.col("doc_id") % 3))
    out = new_folder(spark, "by-source")
    label_corpus(docs.select("id", "url", "text", "source_file"), SYNTHESIZE, rule_responder("rewrite"), MODEL, out, on_error="default", slices=2)
    rows = spark.read.schema("id long, text string, run_id string, source_file string").json(out)
    return rows.select("id", "source_file", F.md5("text").alias("text_md5"))


def stream_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests made as files arrive; the same rows as in one batch."""
    schema = fx.table(spark, sf_dir, "documents").schema
    out, checkpoint = new_folder(spark, "stream-labels"), new_folder(spark, "stream-labels-checkpoint")

    def step(batch: DataFrame) -> DataFrame:
        return generate(fx.as_web_documents(batch), SCORE, rule_responder("score"), MODEL, "mixed", on_error="default")

    process_files(spark, sf_dir, schema, step, out, checkpoint, glob="documents.parquet").awaitTermination()
    return spark.read.parquet(out).select("id", F.md5("input_text").alias("input_md5"), "score", "reasoning", F.col("error").isNotNull().alias("failed"))


QUERIES = {
    "stream_label": stream_label,
    "resume_anti_join": resume_anti_join,
    "generate_score": generate_score,
    "generate_category": generate_category,
    "generate_synthesize": _rewrite(SYNTHESIZE),
    "generate_translate": _rewrite(TRANSLATE),
    "recorded_answers": recorded_answers,
    "batch_throughput": batch_throughput,
    "running_tokens": running_tokens,
    "label_and_resume": label_and_resume,
    "overwrite_run": overwrite_run,
    "results_by_source": results_by_source,
}


def _asked_sql(task: TaskSpec, extra: str = "") -> str:
    """``asked``: truncated text, request, and the rule's ingredients for each document."""
    budget = task.input_budget(count_words)
    content = "concat('Title: ', title, chr(10), 'Abstract: ', coalesce(abstract, ''))" if task.kind == "category" else "body"
    return f"""
docs AS (SELECT *, {fx.PAPER_COLUMNS}, {WORDS.format('text')} AS words FROM documents),
cut AS (SELECT *, array_to_string(words[1:{budget}], ' ') AS body, least(len(words), {budget}) AS num_tokens FROM docs),
requests AS (SELECT *, concat({quoted(task.prompt)}, {content}) AS request FROM cut),
asked AS (SELECT *, md5(request) AS digest, len({WORDS.format('request')}) AS n, substr(md5(request), 1, 1) IN ('0', '1') AS failed FROM requests)"""


_RUN_ID = f"substr(sha256(concat({quoted(SCORE.prompt)}, '{MODEL}')), 1, 10)"


def _rewrite_sql(task: TaskSpec) -> str:
    return f"""
WITH {_asked_sql(task)}
SELECT id, md5(CASE WHEN failed THEN '' ELSE concat(digest, ' ', request) END) AS text_md5, md5(body) AS input_md5, num_tokens,
       CASE WHEN failed THEN 0 ELSE n + 1 END AS num_generated_tokens, '{MODEL}' AS model FROM asked"""


ORACLES = {
    "resume_anti_join": """
WITH d AS (SELECT doc_id, lang, CASE WHEN doc_id % 97 <> 0 THEN doc_id END AS id FROM documents)
SELECT doc_id, lang FROM d WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.id)""",
    "generate_score": f"""
WITH {_asked_sql(SCORE)}
SELECT id, url, md5(body) AS input_md5, CASE WHEN failed THEN 0.0 ELSE CAST(n % 6 AS DOUBLE) END AS score,
       CASE WHEN failed THEN '' ELSE digest END AS reasoning, CASE WHEN failed THEN '' ELSE concat(n, ' score') END AS keywords,
       '{MODEL}' AS model, 'mixed' AS language, num_tokens, failed FROM asked""",
    "stream_label": f"""
WITH {_asked_sql(SCORE)}
SELECT id, md5(body) AS input_md5, CASE WHEN failed THEN 0.0 ELSE CAST(n % 6 AS DOUBLE) END AS score,
       CASE WHEN failed THEN '' ELSE digest END AS reasoning, failed FROM asked""",
    "generate_category": f"""
WITH {_asked_sql(RESOURCE_CATEGORY)}
SELECT id, title, CASE WHEN failed THEN '' ELSE digest END AS reasoning,
       CASE WHEN failed THEN '' ELSE [{', '.join(quoted(c) for c in CATEGORIES)}][n % {len(CATEGORIES)} + 1] END AS category, failed FROM asked""",
    "generate_synthesize": _rewrite_sql(SYNTHESIZE),
    "generate_translate": _rewrite_sql(TRANSLATE),
    "recorded_answers": f"""
WITH {fx.parsed_sql(f"SELECT d.*, CASE WHEN l.doc_id IS NOT NULL THEN {fx.RESPONSE.replace('doc_id', 'd.doc_id')} END AS response FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")},
merged AS (SELECT *, ok AND json_type(j, '$.score') IS NOT NULL AS has_score, json_type(j, '$.score') AS kind FROM parsed)
SELECT doc_id AS id, CASE WHEN NOT has_score THEN 0.0 WHEN kind <> 'VARCHAR' THEN CAST(j->>'$.score' AS DOUBLE) END AS score,
       CASE WHEN has_score THEN j->>'$.score' ELSE '0' END AS score_raw,
       CASE WHEN ok AND json_type(j, '$.reasoning') IS NOT NULL THEN j->>'$.reasoning' ELSE '' END AS reasoning, NOT ok AS failed FROM merged""",
    "batch_throughput": """
WITH b AS (SELECT event_type, 1 + event_id % 10 AS num_rows, CAST(props->>'$.k' AS BIGINT) AS num_tokens, value AS elapsed_s FROM events)
SELECT event_type, round(avg(CASE WHEN elapsed_s > 0 THEN num_rows / elapsed_s ELSE 0 END), 5) AS rows_per_second,
       round(avg(CASE WHEN elapsed_s > 0 THEN num_tokens / elapsed_s ELSE 0 END), 5) AS tokens_per_second,
       CAST(sum(num_tokens) AS BIGINT) AS total_tokens FROM b GROUP BY event_type""",
    "running_tokens": """
SELECT event_id, CAST(sum(CAST(props->>'$.k' AS BIGINT)) OVER (ORDER BY event_id) AS BIGINT) AS total_tokens FROM events""",
    "label_and_resume": f"""
WITH {_asked_sql(SCORE)}
SELECT id, {_RUN_ID} AS run_id, CAST(1 AS BIGINT) AS num_results, CASE WHEN failed THEN 0.0 ELSE CAST(n % 6 AS DOUBLE) END AS score,
       CASE WHEN failed THEN '' ELSE digest END AS reasoning, 'arb_Arab' AS language FROM asked""",
    "overwrite_run": f"""
WITH {_asked_sql(SCORE)}
SELECT id, {_RUN_ID} AS run_id, CASE WHEN failed THEN 0.0 ELSE CAST(n % 6 AS DOUBLE) END AS score, CASE WHEN failed THEN '' ELSE digest END AS reasoning
FROM asked WHERE lang = 'en'""",
    "results_by_source": f"SELECT id, concat('part-', id % 3) AS source_file, text_md5 FROM ({_rewrite_sql(SYNTHESIZE)})",
}
