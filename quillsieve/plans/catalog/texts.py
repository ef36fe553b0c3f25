"""Text functions, prompts and answer parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions import answers, display, text
from quillsieve.operators.generation import parse_responses, prepare, rejected_years, resource_papers
from quillsieve.operators.tasks import CATEGORIES, RESOURCE_CATEGORY, SCORE, SYNTHESIZE, TRANSLATE, count_words
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.session import new_folder
from quillsieve.sizing import spread
from quillsieve.sources.readers import read_papers

#: Tight enough to cut many documents.
SMALL_MODEL_TOKENS = 512


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(fx.table(spark, sf_dir, "documents")).select("doc_id", text.word_count(F.col("text")).cast("long").alias("num_words"))


def truncate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    budget = SCORE.input_budget(count_words, SMALL_MODEL_TOKENS)
    cut = prepare(fx.documents(spark, sf_dir), budget)
    return cut.select("doc_id", F.md5("text").alias("text_md5"), "num_tokens")


def token_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that fit the input budget of each task."""
    counted = spread(fx.table(spark, sf_dir, "documents")).select(text.word_count(F.col("text")).alias("n"))
    fits = [F.count_if(F.col("n") <= t.input_budget(count_words)).alias(f"fits_{t.name}") for t in (SCORE, RESOURCE_CATEGORY, SYNTHESIZE, TRANSLATE)]
    return counted.agg(*fits)


def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.papers(spark, sf_dir).withColumn("abstract", F.coalesce("abstract", F.lit("")))
    chat = docs.withColumns({"c": SCORE.messages(), "r": RESOURCE_CATEGORY.messages()})
    return chat.select(
        "doc_id",
        F.sha2(F.col("c")[1]["content"], 256).alias("score_prompt"),
        F.sha2(F.col("r")[1]["content"], 256).alias("resource_prompt"),
        F.col("c")[0]["role"].alias("first_role"),
        F.array_join(F.transform("r", lambda m: m["role"]), ",").alias("roles"),
        text.run_key(SCORE.prompt, F.concat(F.lit("model-"), F.col("lang"))).alias("run_id"),
    )


def resource_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resource_papers(fx.papers(spark, sf_dir))
    return kept.select("id", "year", F.md5("text").alias("text_md5"))


def rejected_paper_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_years(fx.papers(spark, sf_dir))


def csv_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers written as CSV, with line breaks and quotes, and scanned back."""
    folder = new_folder(spark, "papers")
    papers = fx.papers(spark, sf_dir).selectExpr("cast(id as string) id", "concat('\"', title, '\"') title", "abstract", "url", "year")
    papers.write.option("header", True).option("escape", '"').option("emptyValue", '""').csv(folder)
    return read_papers(spark, folder).select(F.col("id").cast("long").alias("id"), "title", F.md5("abstract").alias("abstract_md5"), "url", "year")


def _responses(spark: SparkSession, sf_dir: str, response: str) -> DataFrame:
    docs = fx.papers(spark, sf_dir)
    return docs.withColumns({"response": F.expr(response), "error": F.lit(None).cast("string")})


def answer_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _responses(spark, sf_dir, fx.RESPONSE)
    answer = F.col("response")
    return raw.select(
        "doc_id", text.answer_body(answer).alias("body"), text.answer_thinking(answer).alias("thinking"), text.strip_fences(answer).alias("unfenced")
    )


def parse_score_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_responses(_responses(spark, sf_dir, fx.RESPONSE), SCORE, "model-x", F.col("lang"))
    return parsed.select(
        "id", "url", F.md5("input_text").alias("input_md5"), "model", "language", "score", "score_raw", "score_json_type",
        "reasoning", F.array_join("keywords", " ").alias("keywords"), "thinking", "extra", F.col("error").isNotNull().alias("failed"),
    )


def parse_category_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_responses(_responses(spark, sf_dir, fx.CATEGORY_RESPONSE), RESOURCE_CATEGORY, "model-x")
    return parsed.select(
        "id", "url", "title", F.md5("abstract").alias("abstract_md5"), "reasoning", "category",
        F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False)).alias("known_category"), "extra", F.col("error").isNotNull().alias("failed"),
    )


def extract_output_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with the object inside an output tag, for some broken over lines or missing."""
    wrapped = fx.table(spark, sf_dir, "documents").withColumn("response", F.expr(_TAGGED))
    tagged = wrapped.withColumn("_p", text.evaluated_once(answers.parse_object)(text.output_tag(F.col("response"))))
    parsed = F.col("_p")
    found = parsed["ok"]
    return tagged.select(
        "doc_id", found.alias("found"),
        F.when(found, parsed["score_raw"]).otherwise(F.lit("0")).alias("score_raw"),
        F.when(found, parsed["reasoning"]).otherwise(F.lit("")).alias("reasoning"),
    )


_TAGGED = """CASE doc_id % 4
  WHEN 0 THEN concat('text <output>', chr(10), ' {"score": ', doc_id % 7, ',', chr(10), '"reasoning": "', md5(text), '"}</output> <output>{}</output>')
  WHEN 1 THEN concat('<output>{"score": ', doc_id % 7, ', "reasoning": "', md5(text), '"}</output>', text)
  WHEN 2 THEN concat('<output>score: ', doc_id % 7, '</output>')
  ELSE text END"""


def display_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    centred = (value - F.lit(2.5)).cast("double")
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        display.one_decimal(centred).alias("one_decimal"),
        display.round_half_even(value * 2 / 2).alias("rounded"),
        display.round_half_even(F.floor(value) + 0.5).alias("rounded_tie"),
        display.round_half_even(display.clamp(centred, 0, 5)).alias("clamped"),
        display.score_colour(F.floor(centred)).alias("colour"),
        display.score_colour(F.floor(centred), 3).alias("highlighted"),
        display.minute_stamp(F.lit(1.7e9) + value * 1000).alias("stamp"),
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents")
    folder = text.checkpoint_name(F.concat(F.lit("org/"), F.col("source")), F.concat(F.lit("lab/"), F.col("lang")))
    named = docs.withColumn("folder", folder)
    return named.select(
        "doc_id", "folder",
        text.model_of_path(F.concat(F.col("folder"), F.lit("/regression_head.ckpt"))).alias("model"),
        display.model_key(F.lit("m"), F.col("lang"), F.col("source")).alias("model_key"),
    )


QUERIES = {
    "word_counts": word_counts,
    "truncate_tokens": truncate_tokens,
    "token_budgets": token_budgets,
    "build_prompts": build_prompts,
    "resource_filter": resource_filter,
    "rejected_paper_years": rejected_paper_years,
    "csv_papers": csv_papers,
    "answer_cleanup": answer_cleanup,
    "parse_score_response": parse_score_response,
    "parse_category_response": parse_category_response,
    "extract_output_tag": extract_output_tag,
    "display_columns": display_columns,
    "model_names": names,
}

WORDS = "list_filter(string_split_regex({0}, '\\s+'), lambda w: w <> '')"
_BUDGET = SCORE.input_budget(count_words, SMALL_MODEL_TOKENS)
_PAPERS = f"papers AS (SELECT *, {fx.PAPER_COLUMNS} FROM documents)"
_COMPLETE = "title IS NOT NULL AND abstract IS NOT NULL"


def one_decimal_sql(x: str) -> str:
    return f"printf('%.1f', {x})"


ORACLES = {
    "word_counts": f"SELECT doc_id, len({WORDS.format('text')}) AS num_words FROM documents",
    "truncate_tokens": f"""
WITH w AS (SELECT doc_id, {WORDS.format('text')} AS words FROM documents)
SELECT doc_id, md5(array_to_string(words[1:{_BUDGET}], ' ')) AS text_md5, least(len(words), {_BUDGET}) AS num_tokens FROM w""",
    "token_budgets": f"WITH w AS (SELECT len({WORDS.format('text')}) AS n FROM documents) SELECT "
    + ", ".join(f"count(*) FILTER (WHERE n <= {t.input_budget(count_words)}) AS fits_{t.name}" for t in (SCORE, RESOURCE_CATEGORY, SYNTHESIZE, TRANSLATE))
    + " FROM w",
    "build_prompts": f"""
WITH {_PAPERS}
SELECT doc_id, sha256(concat({quoted(SCORE.prompt)}, text)) AS score_prompt,
       sha256(concat({quoted(RESOURCE_CATEGORY.prompt)}, 'Title: ', title, chr(10), 'Abstract: ', abstract)) AS resource_prompt,
       'system' AS first_role, 'system,user' AS roles,
       substr(sha256(concat({quoted(SCORE.prompt)}, 'model-', lang)), 1, 10) AS run_id FROM papers""",
    "resource_filter": f"""
WITH {_PAPERS}
SELECT id, year, md5(concat(title, ' ', abstract)) AS text_md5 FROM papers WHERE {_COMPLETE} AND try_cast(year AS INTEGER) > 2010""",
    "rejected_paper_years": f"""
WITH {_PAPERS} SELECT count(*) AS rejected_years FROM papers WHERE {_COMPLETE} AND try_cast(year AS INTEGER) IS NULL""",
    "csv_papers": f"""
WITH {_PAPERS} SELECT id, concat('"', title, '"') AS title, md5(nullif(abstract, '')) AS abstract_md5, url, year FROM papers""",
    "answer_cleanup": f"""
WITH r AS (SELECT doc_id, {fx.RESPONSE} AS response FROM documents)
SELECT doc_id, {fx.cleaned_sql()} AS body, {fx.thinking_sql()} AS thinking,
       {fx._STRIP.format("replace(" + fx._STRIP.format("replace(response, '```json', '')") + ", '```', '')")} AS unfenced FROM r""",
    "parse_score_response": f"""
WITH {fx.parsed_sql(f"SELECT *, {fx.PAPER_COLUMNS}, {fx.RESPONSE} AS response FROM documents")},
merged AS (SELECT *, ok AND json_type(j, '$.score') IS NOT NULL AS has_score, json_type(j, '$.score') AS kind FROM parsed)
SELECT id, url, md5(text) AS input_md5, 'model-x' AS model, lang AS language,
       CASE WHEN NOT has_score THEN 0.0 WHEN kind <> 'VARCHAR' THEN CAST(j->>'$.score' AS DOUBLE) END AS score,
       CASE WHEN has_score THEN j->>'$.score' ELSE '0' END AS score_raw,
       CASE WHEN has_score AND kind = 'VARCHAR' THEN 'string' ELSE 'number' END AS score_json_type,
       CASE WHEN ok AND json_type(j, '$.reasoning') IS NOT NULL THEN j->>'$.reasoning' ELSE '' END AS reasoning,
       CASE WHEN ok AND json_type(j, '$.keywords') IS NOT NULL THEN array_to_string(from_json(j->'$.keywords', '["VARCHAR"]'), ' ') ELSE '' END AS keywords,
       CASE WHEN ok THEN thought ELSE '' END AS thinking,
       CASE WHEN ok AND json_type(j, '$.note') IS NOT NULL THEN CAST(json_object('id', j->>'$.id', 'note', j->>'$.note') AS VARCHAR) END AS extra,
       NOT ok AS failed FROM merged""",
    "parse_category_response": f"""
WITH {fx.parsed_sql(f"SELECT *, {fx.PAPER_COLUMNS}, {fx.CATEGORY_RESPONSE} AS response FROM documents")},
merged AS (
  SELECT *, CASE WHEN ok AND json_type(j, '$.reasoning') IS NOT NULL THEN j->>'$.reasoning' ELSE '' END AS reasoning,
         CASE WHEN ok AND json_type(j, '$.category') IS NOT NULL THEN j->>'$.category' WHEN ok AND json_type(j, '$.category') = 'NULL' THEN NULL ELSE '' END AS category
  FROM parsed)
SELECT id, url, title, md5(abstract) AS abstract_md5, reasoning, category,
       coalesce(category IN ({', '.join(quoted(c) for c in CATEGORIES)}), false) AS known_category,
       CASE WHEN ok AND json_type(j, '$.year') IS NOT NULL THEN concat('{{"year":', j->>'$.year', '}}') END AS extra,
       NOT ok AS failed FROM merged""",
    "extract_output_tag": f"""
WITH r AS (SELECT doc_id, regexp_extract({_TAGGED}, '(?s)<output>(.*?)</output>', 1) AS inner_text FROM documents),
p AS (SELECT *, coalesce(json_valid(inner_text), false) AS found FROM r),
o AS (SELECT *, CAST(CASE WHEN found THEN inner_text ELSE '{{}}' END AS JSON) AS j FROM p)
SELECT doc_id, found, coalesce(j->>'$.score', '0') AS score_raw, coalesce(j->>'$.reasoning', '') AS reasoning FROM o""",
    "display_columns": f"""
WITH e AS (SELECT *, value - CAST(2.5 AS DOUBLE) AS centred FROM events)
SELECT event_id, {one_decimal_sql('centred')} AS one_decimal, round_even(value * 2 / 2, 0) AS rounded,
       round_even(floor(value) + 0.5, 0) AS rounded_tie, round_even(greatest(0, least(5, centred)), 0) AS clamped,
       CASE ((CAST(floor(centred) AS BIGINT) % 6) + 6) % 6 {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(display.SCORE_COLOURS))} END AS colour,
       CASE WHEN ((CAST(floor(centred) AS BIGINT) % 6) + 6) % 6 = 3 THEN '{display.HIGHLIGHTED}' ELSE '{display.NOT_HIGHLIGHTED}' END AS highlighted,
       strftime(to_timestamp(1700000000 + value * 1000)::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS stamp FROM e""",
    "model_names": """
SELECT doc_id, concat('org__', source, '@lab__', lang) AS folder, concat('org/', source, '@lab/', lang) AS model,
       concat('m-', lang, '-', source) AS model_key FROM documents""",
}
