"""The run explorer: summaries, histograms, pages, search, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.display import SCORE_COLOURS, keyword_text, minute_stamp, one_decimal
from quillsieve.functions.text import word_count
from quillsieve.operators.clusters import cluster_table, colour_legend, place_keywords, top_keywords
from quillsieve.operators.runs import (
    by_model,
    cap_lines,
    one_page,
    page_counts,
    pages,
    requests,
    run_summaries,
    score_counts,
    score_histogram,
    search,
)
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.plans.catalog.texts import WORDS, one_decimal_sql
from quillsieve.session import materialise, new_folder
from quillsieve.sources.readers import read_runs, run_lines

CAP = 100
SHOWN_RUN = "run1"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed lines, written once as the explorer keeps them."""
    return materialise(run_lines(fx.raw_run_lines(spark, sf_dir)), "lines")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summaries(_lines(spark, sf_dir)).select(
        "model_key", "model_name", "language", "dataset_id", "num_requests", "creation_ts", minute_stamp(F.col("creation_ts")).alias("created"),
        "thinking", F.array_join(F.transform("score_distribution", lambda n: n.cast("string")), ",").alias("score_distribution"),
    )


def runs_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_model(run_summaries(_lines(spark, sf_dir))).select("model_name", "model_runs", "model_requests", "dataset_id", "num_requests")


def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_histogram(requests(_lines(spark, sf_dir)))


def sparse_score_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_counts(requests(_lines(spark, sf_dir)))


def cap_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_lines(_lines(spark, sf_dir), CAP).select("run_id", "line_no", "complete")


def _paged(order: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        paged = pages(requests(_lines(spark, sf_dir)), "score", order)
        return paged.select("run_id", "line_no", "sample_no", "page", one_decimal(F.col("sort_score")).alias("score_shown"))

    return query


def one_page_of_a_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of a run by score, seven rows to a page."""
    rows = requests(_lines(spark, sf_dir))
    return one_page(rows, SHOWN_RUN, 2, "score", "desc", 7).select("run_id", "line_no", "score_raw")


def page_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_counts(requests(_lines(spark, sf_dir)))


def search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(requests(_lines(spark, sf_dir)), "TIONAN")
    return found.select("run_id", "line_no", word_count(F.col("input_text")).cast("long").alias("input_words"))


def tolerant_run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines written as files of four runs and scanned back."""
    folder = new_folder(spark, "run-files")
    fx.raw_run_lines(spark, sf_dir).select("run_id", "value").write.partitionBy("run_id").text(folder)
    return requests(read_runs(spark, folder)).select(
        "run_id", "model", "language", "score_raw", "score_json_type", "reasoning", F.md5("input_text").alias("input_md5"),
        "generated_text", "thinking", keyword_text(F.col("keywords")).alias("keywords"),
    )


def cluster_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = place_keywords(requests(_lines(spark, sf_dir)))
    return cluster_table(placed).select("run_id", "line_no", "x", "y", "color", "cluster_label", "cluster_top_keyword", "score_raw")


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(_lines(spark, sf_dir)).withColumn("cluster_label", (F.col("line_no") * 7919 % 20).cast("int"))


def cluster_top_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_keywords(_placed(spark, sf_dir))


def cluster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_table(_placed(spark, sf_dir), highlight_score=3).select("run_id", "line_no", "color", "cluster_label", "cluster_top_keyword")


def color_legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    legend = colour_legend(cluster_table(_placed(spark, sf_dir)))
    return legend.select("color", F.round("average_score", 6).alias("average_score"), "num_rows", "clusters")


QUERIES = {
    "run_summary": run_summary,
    "runs_by_model": runs_by_model,
    "score_distribution": score_distribution,
    "score_counts": sparse_score_counts,
    "cap_per_run": cap_per_run,
    "page_by_score": _paged("desc"),
    "page_by_score_ascending": _paged("asc"),
    "one_page": one_page_of_a_run,
    "page_counts": page_totals,
    "search_rows": search_rows,
    "tolerant_run_scan": tolerant_run_scan,
    "cluster_keywords": cluster_keywords,
    "cluster_top_keyword": cluster_top_keyword,
    "cluster_rows": cluster_rows,
    "color_legend": color_legend,
}

_COMPLETE = """
capped AS (
  SELECT *, count(*) FILTER (WHERE complete) OVER (PARTITION BY run_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM lines),
seen AS (SELECT * FROM capped WHERE before < {cap}),
complete_rows AS (SELECT *, try_cast(score_raw AS DOUBLE) AS number FROM seen WHERE complete)"""
_ALL = """
seen AS (SELECT * FROM lines),
complete_rows AS (SELECT *, try_cast(score_raw AS DOUBLE) AS number FROM seen WHERE complete)"""
_ROWS = f"{fx.RUN_LINES_SQL}, {_ALL}"
_IN_BIN = "score_json_type = 'number' AND number = {b}"
_SUMMARY = f"""{_ROWS},
language_counts AS (SELECT run_id, language, count(*) AS n FROM seen GROUP BY 1, 2),
majority AS (SELECT run_id, arg_min(language, [CAST(10000000 - n AS VARCHAR), language]) AS language FROM language_counts GROUP BY 1),
totals AS (
  SELECT run_id, arg_max(model, line_no) AS model_name, min(file_ts) AS creation_ts FROM seen GROUP BY 1),
bins AS (
  SELECT run_id, count(*) AS num_requests, arg_max(thinking, line_no) AS thinking,
         concat_ws(',', {', '.join(f"count(*) FILTER (WHERE {_IN_BIN.format(b=b)})" for b in range(6))}) AS score_distribution
  FROM complete_rows GROUP BY 1),
summary AS (
  SELECT concat(model_name, '-', language, '-', run_id) AS model_key, model_name, language, run_id AS dataset_id, num_requests, creation_ts,
         strftime(to_timestamp(creation_ts) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS created, thinking, score_distribution
  FROM totals JOIN bins USING (run_id) JOIN majority USING (run_id))"""

_PLACED = f"""{_ROWS},
placed AS (SELECT *, CAST(line_no * 7919 % 20 AS INTEGER) AS cluster_label, coalesce(number, 0) AS sort_score FROM complete_rows),
words AS (SELECT cluster_label, run_id, line_no, unnest(range(len(keywords))) AS position, unnest(keywords) AS keyword FROM placed),
counted AS (SELECT cluster_label, keyword, count(*) AS n, min((run_id, line_no, position)) AS first_seen FROM words GROUP BY 1, 2),
best AS (
  SELECT cluster_label, keyword AS cluster_top_keyword
  FROM (SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY n DESC, first_seen) AS r FROM counted) WHERE r = 1)"""
_SLOT = "((CAST(trunc(sort_score) AS BIGINT) % 6 + 6) % 6)"


def _page_sql(order: str) -> str:
    return f"""
WITH {_ROWS},
numbered AS (
  SELECT run_id, line_no, coalesce(number, 0) AS s, row_number() OVER (PARTITION BY run_id ORDER BY coalesce(number, 0) {order}, line_no) AS sample_no
  FROM complete_rows)
SELECT run_id, line_no, sample_no, (sample_no - 1) // 10 + 1 AS page, {one_decimal_sql('s')} AS score_shown FROM numbered"""


ORACLES = {
    "run_summary": f"WITH {_SUMMARY} SELECT * FROM summary",
    "runs_by_model": f"""
WITH {_SUMMARY}
SELECT model_name, count(*) OVER (PARTITION BY model_name) AS model_runs,
       CAST(sum(num_requests) OVER (PARTITION BY model_name) AS BIGINT) AS model_requests, dataset_id, num_requests FROM summary""",
    "score_distribution": f"""
WITH {_ROWS}, run_ids AS (SELECT DISTINCT run_id FROM complete_rows), grid AS (SELECT run_id, unnest(range(6)) AS score FROM run_ids)
SELECT g.run_id, CAST(g.score AS INTEGER) AS score, count(r.run_id) AS n FROM grid g
LEFT JOIN complete_rows r ON r.run_id = g.run_id AND r.score_json_type = 'number' AND r.number = g.score GROUP BY 1, 2""",
    "score_counts": f"""
WITH {_ROWS}
SELECT run_id, score_json_type = 'number' AS is_number,
       CASE WHEN score_json_type = 'number' THEN printf('%.1f', number) ELSE score_raw END AS score, count(*) AS n
FROM complete_rows GROUP BY 1, 2, 3""",
    "cap_per_run": f"WITH {fx.RUN_LINES_SQL}, {_COMPLETE.format(cap=CAP)} SELECT run_id, line_no, complete FROM seen",
    "page_by_score": _page_sql("DESC"),
    "page_by_score_ascending": _page_sql("ASC"),
    "one_page": f"""
WITH {_ROWS}, numbered AS (
  SELECT run_id, line_no, score_raw, row_number() OVER (ORDER BY coalesce(number, 0) DESC, line_no) AS sample_no FROM complete_rows WHERE run_id = '{SHOWN_RUN}')
SELECT run_id, line_no, score_raw FROM numbered WHERE sample_no BETWEEN 8 AND 14""",
    "page_counts": f"WITH {_ROWS} SELECT run_id, count(*) AS num_requests, CAST(ceil(count(*) / 10.0) AS BIGINT) AS total_pages FROM complete_rows GROUP BY 1",
    "search_rows": f"""
WITH {_ROWS}
SELECT run_id, line_no, len({WORDS.format('input_text')}) AS input_words FROM complete_rows
WHERE contains(lower(reasoning), 'tionan') OR contains(lower(input_text), 'tionan')""",
    "tolerant_run_scan": f"""
WITH {_ROWS}
SELECT run_id, model, language, score_raw, score_json_type, reasoning, md5(input_text) AS input_md5, '' AS generated_text, thinking,
       array_to_string(keywords, ' ') AS keywords FROM complete_rows""",
    "cluster_top_keyword": f"WITH {_PLACED} SELECT cluster_label, cluster_top_keyword FROM best",
    "cluster_rows": f"""
WITH {_PLACED}
SELECT run_id, line_no, CASE WHEN {_SLOT} = 3 THEN '#0000FF' ELSE '#80808020' END AS color, cluster_label, cluster_top_keyword
FROM placed JOIN best USING (cluster_label)""",
    "color_legend": f"""
WITH {_PLACED}, coloured AS (
  SELECT *, CASE {_SLOT} {' '.join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(SCORE_COLOURS))} END AS color,
         concat(cluster_label, ': ', cluster_top_keyword) AS shown FROM placed JOIN best USING (cluster_label))
SELECT color, round(avg(sort_score), 6) AS average_score, count(*) AS num_rows, string_agg(DISTINCT shown, '; ' ORDER BY shown) AS clusters
FROM coloured GROUP BY color""",
}
