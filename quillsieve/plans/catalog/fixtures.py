"""Views derived from the given tables by the same rules in Spark and in the checking SQL."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.operators.heads import Head

HEAD_NAMES = ("a", "b", "c")
HIDDEN = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_web_documents(table(spark, sf_dir, "documents"))


def as_web_documents(df: DataFrame) -> DataFrame:
    """Documents with the fields of a web document."""
    return df.selectExpr("*", "doc_id AS id", "concat('doc://', source, '/', doc_id) AS url")


def head(k: int, dim: int = 64, name: str | None = None) -> Head:
    """Head ``k`` by formula, so that SQL can compute with the same weights.

    The part of pi in the last bias keeps scores off the borders of rounding: those of many texts
    are short fractions otherwise.
    """
    h, i = np.arange(HIDDEN)[:, None], np.arange(dim)[None, :]
    units = np.arange(HIDDEN)
    return Head(
        name or HEAD_NAMES[k],
        f"hashing-{dim}",
        (((7 * i + 13 * h + k) % 17) - 8) / 16,
        ((units % 3) - 1) / 10,
        (((units + k) % 5) - 2) / 4,
        k / 2 + math.pi / 20,
    )


def heads(dim: int = 64) -> dict[str, Head]:
    return {HEAD_NAMES[k]: head(k, dim) for k in range(3)}


# SQL of the same heads: weight of input i at hidden unit h, and the sum over hidden units.
def w1(i: str) -> str:
    return f"((((7 * ({i}) + 13 * h + k) % 17) - 8) / 16.0)"


B1 = "(((h % 3) - 1) / 10.0)"
W2 = "((((h + k) % 5) - 2) / 4.0)"
B2 = "({k} / 2.0 + pi() / 20)"


def score_names(prefix: str = "score_") -> str:
    return ", ".join(f"round(max(CASE WHEN k = {k} THEN score END), 6) AS {prefix}{name}" for k, name in enumerate(HEAD_NAMES))


def vector_scores_sql() -> str:
    """``vec_id, k, score`` of the embeddings table."""
    return f"""
hidden AS (
  SELECT vec_id, k, h,
         greatest(0, list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * {w1('i - 1')})) + {B1}) AS v
  FROM embeddings, range(3) t(k), range({HIDDEN}) u(h)),
vector_scores AS (SELECT vec_id, k, sum(v * {W2}) + {B2.format(k="k")} AS score FROM hidden GROUP BY vec_id, k)"""


def embedded_sql(dim: int, text: str = "text", tag: str = "") -> str:
    """``doc_id, dim, v`` of the hashed documents, zero values left out."""
    return f"""
tokens{tag} AS (
  SELECT doc_id, md5(token) AS digest
  FROM (SELECT doc_id, unnest(string_split_regex(lower({text}), '\\s+')) AS token FROM documents) WHERE token <> ''),
counts{tag} AS (
  SELECT doc_id, CAST(CAST('0x' || substr(digest, 1, 8) AS UBIGINT) % {dim} AS INTEGER) AS dim,
         CAST(sum(CASE WHEN CAST('0x' || substr(digest, 9, 1) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END) AS DOUBLE) AS c
  FROM tokens{tag} GROUP BY 1, 2),
embedded{tag} AS (
  SELECT doc_id, dim, c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)) AS v FROM counts{tag} WHERE c <> 0)"""


def document_scores_sql(dim: int = 64, tag: str = "") -> str:
    """``doc_id, k, score`` of all documents."""
    return f"""{embedded_sql(dim, tag=tag)},
sums{tag} AS (
  SELECT doc_id, k, h, sum(v * {w1('dim')}) AS s
  FROM embedded{tag}, range(3) t(k), range({HIDDEN}) u(h) GROUP BY doc_id, k, h),
document_scores{tag} AS (
  SELECT d.doc_id, t.k, sum(greatest(0, coalesce(s.s, 0) + (((u.h % 3) - 1) / 10.0)) * ((((u.h + t.k) % 5) - 2) / 4.0)) + {B2.format(k="t.k")} AS score
  FROM documents d CROSS JOIN range(3) t(k) CROSS JOIN range({HIDDEN}) u(h)
  LEFT JOIN sums{tag} s ON s.doc_id = d.doc_id AND s.k = t.k AND s.h = u.h GROUP BY d.doc_id, t.k)"""


# One model answer per document, its shape by doc_id % 10. Valid in Spark SQL and in DuckDB.
def _object(score: str, reasoning: str = "concat('\"', md5(text), '\"')", keywords: str = "concat('\"keywords\": [\"', lang, '\", \"', source, '\"], ')", more: str = "''") -> str:
    return f"concat('{{', {more}, {keywords}, '\"reasoning\": ', {reasoning}, ', \"score\": ', {score}, '}}')"


_N = "(doc_id % 7)"
RESPONSE = f"""CASE doc_id % 10
  WHEN 0 THEN {_object(_N)}
  WHEN 1 THEN concat('```json', chr(10), {_object(_N)}, chr(10), '```')
  WHEN 2 THEN concat('<think> thought ', doc_id, ' </think>', chr(10), {_object(_N)})
  WHEN 3 THEN concat('<think> never closed ', {_object(_N)})
  WHEN 4 THEN {_object(f"concat('\"', {_N}, '\"')")}
  WHEN 5 THEN {_object(f"concat({_N}, '.5')")}
  WHEN 6 THEN concat('score: ', {_N})
  WHEN 7 THEN concat({_object(_N)}, ' and more')
  WHEN 8 THEN {_object(_N, reasoning="'null'", keywords="''")}
  ELSE {_object(_N, more="concat('\"id\": \"m', doc_id, '\", \"note\": \"n\", ')")} END"""

CATEGORY_NAMES = ("ar", "en", "fr", "ru", "jp", "other", "multi", "none", "zz")
_CATEGORY = "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CATEGORY_NAMES)) + " END"
_CATEGORY_OBJECT = f"concat('{{\"reasoning\": \"', md5(text), '\", \"category\": \"', {_CATEGORY}, '\"}}')"
CATEGORY_RESPONSE = f"""CASE doc_id % 4
  WHEN 0 THEN {_CATEGORY_OBJECT}
  WHEN 1 THEN concat('<think>t</think> ```json ', {_CATEGORY_OBJECT}, '```')
  WHEN 2 THEN concat('category: ', {_CATEGORY})
  ELSE concat('{{\"category\": null, \"year\": ', doc_id % 25, '}}') END"""

# Clean-up of an answer in DuckDB.
_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def cleaned_sql(answer: str = "response") -> str:
    body = (
        f"CASE WHEN contains({answer}, '<think>') THEN CASE WHEN contains({answer}, '</think>') "
        f"THEN {_STRIP.format(f'split_part({answer}, ' + chr(39) + '</think>' + chr(39) + ', 2)')} END ELSE {answer} END"
    )
    first = _STRIP.format(f"replace({body}, '```json', '')")
    return _STRIP.format(f"replace({first}, '```', '')")


def thinking_sql(answer: str = "response") -> str:
    part = f"split_part(split_part({answer}, '<think>', 2), '</think>', 1)"
    return f"CASE WHEN contains({answer}, '<think>') THEN {_STRIP.format(part)} ELSE '' END"


def parsed_sql(source: str) -> str:
    """CTE ``parsed`` from rows with ``response``: adds ``ok``, ``thinking`` and the object ``j``."""
    return f"""
cleaned AS (SELECT *, {cleaned_sql()} AS body, {thinking_sql()} AS thought FROM ({source})),
checked AS (SELECT *, coalesce(json_valid(body), false) AS valid FROM cleaned),
objects AS (SELECT *, CAST(CASE WHEN valid THEN body ELSE '0' END AS JSON) AS j FROM checked),
parsed AS (SELECT *, coalesce(json_type(j) = 'OBJECT', false) AS ok FROM objects)"""


# Papers: title is the first line, the abstract the rest.
PAPER_COLUMNS = """doc_id AS id, split_part(text, chr(10), 1) AS title,
  CASE WHEN doc_id % 11 <> 0 THEN substr(text, length(split_part(text, chr(10), 1)) + 2) END AS abstract,
  concat('doc://', source, '/', doc_id) AS url,
  CASE WHEN doc_id % 37 = 0 THEN 'n/a' ELSE concat('', 2000 + doc_id % 25) END AS year"""


def derived(df: DataFrame, columns: str) -> DataFrame:
    """``df`` with the columns of a SQL list added."""
    return df.sparkSession.sql(f"SELECT *, {columns} FROM {{source_rows}}", source_rows=df)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "documents"), PAPER_COLUMNS)


# Lines of four runs, with scores as a model might write them.
RUN_COLUMNS = """concat('run', doc_id % 4) AS run_id, doc_id AS line_no, concat('model-', (doc_id % 4) % 2) AS model, lang AS language,
  CASE doc_id % 10 WHEN 3 THEN '0' WHEN 6 THEN '0' WHEN 7 THEN '0' WHEN 4 THEN concat('"', doc_id % 7, '"')
    WHEN 5 THEN concat(doc_id % 7, '.5') ELSE concat('', doc_id % 7) END AS score_json,
  CASE WHEN doc_id % 19 <> 0 THEN md5(text) END AS reasoning, text AS input_text,
  CASE WHEN doc_id % 10 = 2 THEN concat('thought ', doc_id) ELSE '' END AS thinking,
  doc_id % 17 = 0 AS broken, doc_id % 23 = 0 AS blank"""

#: The same lines as the explorer must see them, in DuckDB.
RUN_LINES_SQL = f"""
raw_lines AS (SELECT {RUN_COLUMNS}, [lang, source] AS keywords, CAST(1700000000 + 3600 * (doc_id % 4) AS DOUBLE) AS file_ts FROM documents),
lines AS (
  SELECT *, reasoning IS NOT NULL AS complete, replace(score_json, '"', '') AS score_raw,
         CASE WHEN score_json LIKE '"%' THEN 'string' ELSE 'number' END AS score_json_type
  FROM raw_lines WHERE NOT broken AND NOT blank)"""


def raw_run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unparsed result lines ``run_id, line_no, file_ts, value``: some cut off, blank or incomplete."""
    rows = derived(table(spark, sf_dir, "documents"), RUN_COLUMNS).withColumns(
        {"keywords": F.array("lang", "source"), "file_ts": F.expr("1700000000D + 3600 * (doc_id % 4)")}
    )
    # Null fields are left out of the JSON, so a missing reasoning makes an incomplete line.
    rest = F.to_json(F.struct("model", "language", "reasoning", "input_text", "thinking", "keywords"))
    line = F.concat(F.lit('{"score":'), F.col("score_json"), F.lit(","), F.substring(rest, 2, 2**31 - 1))
    cut_off = F.substring(line, F.lit(1), F.length(line) - 1)
    value = F.when(F.col("blank"), F.lit("  ")).when(F.col("broken"), cut_off).otherwise(line)
    return rows.select("run_id", "line_no", "file_ts", value.alias("value"))
