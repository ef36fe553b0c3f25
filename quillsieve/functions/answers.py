"""Strict parsing of a model's JSON answer and its merge with default values.

Spark's JSON functions accept trailing text, null out duplicate keys and coerce types, so the
parse is an Arrow batch function around the standard decoder; everything else is columns.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.functions import text
from quillsieve.schemas import PARSED_ANSWER

_MERGED = ("score", "reasoning", "keywords", "category", "thinking")


def json_type(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(value)]


def as_text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def as_keywords(value: object) -> list[str] | None:
    if value is None:
        return None
    if isinstance(value, list):
        return [as_text(v) for v in value]
    return [as_text(value)] if value != "" else []


def strict_object(raw: str | None) -> dict | None:
    """The JSON object in ``raw``; None for anything else, also for trailing text."""
    try:
        value = json.loads(raw)
    except (TypeError, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _parsed(raw: str | None) -> tuple:
    answer = strict_object(raw)
    if answer is None:
        return (False, None, False, None, None, False, None, False, None, False, None, None)
    extra = {k: v for k, v in answer.items() if k not in _MERGED}
    return (
        True,
        None,
        "score" in answer,
        as_text(answer.get("score")),
        json_type(answer.get("score")) if "score" in answer else None,
        "reasoning" in answer,
        as_text(answer.get("reasoning")),
        "keywords" in answer,
        as_keywords(answer.get("keywords")),
        "category" in answer,
        as_text(answer.get("category")),
        json.dumps(extra, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if extra else None,
    )


@F.pandas_udf(PARSED_ANSWER)
def parse_object(raw: pd.Series) -> pd.DataFrame:
    """Fields of a JSON object; ``ok`` is false where the text is anything else."""
    return pd.DataFrame([_parsed(r) for r in raw], columns=PARSED_ANSWER.fieldNames())


def parse_answer(answer: Column) -> Column:
    """Clean a raw answer and parse it. The thinking part stays outside of Python."""
    return text.evaluated_once(parse_object)(text.answer_body(answer))


def merged(parsed: Column, field: str, default: Column) -> Column:
    """The answer's value where its key is present, even if null, else the default."""
    return F.when(parsed["ok"] & parsed[f"has_{field}"], parsed[field]).otherwise(default)


def merged_score(parsed: Column) -> tuple[Column, Column]:
    """Score as written and its JSON type; ``0`` where the answer has none."""
    present = parsed["ok"] & parsed["has_score"]
    return (
        F.when(present, parsed["score_raw"]).otherwise(F.lit("0")),
        F.when(present, parsed["score_json_type"]).otherwise(F.lit("number")),
    )


def score_number(raw: Column, kind: Column) -> Column:
    """A score the model wrote as a JSON number, else null."""
    return F.when(kind == "number", raw.try_cast("double"))


def score_integer(raw: Column, kind: Column) -> Column:
    """A score as integer: numbers are cut toward zero, strings must be whole; else null."""
    number = raw.try_cast("double")
    whole = F.regexp_like(text.strip(raw), F.lit(r"^[+-]?\d+$"))
    return F.when((kind == "number") & ~F.isnan(number), number.try_cast("long")).when(
        (kind == "string") & whole, text.strip(raw).try_cast("long")
    )


def score_for_sorting(raw: Column, kind: Column) -> Column:
    """A score as a number to sort by: strings are read as numbers, 0 where they are none."""
    number = raw.try_cast("double")
    return F.when(kind.isin("number", "string"), F.coalesce(number, F.lit(0.0))).otherwise(F.lit(0.0))
