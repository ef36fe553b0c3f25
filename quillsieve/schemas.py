"""Row shapes shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _I, _B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


KEYWORDS = T.ArrayType(_S)

WEB_DOC = _struct(id=_S, url=_S, text=_S)
PAPER = _struct(id=_S, title=_S, abstract=_S, url=_S, year=_S)

MESSAGE = _struct(role=_S, content=_S)

#: A parsed answer. ``has_*`` tells a key holding null from a key that is missing.
PARSED_ANSWER = _struct(
    ok=_B,
    thinking=_S,
    has_score=_B,
    score_raw=_S,
    score_json_type=_S,
    has_reasoning=_B,
    reasoning=_S,
    has_keywords=_B,
    keywords=KEYWORDS,
    has_category=_B,
    category=_S,
    extra=_S,
)

SCORE_RESULT = _struct(
    score=_D, score_raw=_S, score_json_type=_S, reasoning=_S, keywords=KEYWORDS, thinking=_S,
    id=_S, url=_S, input_text=_S, model=_S, language=_S, extra=_S, error=_S,
)
CATEGORY_RESULT = _struct(
    id=_S, title=_S, abstract=_S, url=_S, reasoning=_S, category=_S, extra=_S, error=_S,
)
GENERATION_RESULT = _struct(
    text=_S, id=_S, url=_S, input_text=_S, num_tokens=_L, model=_S, num_generated_tokens=_L, error=_S,
)

#: One line of a run's result file after tolerant parsing.
RUN_LINE = _struct(
    has_model_language=_B,
    has_thinking=_B,
    complete=_B,
    model=_S,
    language=_S,
    score_raw=_S,
    score_json_type=_S,
    reasoning=_S,
    input_text=_S,
    generated_text=_S,
    thinking=_S,
    keywords=KEYWORDS,
)

#: Weights of a head, one row per row of a layer's matrix.
HEAD_WEIGHTS = _struct(
    head=_S, encoder_id=_S, input_dim=_I, hidden_dim=_I, layer=_I, row=_I, weights=T.ArrayType(_D), bias=_D,
)
