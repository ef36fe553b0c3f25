import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsieve.functions import answers
from quillsieve.operators.generation import parse_responses
from quillsieve.operators.tasks import RESOURCE_CATEGORY, SCORE, SYNTHESIZE

quick = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def parse(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.p for r in df.select("i", answers.parse_object("v").alias("p")).orderBy("i").collect()]


def model(raw):
    try:
        value = json.loads(raw)
    except (ValueError, TypeError):
        return None
    return value if isinstance(value, dict) else None


scalars = st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.floats(-9, 9), st.sampled_from(["", "3", "3.5", "x"]))
objects = st.dictionaries(st.sampled_from(["score", "reasoning", "keywords", "category", "note", "id"]), st.one_of(scalars, st.lists(scalars, max_size=2)))
texts = st.one_of(objects.map(json.dumps), objects.map(lambda o: json.dumps(o) + " x"), st.lists(scalars).map(json.dumps), st.text("{}[]\":,1a ", max_size=9))


@quick
@given(st.lists(texts, min_size=1, max_size=40))
def test_parse_follows_the_standard_decoder(spark, values):
    for raw, got in zip(values, parse(spark, values)):
        wanted = model(raw)
        assert got.ok == (wanted is not None)
        if wanted is None:
            continue
        for key in ("score", "reasoning", "keywords", "category"):
            assert got[f"has_{key}"] == (key in wanted)
        if "score" in wanted:
            assert got.score_json_type == answers.json_type(wanted["score"])
            assert got.score_raw == answers.as_text(wanted["score"])
        extra = {k: v for k, v in wanted.items() if k in ("note", "id")}
        assert (json.loads(got.extra) if got.extra else {}) == extra


def test_hard_answers(spark):
    got = parse(spark, ['{"score": 1, "score": 2}', '{"score": NaN}', '{"score": 1} x', "[1]", "3", "", None, '{"keywords": "a b"}', '{"keywords": ""}'])
    assert got[0].score_raw == "2"  # the last of equal keys counts
    assert (got[1].ok, got[1].score_raw, got[1].score_json_type) == (True, "NaN", "number")
    assert [g.ok for g in got[2:7]] == [False] * 5
    assert (got[7].keywords, got[8].keywords) == (["a b"], [])


def ask(spark, responses):
    rows = [(str(i), f"u{i}", "text", "T", "A", 1, r) for i, r in enumerate(responses)]
    df = spark.createDataFrame(rows, "id string, url string, text string, title string, abstract string, num_tokens long, response string")
    return df.withColumn("error", F.lit(None).cast("string"))


def test_merge_null_wins_over_default_and_absent_does_not(spark):
    asked = ask(spark, ['{"score": null, "reasoning": null}', '{"id": "forged", "url": "forged", "model": "m", "new": 1}', "broken", "<think>t</think>{}", "<think>t"])
    rows = parse_responses(asked, SCORE, "m", "ar").orderBy("id").collect()
    assert (rows[0].score, rows[0].score_raw, rows[0].score_json_type, rows[0].reasoning, rows[0].keywords) == (None, None, "null", None, [])
    assert (rows[1].id, rows[1].url, rows[1].score, rows[1].reasoning) == ("1", "u1", 0.0, "")
    assert json.loads(rows[1].extra) == {"id": "forged", "url": "forged", "model": "m", "new": 1}
    assert (rows[2].score, rows[2].thinking, rows[2].keywords, rows[2].error is None) == (0.0, "", [], False)
    assert (rows[3].thinking, rows[3].error) == ("t", None)
    assert (rows[4].thinking, rows[4].error is None) == ("", False)


def test_thinking_of_the_tag_wins_over_the_key(spark):
    row = parse_responses(ask(spark, ['<think>a</think>{"thinking": "b"}']), SCORE, "m").first()
    assert (row.thinking, row.extra) == ("a", None)


def test_category_and_rewrite_rows(spark):
    asked = ask(spark, ['<think>x</think>{"category": "fr"}', "none"])
    rows = parse_responses(asked, RESOURCE_CATEGORY, "m").orderBy("id").collect()
    assert [(r.category, r.reasoning, r.title) for r in rows] == [("fr", "", "T"), ("", "", "T")]
    rows = parse_responses(asked, SYNTHESIZE, "m").orderBy("id").collect()
    assert [(r.text, r.num_generated_tokens) for r in rows] == [('<think>x</think>{"category": "fr"}', 2), ("none", 1)]
    failed = parse_responses(ask(spark, [None]), SYNTHESIZE, "m").first()
    assert (failed.text, failed.num_generated_tokens) == ("", 0)


def test_scores_as_numbers(spark):
    cases = [("3", "number"), ("3.7", "number"), ("-3.7", "number"), ("3", "string"), (" 4 ", "string"), ("3.5", "string"), ("x", "string"), ("NaN", "number"), (None, "null"), ("true", "boolean")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, raw string, kind string")
    raw, kind = F.col("raw"), F.col("kind")
    rows = df.select("i", answers.score_integer(raw, kind).alias("int"), answers.score_number(raw, kind).alias("num"), answers.score_for_sorting(raw, kind).alias("sort")).orderBy("i").collect()
    assert [r.int for r in rows] == [3, 3, -3, 3, 4, None, None, None, None, None]
    assert [r.num for r in rows[:7]] == [3.0, 3.7, -3.7, None, None, None, None]
    assert [r.sort for r in rows[:7]] == [3.0, 3.7, -3.7, 3.0, 4.0, 3.5, 0.0]
