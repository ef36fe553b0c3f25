import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsieve.functions import display, text
from quillsieve.operators.generation import prepare
from quillsieve.operators.tasks import SCORE, TASKS, TRANSLATE, count_words

quick = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def column(spark, values, *columns, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def python_clean(answer):
    """The clean-up in plain Python: (body, thinking), None where it fails."""
    thinking = ""
    if "<think>" in answer:
        thinking = answer.split("<think>")[1].split("</think>")[0].strip()
        if "</think>" not in answer:
            return None, thinking
        answer = answer.split("</think>")[1].strip()
    return answer.replace("```json", "").strip().replace("```", "").strip(), thinking


@quick
@given(st.lists(st.text(alphabet=st.sampled_from("ab " + SPACES + "​"), max_size=12), min_size=1, max_size=30))
def test_strip_and_words_follow_python(spark, values):
    got = column(spark, values, text.strip(F.col("v")), text.words(F.col("v")), text.word_count(F.col("v")))
    assert got == [(v.strip(), v.split(), len(v.split())) for v in values]


PIECES = ["<think>", "</think>", "```json", "```", "{", "}", " ", "\n", "x", " ", "json"]


@quick
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=1, max_size=40))
def test_answer_cleanup_follows_python(spark, values):
    got = column(spark, values, text.answer_body(F.col("v")), text.answer_thinking(F.col("v")))
    assert got == [python_clean(v) for v in values]


def test_answer_cleanup_cases(spark):
    values = [
        "<think>a</think>b</think>c",  # the body ends at the second closing tag
        "<think>a<think>b</think>c",  # the thinking ends at the second opening tag
        "<think>open",
        '{"a": "```json inside```"}',
        "",
    ]
    got = column(spark, values, text.answer_body(F.col("v")), text.answer_thinking(F.col("v")))
    assert got == [("b", "a"), ("c", "a"), (None, "open"), ('{"a": " inside"}', ""), ("", "")]


def test_output_tag(spark):
    values = ["x <output>\n{1}\n</output> <output>2</output>", "none", "<output></output>"]
    assert column(spark, values, text.output_tag(F.col("v"))) == [("{1}",), (None,), ("",)]


def test_truncation_counts_after_the_cut(spark):
    df = spark.createDataFrame([("a b\tc  d",), ("a",), ("  ",), (None,)], "text string")
    assert {tuple(r) for r in prepare(df, 3).collect()} == {("a b c", 3), ("a", 1), ("", 0), (None, 0)}


def test_truncation_with_a_tokenizer_file(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    definition = Tokenizer(models.WordLevel({"[UNK]": 0, "a": 1, "b": 2, "c": 3}, unk_token="[UNK]"))
    definition.pre_tokenizer = pre_tokenizers.Whitespace()
    path = str(tmp_path / "tokenizer.json")
    definition.save(path)
    df = spark.createDataFrame([("a b c a",), ("c",)], "text string")
    rows = {tuple(r) for r in prepare(df, 2, text.file_tokenizer(path)).collect()}
    assert rows == {("a b", 2), ("c", 1)}


def test_budgets():
    assert SCORE.input_budget(count_words, 4096) == 4096 - count_words(SCORE.prompt) - 21 - count_words(SCORE.sample_answer)
    assert TRANSLATE.input_budget(count_words, 4096) == 4096 - count_words(TRANSLATE.prompt) - 21 - 2048
    with pytest.raises(ValueError):
        SCORE.input_budget(count_words, 50)


@pytest.mark.parametrize("task", TASKS.values(), ids=TASKS)
def test_messages_and_run_key(spark, task):
    df = spark.createDataFrame([("txt", "T", "A", "m/1")], "text string, title string, abstract string, model string")
    row = df.select(task.messages().alias("m"), text.run_key(task.prompt, F.col("model")).alias("k")).first()
    body = "Title: T\nAbstract: A" if task.kind == "category" else "txt"
    assert [tuple(m) for m in row.m] == [("system", task.system), ("user", task.prompt + body)]
    assert row.k == hashlib.sha256((task.prompt + "m/1").encode()).hexdigest()[:10]


def test_checkpoint_names(spark):
    df = spark.createDataFrame([("org/base", "lab/llm")], "b string, d string")
    row = df.select(text.checkpoint_name(F.col("b"), F.col("d")).alias("n")).withColumn("m", text.model_of_path(F.concat("n", F.lit("/x.ckpt")))).first()
    assert (row.n, row.m) == ("org__base@lab__llm", "org/base@lab/llm")


@quick
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.floats(-9e18, 9e18), st.integers(-4000, 4000).map(lambda n: n / 20), st.integers(2**44, 2**51).map(lambda n: n / 4)), min_size=1, max_size=200))
def test_one_decimal_follows_python(spark, values):
    got = column(spark, values, display.one_decimal(F.col("v")), kind="double")
    assert [g[0].removeprefix("-") for g in got] == ["%.1f" % abs(v) for v in values]
    assert [g[0] for g, v in zip(got, values) if v < 0] == ["%.1f" % v for v in values if v < 0]


def test_odd_scores_end_no_query(spark):
    odd = [float("nan"), float("inf"), float("-inf"), 1e30, -1e300, None, 2.0]
    x = F.col("v")
    got = column(spark, odd, display.one_decimal(x), display.score_colour(x), display.score_colour(x, 2), kind="double")
    assert [g[0] for g in got] == ["nan", "inf", "-inf", "1" + "0" * 30 + ".0", "-1.0E300.0", None, "2.0"]
    zero = display.SCORE_COLOURS[0]
    assert [g[1] for g in got] == [zero, zero, zero, zero, zero, None, display.SCORE_COLOURS[2]]
    assert [g[2] for g in got] == ["#80808020"] * 6 + ["#0000FF"]


def test_rounding_and_colours(spark):
    values = [2.5, 3.5, -0.5, 5.6, -1.0, 7.2]
    x = F.col("v")
    got = column(spark, values, display.round_half_even(x), display.round_half_even(display.clamp(x, 0, 5)), display.score_colour(x), display.score_colour(x, 1), kind="double")
    assert [g[0] for g in got] == [2.0, 4.0, -0.0, 6.0, -1.0, 7.0]
    assert [g[1] for g in got] == [2.0, 4.0, 0.0, 5.0, 0.0, 5.0]
    assert [g[2] for g in got] == [display.SCORE_COLOURS[int(v) % 6] for v in values]
    assert [g[3] for g in got] == ["#0000FF" if int(v) % 6 == 1 else "#80808020" for v in values]


def test_minute_stamp(spark):
    assert column(spark, [0.0, 1700000000.9], display.minute_stamp(F.col("v")), kind="double") == [("1970-01-01 00:00",), ("2023-11-14 22:13",)]
