import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsieve.llm.quality import RULES, Rule, Text, judge, keep_good, measured, ordered, report
from tests.compare import difference
from tests.llm.data import awkward_texts, docs, no_docs


def slow(text):
    words = (text or "").encode().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def fast(text):
    t = Text(text)
    return t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#| \n\té　", max_size=80))
def test_measures(text):
    assert fast(text) == slow(text)


def test_many_different_words(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=400))
    want = fast(text)
    monkeypatch.setattr("quillsieve.llm.quality._WORD_PACKED", 1)
    assert fast(text) == want


def test_order_is_by_rejections_per_second_and_verdicts_do_not_depend_on_it(spark):
    figures = {"a": (1.0, 0.5), "b": (0.1, 0.2), "c": (1.0, 0.0), "d": (2.0, 1.0)}
    rules = tuple(Rule(n, lambda t: False) for n in "abcd")
    assert [r.name for r in ordered(rules, figures)] == ["b", "a", "d", "c"]
    assert ordered(rules, {}) == rules
    texts = [t for _, t in awkward_texts()]
    for order in (RULES, RULES[::-1]):
        assert [any(r.rejects(Text(t)) for r in order) for t in texts] == [any(r.rejects(Text(t)) for r in RULES) for t in texts]


def test_later_rules_are_not_run():
    ran = []
    rules = (Rule("first", lambda t: True), Rule("second", lambda t: ran.append(t) or True))
    assert next(r.name for r in rules if r.rejects(Text("x"))) == "first" and not ran


def test_sample_is_bounded_and_measured(spark):
    many = docs(spark).select("text").union(docs(spark).select("text"))
    slow_rule = Rule("slow", lambda t: bool(time.sleep(0.002)))
    figures = measured(many, rules=(slow_rule, RULES[0]), rows=10)
    assert figures["slow"][0] > figures["too_short"][0] and figures["slow"][1] == 0.0
    assert measured(no_docs(spark)) == {}


def test_awkward_rows(spark):
    got = judge(docs(spark)).collect()
    assert len(got) == len(awkward_texts())
    verdict = {(r.doc_id, r.text): r.rejected_by is None for r in got}
    assert all(keep == (not any(r.rejects(Text(t)) for r in RULES)) for (_, t), keep in verdict.items())
    kept = keep_good(docs(spark))
    assert kept.columns == docs(spark).columns and kept.count() == sum(r.rejected_by is None for r in got)
    rows = report(docs(spark)).select("text", "quality.*").collect()
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == slow_but_repeats(r.text) for r in rows)
    assert judge(no_docs(spark)).count() == 0


def slow_but_repeats(text):
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    words = (text or "").encode().split()
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines))


def test_labelled_documents(spark, sf_dir):
    """Low-quality documents go; of the others hardly any that passes the base rules does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = report(spark.read.parquet(f"{sf_dir}/documents.parquet"), out="judged").join(labels, "doc_id")
    counts = found.where(~F.col("judged.base_failed")).groupBy("quality").agg(F.avg(F.col("judged.rejected_by").isNull().cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r.kept for r in counts}
    assert kept.get(0, 0.0) == 0.0 and kept[1] > 0.98


def test_query_against_sql(spark, sf_dir):
    assert difference(spark, "op8_quality_rules", sf_dir)[0] is None
