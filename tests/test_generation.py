import json
import uuid

import pytest
from pyspark.sql import functions as F

from quillsieve import schemas
from quillsieve.functions.text import run_key_of
from quillsieve.operators.generation import ask, batch_metrics, generate, recorded, rejected_years, resource_papers, resume, throughput
from quillsieve.operators.tasks import RESOURCE_CATEGORY, SCORE, SYNTHESIZE
from quillsieve.plans.jobs import label_corpus
from quillsieve.sources.readers import read_results, read_runs


def docs(spark, n=25):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("u"), "id").alias("url"), F.concat(F.lit("word "), "id").alias("text"))


def answering(answer):
    return lambda: lambda requests: [answer(m[-1]["content"].split()[-1]) for m in requests]


def test_resume_treats_null_ids_as_one_key(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "id string")
    done = spark.createDataFrame([("a",), ("a",)], "id string")
    ids = lambda d: sorted((r.id for r in d.collect()), key=str)
    assert ids(resume(df, done)) == [None, None, "b"]
    assert ids(resume(df, done.union(spark.createDataFrame([(None,)], "id string")))) == ["b"]
    assert ids(resume(df, done.limit(0))) == [None, None, "a", "b"]


def test_papers(spark):
    rows = [("1", "t", "a", "u", "2011"), ("2", "t", "", "u", " 2020 "), ("3", None, "a", "u", "2020"), ("4", "t", None, "u", "2020"), ("5", "t", "a", "u", "2010"), ("6", "t", "a", "u", "n/a"), ("7", "t", "a", "u", "2020.5")]
    papers = spark.createDataFrame(rows, "id string, title string, abstract string, url string, year string")
    assert [(r.id, r.text) for r in resource_papers(papers).orderBy("id").collect()] == [("1", "t a"), ("2", "t ")]
    assert rejected_years(papers).first().rejected_years == 2


def test_failures_follow_the_task(spark):
    broken = answering(lambda w: RuntimeError("down") if w == "3" else json.dumps({"score": 1}))
    rows = {r.id: r for r in generate(docs(spark), SCORE, broken, "m", on_error="default").collect()}
    assert len(rows) == 25
    assert (rows["3"].score, "down" in rows["3"].error, rows["4"].score, rows["4"].error) == (0.0, True, 1.0, None)
    with pytest.raises(Exception, match="down"):
        generate(docs(spark), SCORE, broken, "m").collect()
    papers = docs(spark).withColumns({"title": F.col("text"), "abstract": F.col("text")})
    rows = {r.id: r for r in generate(papers, RESOURCE_CATEGORY, broken, "m").collect()}
    assert (rows["3"].category, "down" in rows["3"].error) == ("", True)


def test_wrong_number_of_answers_is_an_error(spark):
    rows = generate(docs(spark), SCORE, lambda: lambda requests: [], "m", on_error="default").collect()
    assert len(rows) == 25 and all("0 answers" in r.error for r in rows)


def test_batches_are_filled_and_counted(spark, tmp_path):
    sized = lambda: lambda requests: [str(len(requests))] * len(requests)
    asked = ask(docs(spark).withColumn("num_tokens", F.lit(2)).coalesce(1), SCORE, sized, batch_size=10)
    asked.write.parquet(str(tmp_path / "asked"))
    written = spark.read.parquet(str(tmp_path / "asked"))
    assert sorted(r.response for r in written.collect()) == sorted(["10"] * 20 + ["5"] * 5)
    metrics = batch_metrics(written, "num_tokens").orderBy("batch_no").collect()
    assert [(r.num_rows, r.num_tokens) for r in metrics] == [(10, 20), (10, 20), (5, 10)]


def test_throughput_is_the_mean_of_rates(spark):
    batches = spark.createDataFrame([(10, 100, 2.0), (10, 40, 4.0), (5, 9, 0.0)], "num_rows long, num_tokens long, elapsed_s double")
    row = throughput(batches).first()
    assert (row.rows_per_second, row.tokens_per_second, row.total_tokens) == ((5 + 2.5 + 0) / 3, (50 + 10 + 0) / 3, 149)


def test_recorded_answers(spark):
    answers = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "y")], "id string, response string")
    rows = {r.id: (r.response, r.error) for r in recorded(docs(spark, 4), answers).collect()}
    assert rows == {"0": (None, "no recorded answer"), "1": ("x", None), "2": ("y", None), "3": (None, "no recorded answer")}


def test_label_job_resumes_and_overwrites(spark, tmp_path):
    out = str(tmp_path / "runs")
    one = answering(lambda w: json.dumps({"score": 1}))
    two = answering(lambda w: json.dumps({"score": 2}))
    run = lambda responder, **more: label_corpus(docs(spark), SCORE, responder, "m", out, **more)
    results = lambda: sorted((r.id, r.score) for r in spark.read.schema("id string, score double").json(out).collect())
    metrics = run(one, num_examples=10).first()
    assert metrics.total_tokens == 20
    first = results()
    assert len(first) == 10
    run(two, num_examples=None)
    assert len(results()) == 25 and dict(results()) == {**{str(i): 2.0 for i in range(25)}, **dict(first)}
    run(two, num_examples=None)
    assert len(results()) == 25
    run(two, num_examples=None, overwrite=True)
    assert dict(results()) == {str(i): 2.0 for i in range(25)} and len(results()) == 25


def test_a_crash_loses_one_slice_at_most(spark, tmp_path):
    out, asked = str(tmp_path / "runs"), tmp_path / "asked"
    asked.mkdir()

    def responder(fails: bool):
        def load():
            def answer(requests):
                words = [m[-1]["content"].split()[-1] for m in requests]
                if fails and "7" in words:
                    raise RuntimeError("server gone")
                for w in words:
                    (asked / f"{w}-{uuid.uuid4().hex}").touch()
                return [json.dumps({"score": int(w)}) for w in words]

            return answer

        return load

    run = lambda fails: label_corpus(docs(spark), SCORE, responder(fails), "m", out, on_error="fail", slices=10, batch_size=1)
    with pytest.raises(Exception, match="server gone"):
        run(True)
    before = [r.id for r in spark.read.schema("id string").json(out).collect()]
    seen = {p.name for p in asked.iterdir()}
    run(False)
    after = [r.id for r in spark.read.schema("id string").json(out).collect()]
    assert 0 < len(before) < 25 and sorted(after) == sorted(map(str, range(25)))
    again = {p.name.split("-")[0] for p in asked.iterdir() if p.name not in seen}
    assert not again & set(before) and again | set(before) == set(map(str, range(25)))


def test_results_written_but_not_recorded_are_not_asked_again(spark, tmp_path):
    out = str(tmp_path / "runs")
    run = lambda score: label_corpus(docs(spark, 6), SCORE, answering(lambda w: json.dumps({"score": score})), "m", out, slices=2)
    run(1)
    slice_of = F.pmod(F.xxhash64("id"), F.lit(2))
    for part in (tmp_path / "runs" / "_finished").rglob("part-*.parquet"):
        if spark.read.parquet(str(part)).where(slice_of == 1).count():
            part.unlink()
    run(2)
    assert spark.read.json(out).count() == 6


@pytest.mark.parametrize("task, schema", [(SCORE, schemas.SCORE_RESULT), (RESOURCE_CATEGORY, schemas.CATEGORY_RESULT), (SYNTHESIZE, schemas.GENERATION_RESULT)])
def test_results_have_the_documented_columns(spark, tmp_path, task, schema):
    papers = docs(spark, 3).withColumns({"title": F.col("text"), "abstract": F.col("text"), "year": F.lit("2020")})
    label_corpus(papers, task, answering(lambda w: "{}"), "m", str(tmp_path), num_examples=None)
    written = read_results(spark, str(tmp_path), schema)
    assert written.columns == [*schema.fieldNames(), "run_id"]
    assert set(spark.read.json(str(tmp_path)).columns) == set(written.columns)
    produced = generate(papers, task, answering(lambda w: "{}"), "m").schema
    assert all(produced[f.name].dataType == f.dataType for f in schema.fields)
    assert {r.run_id for r in written.collect()} == {run_key_of(task.prompt, "m")}


def test_string_scores_survive_the_result_files(spark, tmp_path):
    label_corpus(docs(spark, 4), SCORE, answering(lambda w: json.dumps({"score": w if w < "2" else int(w)})), "m", str(tmp_path), num_examples=None)
    rows = read_runs(spark, str(tmp_path)).filter("complete").collect()
    assert sorted((r.score_raw, r.score_json_type) for r in rows) == [("0", "string"), ("1", "string"), ("2", "number"), ("3", "number")]


def test_ids_of_another_type_resume(spark, tmp_path):
    numbered = docs(spark, 4).withColumn("id", F.col("id").cast("long"))
    for _ in range(2):
        label_corpus(numbered, SCORE, answering(lambda w: "{}"), "m", str(tmp_path), num_examples=None)
    assert spark.read.json(str(tmp_path)).count() == 4


def test_rewrite_job_writes_by_source_file(spark, tmp_path):
    out = str(tmp_path / "blog")
    rows = docs(spark).withColumn("source_file", F.concat(F.lit("part-"), F.col("id").cast("int") % 2))
    metrics = label_corpus(rows, SYNTHESIZE, answering(lambda w: f"a b {w}"), "m", out, num_examples=None).first()
    assert metrics.total_tokens == 75
    written = spark.read.json(out)
    assert {r.source_file for r in written.select("source_file").distinct().collect()} == {"part-0", "part-1"}
    assert set(written.columns) >= {"text", "id", "url", "input_text", "num_tokens", "model", "num_generated_tokens"}
    assert written.count() == 25


def test_resume_by_bloom_filter_is_exact_with_many_false_hits(spark, monkeypatch):
    import quillsieve.operators.generation as generation

    rows = [(i, f"text {i}") for i in range(3000)] + [(None, "no id")]
    df = spark.createDataFrame(rows, "id long, text string")
    done = spark.createDataFrame([(str(i),) for i in range(0, 3000, 3)] + [("x",)], "id string")
    want = sorted(i for i, _ in rows if i is not None and i % 3) + [None]
    for bits in (64, 1 << 26):
        monkeypatch.setattr(generation, "BLOOM_MAX_BITS", bits)
        got = sorted((r.id for r in resume(df, done).collect()), key=lambda v: (v is None, v))
        assert got == want


def test_bloom_filter_has_no_false_misses(spark):
    from quillsieve.operators.generation import bloom_filter, might_contain

    keys = spark.range(5000).select(F.col("id").alias("k"))
    bitmap = bloom_filter(keys, "k", 1 << 16).scalar()
    probe = spark.range(10000).select((F.col("id") < 5000).alias("member"), might_contain(bitmap, F.col("id"), 1 << 16).alias("hit"))
    counts = {(r.member, r.hit): r["count"] for r in probe.groupBy("member", "hit").count().collect()}
    assert (True, False) not in counts and counts.get((False, True), 0) < 500


def test_resume_moves_no_texts(spark):
    df = spark.range(2000).select("id", F.concat(F.lit("long text "), F.col("id").cast("string")).alias("text"))
    done = spark.range(0, 2000, 2).select(F.col("id"))
    plan = resume(df, done)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("text" in line for line in exchanges)
    assert resume(df, done).count() == 1000


def test_bloom_filter_is_laid_out_in_linear_time(spark):
    from time import perf_counter

    from quillsieve.operators.generation import _mask, _word, bloom_filter

    bits = 1 << 21
    keys = spark.range(50_000).select(F.col("id").alias("k"))
    began = perf_counter()
    bitmap = bloom_filter(keys, "k", bits).first()["bitmap"]
    # A lookup of every word among all words took minutes here.
    assert perf_counter() - began < 60
    wanted = [0] * (bits // 64)
    for row in keys.select(_word(F.col("k"), bits).alias("w"), _mask(F.col("k")).alias("m")).collect():
        wanted[row.w] |= row.m
    assert bitmap == wanted
