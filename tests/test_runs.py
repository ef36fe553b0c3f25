import json
import os

import pytest
from pyspark.sql import functions as F

from quillsieve.operators import runs
from quillsieve.operators.clusters import cluster_table, colour_legend, place_keywords, top_keywords
from quillsieve.plans.jobs import Explorer
from quillsieve.sources.readers import read_runs, run_lines


def line(score, **more):
    row = {"model": "m", "language": "ar", "score": score, "reasoning": "r", "input_text": "text", "thinking": "", "keywords": ["k"], **more}
    return json.dumps({k: v for k, v in row.items() if v != "<missing>"})


def parsed(spark, values, run="r"):
    rows = [(run, i, 1.0, v) for i, v in enumerate(values)]
    return run_lines(spark.createDataFrame(rows, "run_id string, line_no long, file_ts double, value string"))


def test_scan_skips_what_is_no_row(spark):
    lines = parsed(spark, [line(1), "", "   ", "{", "[1]", line(2) + " x", line(3, model="<missing>"), line(4, keywords="<missing>"), line(5, generated_text="g")])
    assert sorted((r.score_raw, r.complete, r.generated_text) for r in lines.collect()) == [("1", True, ""), ("4", False, ""), ("5", True, "g")]


@pytest.mark.parametrize("cap", [1, 3, 5, 100])
def test_cap_counts_complete_rows_only(spark, cap):
    flags = [True, False, True, True, False, True, True, False]
    values = [line(i) if ok else line(i, keywords="<missing>") for i, ok in enumerate(flags)]
    kept = sorted(r.line_no for r in runs.cap_lines(parsed(spark, values), cap).collect())
    wanted, seen = [], 0
    for i, ok in enumerate(flags):
        if seen >= cap:
            break
        wanted.append(i)
        seen += ok
    assert kept == wanted


def test_cap_on_a_long_run_with_many_slots(spark):
    lines = spark.range(5000).select(F.lit("r").alias("run_id"), F.col("id").alias("line_no"), (F.col("id") % 3 != 0).alias("complete"))
    got = runs.cap_lines(lines, 1000).agg(F.count_if("complete"), F.max("line_no")).first()
    assert tuple(got) == (1000, 1499)


def test_nothing_is_capped_unless_asked(spark):
    lines = spark.range(12_000).select(
        F.lit("r").alias("run_id"), F.col("id").alias("line_no"), F.lit(True).alias("complete"), F.lit("1").alias("score_raw"), F.lit("number").alias("score_json_type")
    )
    rows = runs.requests(lines)
    assert rows.count() == 12_000 and runs.page_counts(rows).first().total_pages == 1_200
    assert runs.requests(lines, 10_000).count() == 10_000
    assert [r.line_no for r in runs.one_page(rows, "r", 1_200, "score").collect()] == list(range(11_990, 12_000))


def test_summary(spark):
    values = [line(3), line(3.0), line("3"), line(2.5), line(7), line(0, language="en"), line(1, language="en", keywords="<missing>", model="last")]
    row = runs.run_summaries(parsed(spark, values)).first()
    assert (row.model_key, row.num_requests, row.score_distribution) == ("last-ar-r", 6, [1, 0, 0, 2, 0, 0])
    tied = runs.run_summaries(parsed(spark, [line(1), line(1, language="aa")])).first()
    assert tied.language == "aa"
    assert runs.run_summaries(parsed(spark, [line(1, keywords="<missing>")])).count() == 0


def test_sparse_counts(spark):
    got = {(r.is_number, r.score): r.n for r in runs.score_counts(parsed(spark, [line(3), line(3.0), line("3"), line(2.5)])).collect()}
    assert got == {(True, "3.0"): 2, (False, "3"): 1, (True, "2.5"): 1}


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_are_stable_and_agree(spark, order):
    scores = [3, "2", 1, "x", 3, 2, "3", 0, 5, 2, 2, 3, 1]
    lines = parsed(spark, [line(s) for s in scores])
    number = lambda s: 0.0 if s == "x" else float(s)
    wanted = sorted(range(len(scores)), key=lambda i: number(scores[i]), reverse=order == "desc")
    paged = runs.pages(lines, "score", order, per_page=5).orderBy("sample_no").collect()
    assert [r.line_no for r in paged] == wanted
    assert [r.page for r in paged] == [i // 5 + 1 for i in range(len(scores))]
    assert [r.line_no for r in runs.one_page(lines, "r", 2, "score", order, per_page=5).collect()] == wanted[5:10]
    with pytest.raises(ValueError):
        runs.one_page(lines, "r", 0)


def test_search(spark):
    lines = parsed(spark, [line(1, reasoning="About ÉCOLE"), line(2, input_text="an école"), line(3, reasoning=None), line(4)])
    found = lambda q: sorted(r.score_raw for r in runs.search(lines, q).collect())
    assert (found("École"), found("100%"), found("")) == (["1", "2"], [], ["1", "2", "3", "4"])


def test_run_folders(spark, tmp_path):
    for run, n in (("aaa", 3), ("run_id=bbb", 4)):
        os.makedirs(tmp_path / run)
        name = "results.jsonl" if run == "aaa" else "part-00000.json"
        (tmp_path / run / name).write_text("\n".join(line(i, model=run) for i in range(n)) + "\n")
    (tmp_path / "aaa" / "notes.txt").write_text(line(9))
    explorer = Explorer(spark, str(tmp_path))
    rows = explorer.lines.orderBy("run_id", "line_no").collect()
    assert [(r.run_id, r.score_raw) for r in rows] == [("aaa", "0"), ("aaa", "1"), ("aaa", "2"), ("bbb", "0"), ("bbb", "1"), ("bbb", "2"), ("bbb", "3")]
    assert {r.dataset_id: r.num_requests for r in explorer.summaries().collect()} == {"aaa": 3, "bbb": 4}
    assert explorer.pages().count() == 7


def test_line_order_over_many_splits(spark, tmp_path):
    """A file read by several tasks still gives its lines in order."""
    os.makedirs(tmp_path / "r")
    (tmp_path / "r" / "results.jsonl").write_text("".join(line(i, input_text="x" * 50) + "\n" for i in range(4000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        lines = read_runs(spark, str(tmp_path))
        got = [int(r.score_raw) for r in lines.select("score_raw", "line_no").orderBy("line_no").collect()]
        assert got == list(range(4000))
        assert runs.cap_lines(lines, 700).agg(F.max(F.col("score_raw").cast("int"))).first()[0] == 699
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_clusters(spark):
    words = [["sun"], ["sun", "moon"], ["tax"], ["tax", "law"], ["law"], ["law", "tax"]]
    lines = parsed(spark, [line(i, keywords=k) for i, k in enumerate(words)])
    placed = place_keywords(lines, "hashing-32", num_clusters=2)
    table = cluster_table(placed, highlight_score=2).collect()
    assert len(table) == 6 and {r.cluster_label for r in table} == {0, 1}
    assert {r.score_raw for r in table if r.color == "#0000FF"} == {"2"}
    fixed = lines.withColumn("cluster_label", (F.col("line_no") >= 2).cast("int"))
    best = {r.cluster_label: r.cluster_top_keyword for r in top_keywords(fixed).collect()}
    assert best == {0: "sun", 1: "tax"}  # tax and law are equally frequent, tax is seen first
    legend = colour_legend(cluster_table(fixed)).collect()
    assert [r.average_score for r in legend] == [5.0, 4.0, 3.0, 2.0, 1.0, 0.0]
    assert (legend[0].clusters, legend[-1].clusters, legend[0].average_shown) == ("1: tax", "0: sun", "5.0")


def test_run_lines_are_parsed_in_bounded_parts():
    import json

    import pandas as pd

    from quillsieve.sources import readers

    line = lambda n: json.dumps({"model": "m", "language": "l", "input_text": "x" * n})
    raw = pd.Series([line(readers.PARSED_CHARS // 4) for _ in range(10)] + [None, line(3 * readers.PARSED_CHARS), "", line(1)])
    parts = list(readers.parse_run_line.func(iter([raw, pd.Series([], dtype=object)])))
    assert max(len(part) for part in parts) <= 4
    whole = pd.concat(parts)
    assert len(whole) == len(raw) and list(whole["has_model_language"]) == [bool(r) for r in raw]
