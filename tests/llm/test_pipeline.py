import pytest

import corpus_pipeline
from quillsieve.llm.quality import RULES, Text
from quillsieve.session import materialise
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_simhash import classes, slow_fingerprint
from tests.llm.test_substrings import brute as cut


def slow_pipeline(docs, items):
    """(doc_id, text) rows after each stage but the last, by brute force."""
    docs = sorted(docs)
    stages = []
    docs = [(i, t) for i, t in docs if not any(r.rejects(Text(t)) for r in RULES)]
    stages.append(docs)
    at = classes([slow_fingerprint(t) for _, t in docs])
    docs = [d for k, d in enumerate(docs) if at[k] == k]
    stages.append(docs)
    kept = {i: k for i, _, _, k in cut(docs)}
    docs = [(i, t if kept[i] is None else kept[i]) for i, t in docs]
    stages.append(docs)
    bad = {i for i, n, h, _ in contaminated(docs, items) if h and 20 * h >= n}
    docs = [d for d in docs if d[0] not in bad]
    stages.append(docs)
    return stages


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = slow_pipeline([(r.doc_id, r.text) for r in docs.collect()], items)
    columns, now = docs.columns, docs
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want):
        now = materialise(stage(spark, now, sf_dir), name)
        assert now.columns == columns
        assert sorted((r.doc_id, r.text) for r in now.collect()) == rows, name
        assert all(r.n_chars == len(r.text) for r in now.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    assert sorted(r.doc_id for r in last) == [i for i, _ in want[-1]] and all(r.n_tokens == len(r["ids"]) for r in last)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(r.doc_id for r in last)


@pytest.mark.parametrize("index", range(5))
def test_stages_on_awkward_and_empty_tables(spark, sf_dir, tmp_path, index):
    name, stage = corpus_pipeline.STAGES[index]
    rows = [(1, None, "en", None, 0), (None, "a b c", None, "s", 5), (2, "", "en", "s", 0), (3, "word " * 100, "en", "s", 500), (3, "word " * 100, "en", "s", 500)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for k, part in enumerate((rows, [])):
        spark.createDataFrame(part, schema).write.parquet(str(tmp_path / str(k)))
        out = stage(spark, spark.read.parquet(str(tmp_path / str(k))), sf_dir)
        assert out.count() <= len(part)
        if index < 4:
            assert out.columns == [c.split()[0] for c in schema.split(", ")]
