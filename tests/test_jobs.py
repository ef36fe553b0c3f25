"""Annotation, guards, sinks, streams, and what the plans look like."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve import sizing
from quillsieve.operators import encoders
from quillsieve.operators.annotate import annotate, counts_around_filter, passes, predict_models, stats_projection, threshold_filter
from quillsieve.operators.generation import ask, resume
from quillsieve.operators.tasks import SCORE
from quillsieve.plans.catalog import QUERIES
from quillsieve.plans.catalog import fixtures as fx
from quillsieve.plans.jobs import annotate_corpus, distil
from quillsieve.sources.readers import read_with_source
from quillsieve.sources.writers import write_parquet
from quillsieve.streaming.incremental import process_files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_threshold_drops_nan_and_null(spark):
    df = spark.createDataFrame([(2.0,), (1.99,), (float("nan"),), (None,), (3.0,)], "score double")
    assert sorted(r.score for r in threshold_filter(df).collect()) == [2.0, 3.0]
    assert tuple(counts_around_filter(df).first()) == (5, 2)


def test_encoder_ids():
    assert encoders.resolve_encoder("hashing-16").dim == 16
    for known in (*encoders.KNOWN_MODELS, "UBC-NLP/ARBERT", "any/BERT-like"):
        assert encoders.resolve_encoder(known).encoder_id == known
    for unknown in ("x", "hashing-0", "hashing-x"):
        with pytest.raises(ValueError, match="names no registered"):
            encoders.resolve_encoder(unknown)
    with pytest.raises(LookupError, match="use_model_loader"):
        encoders.resolve_encoder("any/bert").load()
    encoders.use_model_loader(lambda *how: how)
    assert encoders.resolve_encoder("any/bert").load() == ("any/bert", 512, True)
    encoders._model_loader.clear()


def test_registered_encoder_and_guards(spark):
    class Lengths:
        def encode(self, texts):
            return np.array([[len(t), 1.0] for t in texts])

    encoders.register_encoder("lengths", Lengths, 2)
    df = spark.createDataFrame([("abc",), ("",), (None,)], "text string")
    embedded = encoders.embed_documents(df, "lengths").collect()
    assert sorted(r.embedding for r in embedded) == [[0.0, 1.0], [0.0, 1.0], [3.0, 1.0]]
    with pytest.raises(ValueError, match="inputs"):
        annotate(df, "lengths", fx.heads())
    with pytest.raises(ValueError, match="default"):
        annotate(df, "lengths")
    with pytest.raises(ValueError, match="default.heads"):
        annotate(df)


def test_vectors_have_unit_length_or_are_zero(spark):
    encoder = encoders.HashingEncoder(8)
    vectors = encoder.encode(["a b c a", "", "  "])
    assert np.allclose(np.linalg.norm(vectors, axis=1), [1, 0, 0])
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(encoders.l2_normalised(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_scores_do_not_depend_on_partitions_or_batches(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    one = {r.doc_id: r.score_a for r in annotate(docs.coalesce(1), "hashing-64", fx.heads(), batch_size=7).collect()}
    many = {r.doc_id: r.score_a for r in annotate(docs.repartition(13), "hashing-64", fx.heads()).collect()}
    assert one.keys() == many.keys() and np.allclose(list(one.values()), [many[k] for k in one], atol=1e-12)


def test_stats_projection(spark):
    df = spark.createDataFrame(
        [("1", "t", "", 0, True, {"lang": "ar", "url": "m"}, 0.0), ("2", "t", "u", 5, False, None, 1.0)],
        "id string, text string, url string, n int, flag boolean, metadata map<string,string>, score_x double",
    )
    rows = [json.loads(r) for r in stats_projection(df, metadata_keys=["lang", "url"], kept_as_is=["score_x"]).toJSON().collect()]
    assert rows == [{"id": "1", "url": "m", "flag": True, "score_x": 0.0, "lang": "ar"}, {"id": "2", "url": "u", "n": 5, "score_x": 1.0}]


def test_annotation_job_writes_both_outputs(spark, sf_dir, tmp_path):
    source, data, stats = (str(tmp_path / n) for n in ("in", "data", "stats"))
    fx.table(spark, sf_dir, "documents").write.parquet(source)
    annotate_corpus(spark, source, data, stats, "hashing-64", fx.heads())
    written, meta = spark.read.parquet(data), spark.read.json(stats)
    assert written.count() == meta.count() == spark.read.parquet(source).count()
    assert "text" in written.columns and "text" not in meta.columns and "score_c" in meta.columns


@pytest.mark.parametrize("codec", ["zstd", "gzip", "snappy"])
def test_codecs(spark, tmp_path, codec):
    write_parquet(spark.range(5), str(tmp_path / codec), codec)
    assert spark.read.parquet(str(tmp_path / codec)).count() == 5


def test_distillation_from_run_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    (tmp_path / "runs/r1").mkdir(parents=True)
    with open(tmp_path / "runs/r1/results.jsonl", "w") as f:
        for _ in range(300):
            score = int(rng.integers(0, 7))
            f.write(json.dumps({"model": "m", "language": "ar", "score": score, "input_text": " ".join(["good"] * min(score, 5) + ["bad"] * (5 - min(score, 5)))}) + "\n")
    measures = distil(spark, str(tmp_path / "runs"), "m", "hashing-16", str(tmp_path / "heads"), "h", hidden_dim=16, rate=0.03, batch_size=64, epochs=8).first()
    assert measures.loss < 1.0 and measures.spearman > 0.9
    assert 0 < measures.f1 <= 1


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_dir, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    docs = fx.table(spark, sf_dir, "documents")
    docs.repartition(3).write.parquet(source)
    step = lambda batch: annotate(batch, "hashing-64", fx.heads()).drop("text")
    run = lambda: process_files(spark, source, docs.schema, step, out, checkpoint, key="doc_id", files_per_batch=1).awaitTermination()
    run()
    scores = lambda df: sorted((r.doc_id, round(r.score_a, 9)) for r in df.select("doc_id", "score_a").collect())
    wanted = scores(step(docs))
    assert scores(spark.read.parquet(out)) == wanted
    run()
    docs.coalesce(1).write.mode("append").parquet(source)  # the same documents again in a new file
    run()
    assert scores(spark.read.parquet(out)) == wanted


def folder_tables(spark, root):
    """Tables kept as folders of part files, and one kept as a file."""
    rows = spark.range(6).selectExpr("id AS doc_id", "concat('t', id) AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars")
    rows.repartition(3).write.parquet(f"{root}/documents.parquet")
    rows.coalesce(1).write.parquet(f"{root}/more")
    (part,) = (root / "more").glob("part-*.parquet")
    part.rename(root / "single.parquet")
    for name in ("pages", "conversations", "benchmark"):
        spark.range(2).write.parquet(f"{root}/{name}.parquet")
    return rows


def test_tables_kept_as_folders_are_read_and_counted_by_name(spark, tmp_path):
    root = tmp_path / "in put+1"
    folder_tables(spark, root)
    found = read_with_source(spark, str(root), "documents.parquet").select("doc_id", "source_file")
    assert sorted(tuple(r) for r in found.collect()) == [(i, "documents") for i in range(6)]
    both = read_with_source(spark, str(root), "{documents,single}.parquet").groupBy("source_file").count()
    assert sorted(tuple(r) for r in both.collect()) == [("documents", 6), ("single", 6)]
    counts = sorted(tuple(r) for r in QUERIES["file_rows"](spark, str(root)).collect())
    assert counts == [("benchmark.parquet", 2), ("conversations.parquet", 2), ("documents.parquet", 6), ("pages.parquet", 2)]


def test_streams_take_tables_kept_as_folders(spark, tmp_path):
    root, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rows = folder_tables(spark, root)
    assert sorted(r.doc_id for r in QUERIES["stream_annotate"](spark, str(root)).collect()) == list(range(6))
    run = lambda: process_files(spark, str(root), rows.schema, lambda batch: batch, out, checkpoint, glob="{documents,single}.parquet").awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 12
    rows.write.mode("append").parquet(f"{root}/documents.parquet")  # files added to the folder arrive too
    run()
    run()
    assert spark.read.parquet(out).count() == 18


def test_labelling_streams_take_tables_kept_as_folders(spark, tmp_path):
    folder_tables(spark, tmp_path / "in")
    assert sorted(r.id for r in QUERIES["stream_label"](spark, str(tmp_path / "in")).collect()) == list(range(6))


# Plans


def test_one_python_stage_for_all_heads_and_pushed_filters(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").filter("n_chars > 100")
    text = plan(annotate(docs, "hashing-64", fx.heads()).filter(passes(F.col("score_a"), 0.1)).groupBy("lang").count())
    assert text.count("ArrowEvalPython") == 1
    assert "GreaterThan(n_chars,100)" in text
    assert "source" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_models_on_one_encoder_share_a_stage(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    shared = predict_models(docs, {"x": fx.head(0), "y": fx.head(1)})
    apart = predict_models(docs, {"x": fx.head(0), "y": fx.head(1, 8)})
    assert (plan(shared).count("ArrowEvalPython"), plan(apart).count("ArrowEvalPython")) == (1, 2)


def test_resume_runs_below_the_responder_without_a_shuffle_of_texts(spark, sf_dir):
    docs = fx.documents(spark, sf_dir)
    done = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    asked = ask(resume(docs, done), SCORE, lambda: lambda r: [""] * len(r))
    text = plan(asked)
    # The Bloom filter's exact check of possible hits joins below the Python stage, by broadcast.
    assert text.index("ArrowEvalPython") < text.index("LeftSemi")
    assert "BroadcastHashJoin" in text
    formatted = asked._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = formatted.split("\n\n")
    assert not [n for n in nodes if "Exchange" in n.split("\n")[0] and "text" in n]


def test_sizes_come_from_the_tables_read(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    size = sizing.input_bytes(docs)
    joined = docs.join(docs.select("doc_id"), "doc_id")
    assert 0 < size < 2**30 and sizing.input_bytes(joined) == 2 * size
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")
    assert sizing.input_bytes(unknown) is None
    assert sizing.partitions_for(unknown) == sizing.partitions_for(docs) == ()


def test_broadcast_only_below_its_bound(spark, monkeypatch):
    assert "BroadcastHashJoin" in plan(spark.range(100).join(sizing.small_side(spark.range(10)), "id"))
    for name in ("BROADCAST_ROWS", "BROADCAST_BYTES"):
        with monkeypatch.context() as patch:
            patch.setattr(sizing, name, 1)
            big = sizing.small_side(spark.range(20))
        assert not big._jdf.queryExecution().analyzed().toString().startswith("ResolvedHint")


def test_stream_keeps_keys_as_state_and_recovers_from_a_failed_batch(spark, sf_dir, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.repartition(2).write.parquet(source)
    docs.where("doc_id % 2 = 0").coalesce(1).write.mode("append").parquet(source)  # shared documents
    failing = {"left": 1}

    def step(batch):
        if batch.count() and failing["left"] and len(list((tmp_path / "out").glob("batch_id=*"))) >= 1:
            failing["left"] -= 1
            raise RuntimeError("executor lost")
        return batch.select("doc_id", F.length("text").alias("n"))

    run = lambda: process_files(spark, source, docs.schema, step, out, checkpoint, key="doc_id", files_per_batch=1)
    query = run()
    try:
        query.awaitTermination()
    except Exception:
        pass
    assert failing["left"] == 0
    query = run()
    query.awaitTermination()
    assert any(p["stateOperators"] for p in query.recentProgress)
    got = spark.read.parquet(out)
    assert got.count() == docs.count() == got.select("doc_id").distinct().count()


def test_quoted_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    from quillsieve.sources.readers import read_csv_records

    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "title", "abstract")])
    rows = [(str(i), f'T "{i}"' if i % 3 else "", "line one\nline two\r\n" * (i % 4) + ("" if i % 5 else "a,b")) for i in range(300)]
    path = str(tmp_path / "csv")
    spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    want = sorted(tuple(r) for r in spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        scan = spark.read.option("lineSep", "\n").text(path)
        assert scan.rdd.getNumPartitions() > 5
        got = sorted(tuple(r) for r in read_csv_records(spark, path, schema).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want and len(got) == 300


def test_conditions_on_inputs_go_below_the_python_stage(spark, sf_dir):
    where = [F.col("n_chars") > 100, "lang = 'en'", passes(F.col("score_a"), 0.1)]
    scored = annotate(fx.table(spark, sf_dir, "documents"), "hashing-64", fx.heads(), where=where)
    text = plan(scored)
    assert "GreaterThan(n_chars,100)" in text and "EqualTo(lang,en)" in text
    rows = scored.collect()
    assert rows and all(r.n_chars > 100 and r.lang == "en" and r.score_a >= 0.1 for r in rows)
