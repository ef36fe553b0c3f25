"""The jobs end to end: annotate, filter, re-shard, label, distil, explore."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.text import Tokenizer, run_key_of
from quillsieve.operators.annotate import annotate, annotate_vectors, compute_score, threshold_filter
from quillsieve.operators.clusters import cluster_table, place_keywords
from quillsieve.operators.encoders import DEFAULT_ENCODER, embed_documents
from quillsieve.operators.evaluate import validate
from quillsieve.operators.generation import (
    Responder,
    ask,
    batch_metrics,
    parse_responses,
    prepare,
    resource_papers,
    resume,
    throughput,
)
from quillsieve.operators.heads import Head, save_heads
from quillsieve.operators.layout import INDEX, parity, place_contiguous_shards, validation_rows
from quillsieve.operators.position import read_parquet_indexed, take_rows, with_ordered_index
from quillsieve.operators.runs import pages, requests, run_summaries
from quillsieve.operators.tasks import MAX_TOKENS, TaskSpec, count_words
from quillsieve.operators.training import collect_labels, train_head, trainable
from quillsieve.session import materialise
from quillsieve.sources.readers import read_parquet_folder, read_runs
from quillsieve.sources.writers import DEFAULT_CODEC, threshold_folder, write_annotated, write_results, write_shards


def annotate_corpus(
    spark: SparkSession,
    source: str,
    data_folder: str,
    stats_folder: str | None = None,
    encoder_id: str = DEFAULT_ENCODER,
    heads: Mapping[str, Head] | None = None,
    glob: str = "*.parquet",
    batch_size: int = 1000,
) -> None:
    """Score all documents of a folder and write them, with a metadata-only copy if asked for."""
    scored = annotate(read_parquet_folder(spark, source, glob), encoder_id, heads, batch_size=batch_size)
    scores = [c for c in scored.columns if c.startswith("score_")]
    write_annotated(scored, data_folder, stats_folder, kept_as_is=scores)


class Filtered(NamedTuple):
    """Where kept rows were written, and the rows before and after."""

    folder: str
    rows_before: int
    rows_after: int


def filter_corpus(
    spark: SparkSession,
    name: str,
    config: str,
    split: str,
    out: str,
    head: Head,
    threshold: float = 2,
    num_shards: int = 1,
) -> Filtered:
    """Score a dataset, keep what reaches the threshold, write it by contiguous shard of the input.

    Only kept rows are moved, to the task that writes their stretch of the input in order. The
    rows before are counted by a scan that reads no column; the rows kept are counted by an
    observed metric of the writing stage itself, not by reading the output again. Observed metrics of a
    result stage are merged once per task, also when a task is run again.
    """
    indexed = read_parquet_indexed(spark, f"{name}/{config}/{split}")
    kept = threshold_filter(compute_score(indexed, head), threshold)
    total = indexed.count()
    placed = place_contiguous_shards(kept, total, num_shards).drop(INDEX)
    folder = threshold_folder(out, threshold, config, split)
    written = Observation("filter_corpus")
    placed.observe(written, F.count(F.lit(1)).alias("rows_after")).write.mode("error").partitionBy("shard").parquet(folder)
    return Filtered(folder, total, int(written.get["rows_after"]))


def reshard_corpus(spark: SparkSession, source: str, out: str, num_shards: int, codec: str = DEFAULT_CODEC) -> DataFrame:
    """Rewrite a folder as equal contiguous shards and return the comparison of both.

    The shard of an earlier layout is replaced.
    """
    indexed = read_parquet_indexed(spark, source).drop("shard")
    write_shards(indexed, out, indexed.count(), num_shards, codec)
    return parity(read_parquet_folder(spark, source).drop("shard"), spark.read.parquet(out).drop("shard"))


def label_corpus(
    df: DataFrame,
    task: TaskSpec,
    load_responder: Callable[[], Responder],
    model: str,
    out: str,
    language: str = "arb_Arab",
    num_examples: int | None = None,
    order_by: str = "id",
    batch_size: int = 10,
    max_tokens: int = MAX_TOKENS,
    overwrite: bool = False,
    load_tokenizer: Callable[[], Tokenizer] | None = None,
    on_error: str | None = None,
    slices: int = 16,
) -> DataFrame:
    """Ask for every row not answered yet and append the results to the run of prompt and model.

    Rows are cut into ``slices`` by their id, and each slice's results are appended, then its ids
    recorded, before the next is asked: a failure loses one slice at most, and the next call asks
    only what is missing. Within a slice answers are written before they are parsed and counted,
    so each row is asked once. ``overwrite`` removes the run first. Returns the throughput of
    this call.
    """
    spark = df.sparkSession
    if slices < 1:
        raise ValueError("there is at least one slice")
    if task.kind == "category":
        df = resource_papers(df)
    run_id = run_key_of(task.prompt, model)
    df = df.withColumn("run_id", F.lit(run_id))
    if overwrite:
        for folder in (f"{out}/run_id={run_id}", _finished_folder(out, run_id)):
            _path(spark, folder)[0].delete(_path(spark, folder)[1], True)
    done = _written_ids(spark, out, run_id)
    if num_examples is not None:
        df = take_rows(df, num_examples, [order_by])
    if done is not None:
        # An id that doesn't cast is no id of this input; only one that was null stays null.
        own = F.col("id").try_cast(df.schema["id"].dataType)
        df = resume(df, done.filter(F.col("id").isNull() | own.isNotNull()).select(own.alias("id")))
    count = count_words if load_tokenizer is None else _counter(load_tokenizer)
    ready = prepare(df, task.input_budget(count, max_tokens), load_tokenizer)
    ready = materialise(ready.withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")), "requests", ("_slice",))
    present = sorted(r["_slice"] for r in ready.select("_slice").distinct().collect())
    tokens = "num_generated_tokens" if task.kind == "rewrite" else "num_tokens"
    measures = []
    for number in present or [0]:
        own = ready.filter(F.col("_slice") == number).drop("_slice")
        answered = materialise(ask(own, task, load_responder, batch_size, on_error), "answers")
        results = materialise(parse_responses(answered, task, model, language, load_tokenizer), "results")
        partitions = [c for c in ("run_id", "source_file") if c in results.columns]
        bookkeeping = ("task_no", "batch_no", "elapsed_s")
        unstored = bookkeeping if task.kind == "rewrite" else (*bookkeeping, "num_tokens")
        write_results(results.drop(*unstored), out, partitions)
        results.select(F.col("id").cast("string").alias("id")).write.mode("append").parquet(_finished_folder(out, run_id))
        measures.append(batch_metrics(results, tokens))
    return throughput(reduce(DataFrame.union, measures))


def _finished_folder(out: str, run_id: str) -> str:
    """Table of a run's finished ids; readers of the results skip names that begin so."""
    return f"{out}/_finished/run_id={run_id}"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _counter(load_tokenizer: Callable[[], Tokenizer]) -> Callable[[str], int]:
    tokenizer = load_tokenizer()
    return lambda t: len(tokenizer.encode(t))


def _written_ids(spark: SparkSession, out: str, run_id: str) -> DataFrame | None:
    """Ids that a run has results of; None where it has none yet.

    They come from the table of finished ids, and from those result files only that are as new as
    its last one or newer: a slice whose results were written but not recorded.
    """
    system, results = _path(spark, f"{out}/run_id={run_id}")
    if not system.exists(results):
        return None
    files = spark.read.schema("id string").option("recursiveFileLookup", True)
    finished = _finished_folder(out, run_id)
    if not _path(spark, finished)[0].exists(_path(spark, finished)[1]):
        return files.json(results.toString())
    recorded = spark.read.schema("id string").parquet(finished)
    last = recorded.agg(F.max("_metadata.file_modification_time")).first()[0]
    newer = files.json(results.toString())
    if last is not None:
        newer = newer.filter(F.col("_metadata.file_modification_time") >= F.lit(last))
    return recorded.union(newer.select("id"))


def distil(
    spark: SparkSession,
    runs_folder: str,
    model: str,
    encoder_id: str,
    out: str,
    head_name: str,
    hidden_dim: int = 1024,
    rate: float = 1e-3,
    batch_size: int = 256,
    eval_batch_size: int = 128,
    epochs: int = 1,
    seed: int = 0,
) -> DataFrame:
    """Train a head on a model's labels, save it and return its validation measures."""
    labels = trainable(collect_labels(read_runs(spark, runs_folder), model))
    embedded = materialise(embed_documents(labels, encoder_id, text="input_text"), "vectors")
    head, _ = train_head(embedded.filter("split = 'train'"), head_name, encoder_id, hidden_dim, rate, batch_size, epochs, seed)
    save_heads(spark, out, head)
    # Labels that were left out leave gaps, so batches are cut over the rows that remain.
    numbered = with_ordered_index(validation_rows(embedded).drop("input_text"), [INDEX], name="_kept").drop(INDEX).withColumnRenamed("_kept", INDEX)
    scored = annotate_vectors(numbered, {"predicted": head}, prefix="")
    return validate(scored, "score", "predicted", INDEX, eval_batch_size)


class Explorer:
    """Parsed runs of a folder, written once and then read by every view."""

    def __init__(self, spark: SparkSession, runs_folder: str):
        self.lines = materialise(read_runs(spark, runs_folder), "runs")

    def summaries(self) -> DataFrame:
        return run_summaries(self.lines)

    def pages(self, sort_by: str | None = None, order: str = "desc") -> DataFrame:
        return pages(requests(self.lines), sort_by, order)

    def clusters(self, run_id: str, highlight_score: int | None = None) -> DataFrame:
        own = requests(self.lines.filter(F.col("run_id") == run_id))
        return cluster_table(place_keywords(own), highlight_score)
