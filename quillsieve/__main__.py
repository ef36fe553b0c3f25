"""Command line of the jobs: ``spark-submit -m quillsieve <job> …`` or ``python -m quillsieve <job> …``."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from quillsieve.operators.encoders import DEFAULT_ENCODER
from quillsieve.operators.heads import load_heads
from quillsieve.operators.tasks import MAX_TOKENS, TASKS
from quillsieve.plans import jobs
from quillsieve.session import drop_materialised, tune
from quillsieve.sources.readers import read_papers, read_with_source
from quillsieve.sources.responders import chat_server
from quillsieve.sources.writers import DEFAULT_CODEC


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="quillsieve", description="Corpus quality jobs on Spark")
    commands = main.add_subparsers(dest="job", required=True)

    annotate = commands.add_parser("annotate", help="score documents with regression heads")
    annotate.add_argument("source")
    annotate.add_argument("data_folder")
    annotate.add_argument("--stats-folder")
    annotate.add_argument("--glob", default="*.parquet")
    annotate.add_argument("--encoder", default=DEFAULT_ENCODER)
    annotate.add_argument("--heads", help="folder of saved heads; default ones without")
    annotate.add_argument("--batch-size", type=int, default=1000)

    keep = commands.add_parser("filter", help="keep documents whose score reaches the threshold")
    keep.add_argument("name")
    keep.add_argument("config")
    keep.add_argument("split")
    keep.add_argument("out")
    keep.add_argument("--heads", required=True)
    keep.add_argument("--head", required=True)
    keep.add_argument("--threshold", type=float, default=2)
    keep.add_argument("--num-shards", type=int, default=1)

    reshard = commands.add_parser("reshard", help="rewrite a folder as equal shards and compare")
    reshard.add_argument("source")
    reshard.add_argument("out")
    reshard.add_argument("--num-shards", type=int, default=2)
    reshard.add_argument("--codec", default=DEFAULT_CODEC)

    label = commands.add_parser("label", help="ask a language model about every document")
    label.add_argument("task", choices=sorted(TASKS))
    label.add_argument("source", help="parquet folder, or CSV for papers")
    label.add_argument("out")
    label.add_argument("--model", default="gemma-3-4b-it")
    label.add_argument("--server", default="http://localhost:8787/v1")
    label.add_argument("--responder", help="module:function returning a responder, instead of a server")
    label.add_argument("--language", default="arb_Arab")
    label.add_argument("--num-examples", type=int, help="ask for the first rows only; all without")
    label.add_argument("--batch-size", type=int, default=10)
    label.add_argument("--max-tokens", type=int, default=MAX_TOKENS)
    label.add_argument("--overwrite", action="store_true")
    label.add_argument("--slices", type=int, default=16, help="parts whose results are committed one by one")
    label.add_argument("--single-line", action="store_true", help="no field of the CSV has a line break, so big files can be split")

    distil = commands.add_parser("distil", help="train a head on a model's labels")
    distil.add_argument("runs_folder")
    distil.add_argument("out")
    distil.add_argument("--distilled-model-name", default="gemma-3-27b-it")
    distil.add_argument("--base-model-name", default="UBC-NLP/ARBERT")
    distil.add_argument("--train-batch-size", type=int, default=256)
    distil.add_argument("--eval-batch-size", type=int, default=128)
    distil.add_argument("--epochs", type=int, default=1)

    explore = commands.add_parser("explore", help="list the runs of a folder")
    explore.add_argument("runs_folder")
    return main


def _responder(args: argparse.Namespace):
    if args.responder is None:
        return chat_server(args.server, args.model)
    module, _, function = args.responder.partition(":")
    return getattr(importlib.import_module(module), function)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "annotate":
        heads = load_heads(spark, args.heads) if args.heads else None
        jobs.annotate_corpus(spark, args.source, args.data_folder, args.stats_folder, args.encoder, heads, args.glob, args.batch_size)
    elif args.job == "filter":
        head = load_heads(spark, args.heads, args.head)[args.head]
        kept = jobs.filter_corpus(spark, args.name, args.config, args.split, args.out, head, args.threshold, args.num_shards)
        print(f"{kept.rows_after} of {kept.rows_before} rows in {kept.folder}")
    elif args.job == "reshard":
        jobs.reshard_corpus(spark, args.source, args.out, args.num_shards, args.codec).show(truncate=False)
    elif args.job == "label":
        task = TASKS[args.task]
        rows = read_papers(spark, args.source, multi_line=not args.single_line) if task.kind == "category" else read_with_source(spark, args.source)
        if task.kind == "score":
            rows = rows.drop("source_file")
        jobs.label_corpus(
            rows, task, _responder(args), args.model, args.out, args.language, args.num_examples,
            batch_size=args.batch_size, max_tokens=args.max_tokens, overwrite=args.overwrite, slices=args.slices,
        ).show()
    elif args.job == "distil":
        name = f"{args.base_model_name}@{args.distilled_model_name}".replace("/", "__")
        jobs.distil(
            spark, args.runs_folder, args.distilled_model_name, args.base_model_name, args.out, name,
            batch_size=args.train_batch_size, eval_batch_size=args.eval_batch_size, epochs=args.epochs,
        ).show()
    elif args.job == "explore":
        jobs.Explorer(spark, args.runs_folder).summaries().show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = tune(SparkSession.builder.appName("quillsieve").getOrCreate())
    try:
        run(spark, args)
    finally:
        drop_materialised(spark)


if __name__ == "__main__":
    main()
