"""The corpus pipeline: five stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.bpe import decode, encode
from quillsieve.llm.common import table
from quillsieve.llm.decontaminate import drop_contaminated
from quillsieve.llm.quality import keep_good
from quillsieve.llm.simhash import keep_first
from quillsieve.llm.substrings import without_repeats
from quillsieve.session import materialise, tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the cascade rejects; null and short texts go."""
    tune(spark)
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Fingerprints and their distance are those of the operator's query.
    """
    tune(spark)
    return keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages that one with a smaller id has; n_chars follows the text."""
    tune(spark)
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words lie in windows of the benchmark."""
    tune(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of the bytes back from them."""
    tune(spark)
    coded = docs.select("doc_id", encode(F.col("text")).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: Fingerprints and ranked merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; all but the last are stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
