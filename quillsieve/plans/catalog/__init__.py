"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillsieve.plans.catalog import annotation, evaluation, generation, layout, runs, texts

_PARTS = (annotation, texts, generation, layout, evaluation, runs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: q for part in _PARTS for n, q in part.QUERIES.items()}
ORACLES: dict[str, str] = {n: sql for part in _PARTS for n, sql in part.ORACLES.items()}
