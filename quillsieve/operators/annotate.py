"""Scoring documents with regression heads, and what is kept of the scores."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.functions.text import evaluated_once
from quillsieve.operators.encoders import DEFAULT_ENCODER, EncoderSpec, in_batches, resolve_encoder
from quillsieve.operators.heads import Head, load_heads
from quillsieve.sizing import spread

#: Setting naming the folder of the heads used when none are given.
DEFAULT_HEADS_KEY = "spark.quillsieve.default.heads"


def _check(spec: EncoderSpec, heads: Mapping[str, Head]) -> None:
    if not heads:
        raise ValueError("no regression heads given")
    for name, head in heads.items():
        if spec.dim is not None and head.input_dim != spec.dim:
            raise ValueError(f"head {name} takes {head.input_dim} inputs, encoder {spec.encoder_id} gives {spec.dim}")


def _columns(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _unpacked(df: DataFrame, scores: Column, names: Sequence[str]) -> DataFrame:
    kept = [c for c in df.columns if c not in names]
    packed = df.select(*kept, scores.alias("_scores"))
    return packed.select(*kept, *[F.col("_scores").getField(n).alias(n) for n in names])


def _score_texts(df: DataFrame, text: str, spec: EncoderSpec, outputs: Mapping[str, Head], batch_size: int) -> DataFrame:
    """One trip to Python per row: embed, apply every head, return the scores as a struct."""
    _check(spec, outputs)
    load = spec.load
    sent = df.sparkSession.sparkContext.broadcast(dict(outputs))

    @F.pandas_udf(_columns(list(outputs)))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = load()
        heads = sent.value
        for texts in batches:
            parts = []
            for part in in_batches(texts, batch_size):
                vectors = encoder.encode(part)
                parts.append(pd.DataFrame({name: head.predict(vectors) for name, head in heads.items()}))
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=list(heads), dtype=float)

    return _unpacked(df, evaluated_once(score)(F.col(text)), list(outputs))


def split_conditions(df: DataFrame, where: Sequence[Column | str], outputs: Sequence[str]) -> tuple[list, list]:
    """Conjuncts that need only the input's columns, and those that need what is added.

    A conjunct goes first if it is analysed against the input without the output names, so one
    that names an output, even one that replaces an input column, stays after.
    """
    inputs = df.drop(*outputs)
    before, after = [], []
    for condition in where:
        try:
            inputs.where(condition).schema
            before.append(condition)
        except AnalysisException:
            after.append(condition)
    return before, after


def _filtered(df: DataFrame, conditions: Sequence[Column | str]) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def annotate(
    df: DataFrame,
    encoder_id: str = DEFAULT_ENCODER,
    heads: Mapping[str, Head] | None = None,
    text: str = "text",
    batch_size: int = 1000,
    where: Sequence[Column | str] = (),
) -> DataFrame:
    """Add ``score_<name>`` for every head; each text is embedded once.

    Without heads the saved default ones are used, which fit the default encoder only.
    ``where`` holds conditions the result must meet, one conjunct each. Those on input columns
    are applied before the texts are sent to Python, so they reach the scan as pushed filters
    and rows that fail them are never embedded; those on scores are applied after. The
    Python stage is kept from repeating itself, which also keeps the optimizer from moving
    filters across it, hence the split here.
    """
    if heads is None:
        if encoder_id != DEFAULT_ENCODER:
            raise ValueError(f"No regression heads were given, and the default ones do not fit encoder {encoder_id}.")
        folder = df.sparkSession.conf.get(DEFAULT_HEADS_KEY, None)
        if not folder:
            raise ValueError(f"set {DEFAULT_HEADS_KEY} to the folder of the default heads, or pass heads")
        heads = load_heads(df.sparkSession, folder)
    outputs = {f"score_{name}": head for name, head in heads.items()}
    before, after = split_conditions(df, where, list(outputs))
    scored = _score_texts(spread(_filtered(df, before)), text, resolve_encoder(encoder_id), outputs, batch_size)
    return _filtered(scored, after)


def compute_score(df: DataFrame, head: Head, text: str = "text", batch_size: int = 6144, where: Sequence[Column | str] = ()) -> DataFrame:
    """Add ``score`` from a single head, replacing any column of that name; ``where`` as for ``annotate``."""
    before, after = split_conditions(df, where, ["score"])
    scored = _score_texts(spread(_filtered(df, before)), text, resolve_encoder(head.encoder_id), {"score": head}, batch_size)
    return _filtered(scored, after)


def predict_models(df: DataFrame, heads: Mapping[str, Head], text: str = "text", batch_size: int = 100) -> DataFrame:
    """Add ``<name>_score`` for every model. Heads on the same encoder share one pass."""
    by_encoder: dict[str, dict[str, Head]] = {}
    for name, head in heads.items():
        by_encoder.setdefault(head.encoder_id, {})[f"{name}_score"] = head
    df = spread(df)
    for encoder_id, outputs in by_encoder.items():
        df = _score_texts(df, text, resolve_encoder(encoder_id), outputs, batch_size)
    return df


def annotate_vectors(df: DataFrame, heads: Mapping[str, Head], vector: str = "embedding", prefix: str = "score_", suffix: str = "") -> DataFrame:
    """Add a score per head to rows that already hold their vector."""
    outputs = {f"{prefix}{name}{suffix}": head for name, head in heads.items()}
    sent = df.sparkSession.sparkContext.broadcast(outputs)

    @F.pandas_udf(_columns(list(outputs)))
    def score(vectors: pd.Series) -> pd.DataFrame:
        heads = sent.value
        if not len(vectors):
            return pd.DataFrame(columns=list(heads), dtype=float)
        matrix = np.stack(vectors.to_numpy()).astype(np.float64)
        return pd.DataFrame({name: head.predict(matrix) for name, head in heads.items()})

    return _unpacked(df, evaluated_once(score)(F.col(vector)), list(outputs))


def passes(score: Column, threshold: float = 2) -> Column:
    """Whether a score reaches the threshold. NaN does not, though Spark orders it last."""
    return ~F.isnan(score) & (score >= threshold)


def threshold_filter(df: DataFrame, threshold: float = 2, score: str = "score") -> DataFrame:
    return df.filter(passes(F.col(score), threshold))


def counts_around_filter(df: DataFrame, threshold: float = 2, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Rows before and after the filter, in one pass."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.coalesce(passes(F.col(score), threshold), F.lit(False))).alias("rows_after"),
    )


def _truthy(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.nullif(column, F.lit(""))
    if isinstance(field.dataType, T.BooleanType):
        return F.when(column, column)
    if isinstance(field.dataType, T.NumericType):
        return F.nullif(column, F.lit(0).cast(field.dataType))
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.when(F.size(column) > 0, column)
    return column


def stats_projection(
    df: DataFrame,
    text: str = "text",
    metadata: str = "metadata",
    metadata_keys: Sequence[str] = (),
    kept_as_is: Sequence[str] = (),
) -> DataFrame:
    """Everything but the text, for a metadata-only output.

    Empty and zero top-level fields become null, which the JSON writer leaves out. The named
    keys of the ``metadata`` map become columns and win over a top-level field of that name.
    ``kept_as_is`` are columns that count as metadata already, such as scores: zero is a value.
    """
    values: dict[str, Column] = {}
    for field in df.schema.fields:
        if field.name not in (text, metadata):
            values[field.name] = F.col(field.name) if field.name in kept_as_is else _truthy(field)
    for key in metadata_keys:
        given = F.col(metadata).getItem(key)
        if key in values:
            present = F.coalesce(F.map_contains_key(F.col(metadata), key), F.lit(False))
            given = F.when(present, given).otherwise(values[key].cast("string"))
        values[key] = given
    return df.select(*[column.alias(name) for name, column in values.items()])


def stats_lines(df: DataFrame, text: str = "text", metadata: str = "metadata", kept_as_is: Sequence[str] = ()) -> DataFrame:
    """Everything but the text as one JSON object per row, in ``value``, with every metadata key.

    The keys of a map differ from row to row, so they are merged as JSON, behind the top-level
    fields; a key that both have is written once, as metadata. Null fields are left out.
    """
    shadowed = lambda name: F.coalesce(F.map_contains_key(F.col(metadata), name), F.lit(False))
    values = []
    for field in df.schema.fields:
        if field.name not in (text, metadata):
            value = F.col(field.name) if field.name in kept_as_is else _truthy(field)
            values.append(F.when(~shadowed(field.name), value).alias(field.name))
    inner = lambda json: F.nullif(F.expr(f"substring({json}, 2, length({json}) - 2)"), F.lit(""))
    packed = df.select(F.to_json(F.struct(*values)) if values else F.lit("{}"), F.coalesce(F.to_json(metadata), F.lit("{}"))).toDF("_top", "_meta")
    return packed.select(F.concat(F.lit("{"), F.concat_ws(",", inner("_top"), inner("_meta")), F.lit("}")).alias("value"))
