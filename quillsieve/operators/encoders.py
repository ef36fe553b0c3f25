"""Text encoders: what turns a batch of texts into vectors, and the ids they go by."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.text import evaluated_once
from quillsieve.sizing import spread


class Encoder(Protocol):
    def encode(self, texts: list[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class EncoderSpec:
    """How to load an encoder inside a task. ``dim`` is None where only the model file knows it."""

    encoder_id: str
    load: Callable[[], Encoder]
    dim: int | None = None


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(lengths == 0, 1.0, lengths)


class _Slots(dict):
    """Signed dimension of a token, from its md5: ``0..dim-1`` counts up, ``dim..2*dim-1`` down."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, token: str) -> int:
        digest = hashlib.md5(token.encode("utf-8", "surrogatepass")).hexdigest()
        slot = int(digest[:8], 16) % self.dim + self.dim * (int(digest[8], 16) % 2)
        self[token] = slot
        return slot


class HashingEncoder:
    """Signed hashing of lower-cased words, scaled to length one. Needs no model file."""

    #: Tokens remembered by a task before it starts over.
    REMEMBERED = 500_000

    def __init__(self, dim: int):
        self.dim = dim
        self._slots = _Slots(dim)

    def encode(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), self.dim))
        for i, text in enumerate(texts):
            if len(self._slots) > self.REMEMBERED:
                self._slots.clear()
            slots = np.fromiter(map(self._slots.__getitem__, text.lower().split()), dtype=np.int64)
            if slots.size:
                signed = np.bincount(slots, minlength=2 * self.dim)
                counts[i] = signed[: self.dim] - signed[self.dim :]
        return unit_rows(counts)


DEFAULT_ENCODER = "Snowflake/snowflake-arctic-embed-m-v2.0"

# Fixed values: (maximum tokens, normalise) of the known model ids.
KNOWN_MODELS = {
    "Alibaba-NLP/gte-multilingual-base": (8192, True),
    "Snowflake/snowflake-arctic-embed-m-v2.0": (8192, True),
    "jinaai/jina-embeddings-v3": (8192, False),
}
BERT_SETTINGS = (512, True)

_registered: dict[str, EncoderSpec] = {}

#: The user's loader of model files: model id, maximum tokens and whether to normalise, to an encoder.
ModelLoader = Callable[[str, int, bool], Encoder]
_model_loader: list[ModelLoader] = []


def use_model_loader(load: ModelLoader) -> None:
    """Set how known model ids are loaded inside a task; this package brings no model runtime."""
    _model_loader[:] = [load]


def _loading(model_id: str, max_tokens: int, normalise: bool) -> Callable[[], Encoder]:
    if not _model_loader:

        def missing() -> Encoder:
            raise LookupError(f"no loader for {model_id}: call use_model_loader or register_encoder first")

        return missing
    load = _model_loader[0]
    return lambda: load(model_id, max_tokens, normalise)


def register_encoder(encoder_id: str, load: Callable[[], Encoder], dim: int | None = None) -> None:
    """Make an encoder known by id; takes precedence over the built-in ids."""
    _registered[encoder_id] = EncoderSpec(encoder_id, load, dim)


def resolve_encoder(encoder_id: str) -> EncoderSpec:
    """Encoder of an id: registered ones, ``hashing-<dim>``, known models, then any BERT model."""
    if encoder_id in _registered:
        return _registered[encoder_id]
    hashing = re.fullmatch(r"hashing-([1-9]\d*)", encoder_id)
    if hashing:
        dim = int(hashing.group(1))
        return EncoderSpec(encoder_id, lambda: HashingEncoder(dim), dim)
    if encoder_id in KNOWN_MODELS:
        max_tokens, normalise = KNOWN_MODELS[encoder_id]
    elif "bert" in encoder_id.lower():
        max_tokens, normalise = BERT_SETTINGS
    else:
        raise ValueError(f"{encoder_id!r} names no registered, hashing or known encoder")
    return EncoderSpec(encoder_id, _loading(encoder_id, max_tokens, normalise))


def in_batches(texts: pd.Series, size: int) -> Iterator[list[str]]:
    """Texts of an Arrow batch in lists of at most ``size``; null counts as empty."""
    filled = texts.fillna("").tolist()
    for start in range(0, len(filled), size):
        yield filled[start : start + size]


def embedding(text: Column, encoder_id: str, batch_size: int = 1000) -> Column:
    """Vector of each text. The encoder is loaded once per Python task."""
    load = resolve_encoder(encoder_id).load

    @F.pandas_udf("array<double>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            vectors = [row for part in in_batches(texts, batch_size) for row in encoder.encode(part)]
            yield pd.Series(vectors, dtype=object)

    return evaluated_once(embed)(text)


def embed_documents(df: DataFrame, encoder_id: str, text: str = "text", name: str = "embedding", batch_size: int = 1000) -> DataFrame:
    """Add the vector of ``text``."""
    return spread(df).withColumn(name, embedding(F.col(text), encoder_id, batch_size))


def l2_normalised(vector: Column) -> Column:
    """A vector column scaled to length one; a zero vector stays zero."""
    # The finishing step binds the sum, so that it is not worked out again for every element.
    scaled = lambda s: F.transform(vector, lambda x: F.when(s == 0, F.lit(0.0)).otherwise(x / F.sqrt(s)))
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x, scaled)
