"""Byte-level BPE: ranked merges over the different words of the texts, and decoding by pieces.

The merges run in Python on the executors, not as higher-order functions over a literal map; the
README has the figures.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.text import evaluated_once
from quillsieve.llm.common import encoded, table
from quillsieve.llm.pieces import REMEMBERED, Chunks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Words of more bytes than this keep their candidate merges in a heap.
_LONG = 64
#: Texts handed to the chunk table at once.
_TEXTS = 512


@lru_cache(maxsize=4)
def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    """Piece to rank, which is its id, of a rank file: lines of base64, a space and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(bytes.strip, lines))}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: a known one at once, else neighbours merged by lowest rank, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > _LONG:
        return _merge_long(parts, ranks)
    get = ranks.get
    ahead = [get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best = min((r for r in ahead if r is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        at = ahead.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ahead[at]
        if at < len(ahead):
            ahead[at] = get(parts[at] + parts[at + 1])
        if at:
            ahead[at - 1] = get(parts[at - 1] + parts[at])


def _merge_long(parts: list[bytes | None], ranks: dict[bytes, int]) -> list[int]:
    """The same merges with neighbours as linked lists and candidates in a heap."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapify(heap)
    while heap:
        rank, i, length = heappop(heap)
        if parts[i] is None or (j := after[i]) >= n or len(parts[i]) + len(parts[j]) != length or ranks[parts[i] + parts[j]] != rank:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < n and (r := ranks.get(parts[a] + parts[b])) is not None:
                heappush(heap, (r, a, len(parts[a]) + len(parts[b])))
    return [ranks[p] for p in parts if p is not None]


class _Encoder:
    """Texts to ids as little-endian 32-bit numbers, each different word merged once."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.find, self.words = load_ranks(path), regex.compile(pattern).findall, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED:
            self.words = {}
        out, known = [], self.words
        for text in texts:
            found = self.find(text)
            for word in found:
                if word not in known:
                    known[word] = np.array(merge(encoded(word), self.ranks), np.int32).tobytes()
            out.append(b"".join(map(known.__getitem__, found)))
        return out


@lru_cache(maxsize=2)
def _chunks(path: str, pattern: str) -> Chunks:
    return Chunks(_Encoder(path, pattern))


def encode(text: Column, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Column:
    """array<int> of the ids of a whole text; empty for null and empty texts. No special tokens.

    ``path`` must be readable on every executor. A task remembers a bounded number of words. A
    pattern must part text as the public one does around single spaces and line feeds.
    """

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        made: list[bytes] = []
        for start in range(0, len(texts), _TEXTS):
            made += _chunks(path, pattern).ids([x or "" for x in texts.slice(start, _TEXTS).to_pylist()])
        ends = np.cumsum([0] + [len(x) // 4 for x in made])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(made), np.int32)))

    return evaluated_once(run)(text)


def decode(ids: Column, path: str = RANKS) -> Column:
    """The binary pieces of ids, concatenated; null if an id isn't in the vocabulary.

    One literal array holds the pieces as hex text, so a lookup is an index.
    """
    ranks = load_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    vocabulary = F.split(F.lit(" ".join(p.hex() for p in pieces)), " ")
    parts = F.transform(ids, lambda i: F.get(vocabulary, i))
    known = (F.coalesce(F.array_max(ids), F.lit(0)) < len(pieces)) & (F.coalesce(F.array_min(ids), F.lit(0)) >= 0)
    return F.when(known, F.unhex(F.array_join(parts, "")))


def round_trip(docs: DataFrame, text_col: str = "text", path: str = RANKS) -> DataFrame:
    """``docs`` with ``text_col`` encoded to ids, then decoded from them; other columns as they are.

    Null texts come back empty: they have no ids.
    """
    coded = docs.withColumn("__ids", encode(F.col(text_col), path))
    return coded.withColumn(text_col, F.decode(decode(F.col("__ids"), path), "UTF-8")).drop("__ids")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "documents").select("doc_id", encode(F.col("text")).alias("ids"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLES: dict[str, str] = {}
