"""Token ids in binary files: one id array a shard, document boundaries as an Elias-Fano list.

A file holds the ids (16 bits each where the vocabulary fits, else 32, little-endian), then the
document keys as an Arrow stream, then the boundaries, then a tail with the sections' sizes. The
index, a table with a row per shard, is what makes a file part of the set.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import ArrowBatches, encoded, table, tasks_for
from quillsieve.llm.elias_fano import EliasFano
from quillsieve.llm.files import attempt_name, opened
from quillsieve.llm.pieces import Chunks
from quillsieve.session import materialise, new_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: Bytes of stored input a shard gets.
SHARD_BYTES = 64 * 1024 * 1024
INDEX = "shard int, file string, n_docs bigint, n_ids bigint"
_TAIL = "<4sBQQQ"
_MAGIC = b"QTOK"
_TEXTS = 256
#: Chunks a task remembers, some 230 bytes each.
REMEMBERED = 1_500_000
#: Chunks tokenised end to end in one call.
_PARTS = 2048
_DOCS_AT_ONCE = 1024


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Chunks, str]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a special token's name inside a text is ordinary text
    kind = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def encode(texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, kind).tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    # A byte-level token has a character for each of its bytes, so lengths tell where a part ends.
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, number in tokenizer.get_vocab().items():
        sizes[number] = len(token)

    def encode_parts(parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(parts), _PARTS):
            block = parts[start : start + _PARTS]
            raw = encode(["".join(block)])[0]
            ends = np.cumsum(sizes[np.frombuffer(raw, kind)])
            stops = np.cumsum([len(encoded(p)) for p in block])
            cut = np.searchsorted(ends, stops)
            if (ends[cut] != stops).any():
                raise ValueError("tokens cross the parts of a text: not a byte-level tokenizer of this kind")
            width = np.dtype(kind).itemsize
            stop = ((cut + 1) * width).tolist()
            out += [raw[a:b] for a, b in zip([0, *stop], stop)]
        return out

    return Chunks(encode, encode_parts, REMEMBERED), kind


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` into files below ``folder`` in ascending order of ``id_col``; returns the index.

    Each document's ids are followed by ``end_id``; null and empty texts have only that. Rows
    with a null id come first; rows that share an id are ordered by their text's hash. The index
    is (shard, file, n_docs, n_ids) with shards in document order, stored as a table in the shared
    folder so that the files are written once. A byte-level tokenizer file is needed, at a path
    every executor can read. An empty table gives an empty index.
    """

    def run(batches: ArrowBatches) -> ArrowBatches:
        chunks, kind = _loaded(tokenizer)
        end = np.array([end_id], kind).tobytes()
        system, path = opened(folder)
        shard, name = attempt_name("tokens", ".tok")
        keys, sizes, sink = [], [], None
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                if sink is None:
                    sink = system.open_output_stream(f"{path}/{name}", compression=None)
                made = chunks.ids([x or "" for x in part.column(1).to_pylist()])
                sink.write(b"".join(x + end for x in made))
                sizes += [len(x) // len(end) + 1 for x in made]
                keys.append(part.column(0))
        if sink is None:
            return
        stream = pa.BufferOutputStream()
        ids = pa.RecordBatch.from_arrays([pa.concat_arrays(keys)], names=[id_col])
        with pa.ipc.new_stream(stream, ids.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(ids)
        packed_keys, bounds = stream.getvalue().to_pybytes(), EliasFano.of(np.cumsum(sizes)).to_bytes()
        total = sum(sizes)
        sink.write(packed_keys + bounds + struct.pack(_TAIL, _MAGIC, len(end), total, len(packed_keys), len(bounds)))
        sink.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "file": [name], "n_docs": [len(sizes)], "n_ids": [total]}
        )

    system, path = opened(folder)
    system.create_dir(path)
    tie = F.xxhash64(text_col)
    dealt = docs.select(id_col, text_col).repartitionByRange(tasks_for(docs, SHARD_BYTES), F.col(id_col), tie)
    ordered = dealt.sortWithinPartitions(F.col(id_col), tie)
    return materialise(ordered.select(id_col, text_col).mapInArrow(run, INDEX), "token-index")


class TokenFile:
    """A token file open for reading: boundaries and keys in memory, ids by range."""

    def __init__(self, folder: str, name: str):
        system, path = opened(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        magic, self.width, self.n_ids, keys, bounds = struct.unpack(_TAIL, self.file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL)))
        if magic != _MAGIC:
            raise ValueError(f"{name} isn't a token file")
        raw = self.file.read_at(keys + bounds, size - struct.calcsize(_TAIL) - bounds - keys)
        self.bounds = EliasFano.from_bytes(raw[keys:])
        self.keys = pa.ipc.open_stream(raw[:keys]).read_all().column(0).combine_chunks()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from position ``start`` up to ``stop`` of the shard."""
        raw = self.file.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, index: int) -> np.ndarray:
        """The ids of one document, its end id included."""
        return self.ids(self.bounds.select(index - 1) if index else 0, self.bounds.select(index))


def read_tokens(index: DataFrame, folder: str, id_col: str, id_type: str, digest_only: bool = False) -> DataFrame:
    """Documents back from the files an index lists: (id_col, start, n_tokens, ids_crc32[, ids]).

    ``start`` counts the ids of all documents before; the checksum is over the ids as
    little-endian 32-bit numbers. A task reads one shard, some documents at a time.
    """
    extra = "" if digest_only else ", ids array<bigint>"
    schema = f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint{extra}"

    def run(batches: ArrowBatches) -> ArrowBatches:
        for batch in batches:
            for row in batch.to_pylist():
                shard = TokenFile(folder, row["file"])
                ends = np.concatenate([[0], shard.bounds.numbers()])
                for at in range(0, len(shard.keys), _DOCS_AT_ONCE):
                    cut = ends[at : at + _DOCS_AT_ONCE + 1]
                    ids = shard.ids(int(cut[0]), int(cut[-1])).astype("<u4")
                    cuts = cut - cut[0]
                    sums = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                    columns = [
                        shard.keys.slice(at, _DOCS_AT_ONCE),
                        pa.array(cut[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(cut), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ]
                    if not digest_only:
                        columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "start", "n_tokens", "ids_crc32"] + ([] if digest_only else ["ids"])
    # A row per shard, so one task can number them all.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = index.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return based.repartition(max(1, index.count()), "shard").select("file", "base").mapInArrow(run, schema)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "tokens")
    index = write_tokens(docs, folder)
    return read_tokens(index, folder, "doc_id", docs.schema["doc_id"].dataType.simpleString(), digest_only=True)


QUERIES = {"op6_token_files": op6_token_files}
ORACLES: dict[str, str] = {}
