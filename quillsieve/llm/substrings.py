"""Substring dedup by suffix trees partitioned by variable-length prefixes.

Suffixes of a document's word list are cut at the depth of a window, so a node at that depth is a
word sequence and the leaves below it are its places. The tree is never held whole:

* suffixes are counted by hashed prefixes, first of one word, then, below those that too many
  suffixes share, of three;
* each suffix belongs to the group of its shortest prefix that few enough share; where even the
  longest is too frequent, suffixes are grouped by the whole window;
* groups are packed, by their exact counts, into bins that fit a task's memory;
* a bin's subtrees are its suffixes in order of their labels (64-bit hashes of the path to the full
  depth, besides the bin): equal labels are one deep node, whose smallest document is its source.

Neighbouring removed windows of a document make up the maximal repeats it shares. A task sends
each window once, with the smallest of its own documents that has it; its others are decided on
the spot, so a passage of any number of documents reaches a bin once per task's share of input.
"""

from __future__ import annotations

import heapq
import math
import struct
import zlib
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.text import evaluated_once
from quillsieve.llm.common import ArrowBatches, encoded, mixed, table, words_of

WINDOW = 13
#: Prefix lengths that are counted in turn, and the hashed cells of each.
PREFIXES = (1, 3)
CELL_BITS = 14
#: Suffixes a bin may have: what one task orders at once, some 50 bytes each while it does.
BIN_SUFFIXES = 2_000_000
#: Suffixes a task gathers before it sends them on by bin.
FLUSH_SUFFIXES = 1_500_000

SPANS = "n_words bigint, n_removed bigint, kept string"


def _factors(window: int) -> np.ndarray:
    return mixed(np.arange(1, window + 1, dtype=np.uint64)) | np.uint64(1)


def _labels(words: list[bytes], lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For every full window of a document the hashes of its first n words, for each n.

    ``lengths`` rise; the last is the window.
    """
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = max(0, len(words) - lengths[-1] + 1)
    total, out = np.zeros(count, np.uint64), []
    for i, factor in enumerate(_factors(lengths[-1])):
        total = total + hashes[i : i + count] * factor
        if i + 1 in lengths:
            out.append(mixed(total))
    return out


def _cells(prefix: np.ndarray) -> np.ndarray:
    return (prefix >> np.uint64(64 - CELL_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Routes:
    """Which bin a suffix belongs to. Its size doesn't depend on the input's."""

    window: int
    tables: tuple[np.ndarray, ...]  # by prefix length the bin of each cell, -1 where too frequent
    first_rest: int  # bins from here on are chosen by the whole window
    bins: int

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each window of a document its label and its bin (-1 while routes are planned)."""
        *prefixes, label = _labels(words, (*PREFIXES[: len(self.tables)], self.window))
        chosen = np.full(len(label), -1, np.int32)
        for cells, prefix in zip(self.tables, prefixes):
            chosen = np.where(chosen < 0, cells[_cells(prefix)], chosen)
        if self.bins > self.first_rest:
            spread = mixed(label) % np.uint64(self.bins - self.first_rest)
            chosen = np.where(chosen < 0, spread.astype(np.int32) + self.first_rest, chosen)
        return label, chosen


def _counted(docs: DataFrame, text_col: str, routes: Routes, length: int) -> np.ndarray:
    """Suffixes without a bin so far, by the cell of their first ``length`` words."""

    def run(batches: ArrowBatches) -> ArrowBatches:
        held = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                if len(words) >= routes.window:
                    prefix = _labels(words, (length, routes.window))[0]
                    if routes.tables:
                        prefix = prefix[routes.of(words)[1] < 0]
                    held += np.bincount(_cells(prefix), minlength=len(held))
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["cell", "n"])

    out = np.zeros(1 << CELL_BITS, np.int64)
    # At most 2 ** CELL_BITS rows, whatever the input.
    for cell, n in docs.select(text_col).mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    return out


def _packed(counts: np.ndarray, most: int, first: int, target: int) -> tuple[np.ndarray, int]:
    """Cells of at most ``most`` suffixes to bins from ``first`` on, each of about ``target``."""
    cells = np.full(len(counts), -1, np.int32)
    light = [c for c in np.argsort(-counts, kind="stable").tolist() if 0 < counts[c] <= most]
    number = max(1, math.ceil(int(counts[light].sum()) / target)) if light else 0
    loads = [(0, first + b) for b in range(number)]
    for c in light:  # the largest first, into the emptiest bin
        load, b = heapq.heappop(loads)
        cells[c] = b
        heapq.heappush(loads, (load + int(counts[c]), b))
    cells[counts == 0] = first if number else -1
    return cells, first + number


def plan_routes(docs: DataFrame, text_col: str = "text", window: int = WINDOW, bin_suffixes: int = BIN_SUFFIXES) -> Routes:
    """Count all suffixes and pack their prefixes into bins.

    A prefix is too frequent if its cell has more than a bin's suffixes. Bins are at least about
    as many as the session's shuffle partitions.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routes, target, rest = Routes(window, (), 0, 0), bin_suffixes, 0
    for length in PREFIXES:
        counts = _counted(docs, text_col, routes, length)
        if not routes.tables:
            target = max(1, min(bin_suffixes, math.ceil(int(counts.sum()) / partitions)))
        cells, bins = _packed(counts, target, routes.bins, target)
        routes = Routes(window, (*routes.tables, cells), bins, bins)
        rest = int(counts[counts > target].sum())
        if not rest:
            break
    return Routes(window, routes.tables, routes.bins, routes.bins + math.ceil(rest / target))


# What tasks send to bins. ``labels`` are a bin's labels document by document, or, in rows of
# kind 1, bit masks of windows already decided; ``counts`` are the windows of each document and
# ``copy`` the number of the flush.
_SENT = "bin int, kind int, copy bigint, ids binary, tags binary, counts binary, labels binary"
# An answer's entry: document, tag, copy, bin and the size of the mask that follows.
_ENTRY = "<qIqiI"
_ENTRY_BYTES = struct.calcsize(_ENTRY)


def _small(numbers: np.ndarray) -> bytes:
    """Whole numbers as bytes of the narrowest width, which stands first."""
    for kind in ("u1", "u2", "u4"):
        if not len(numbers) or numbers.min() >= 0 and numbers.max() <= np.iinfo(kind).max:
            return kind.encode() + numbers.astype("<" + kind).tobytes()
    return b"i8" + numbers.astype("<i8").tobytes()


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<" + raw[:2].decode(), offset=2).astype(np.int64)


def tag_of(text: str) -> int:
    """Tells rows that share an id apart."""
    return zlib.crc32(encoded(text))


class _Flush:
    """Documents gathered by a task, and their rows for the bins."""

    def __init__(self, routes: Routes):
        self.routes, self.docs, self.windows = routes, [], 0

    def add(self, doc_id: int, text: str) -> None:
        words = words_of(text)
        if len(words) >= self.routes.window:
            label, chosen = self.routes.of(words)
            self.docs.append((doc_id, tag_of(text), label, chosen))
            self.windows += len(label)

    def rows(self) -> list[tuple]:
        self.docs.sort(key=lambda d: d[:2])
        ids = np.array([d[0] for d in self.docs], np.int64)
        tags = np.array([d[1] for d in self.docs], np.uint32)
        sizes = np.array([len(d[2]) for d in self.docs], np.int64)
        label = np.concatenate([d[2] for d in self.docs])
        chosen = np.concatenate([d[3] for d in self.docs])
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        self.docs, self.windows = [], 0

        # Documents are in order, so the first of equal labels has the smallest id.
        order = np.argsort(label, kind="stable")
        ordered = label[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        source = ids[doc[order[np.flatnonzero(new)]]][np.cumsum(new) - 1]
        decided = np.empty(len(label), bool)
        decided[order] = ids[doc[order]] > source

        out = []
        hit_docs = np.unique(doc[decided])
        if len(hit_docs):
            ends = np.cumsum(sizes)
            masks = [np.packbits(decided[ends[d] - sizes[d] : ends[d]]) for d in hit_docs]
            bin_of = int(ids[hit_docs[0]]) % max(1, self.routes.bins)
            out.append((bin_of, 1, _small(np.diff(ids[hit_docs], prepend=0)), tags[hit_docs].tobytes(), _small(sizes[hit_docs]), np.concatenate(masks).tobytes()))
        kept = np.flatnonzero(~decided)
        kept = kept[np.argsort(chosen[kept], kind="stable")]
        borders = np.flatnonzero(np.diff(chosen[kept])) + 1
        for part in np.split(kept, borders):
            members, counts = np.unique(doc[part], return_counts=True)
            out.append((int(chosen[part[0]]), 0, _small(np.diff(ids[members], prepend=0)), tags[members].tobytes(), _small(counts), label[part].tobytes()))
        return out


def _sent(docs: DataFrame, id_col: str, text_col: str, routes: Routes) -> DataFrame:
    names = ["bin", "kind", "copy", "ids", "tags", "counts", "labels"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]

    def run(batches: ArrowBatches) -> ArrowBatches:
        flush = _Flush(routes)
        copies = count(TaskContext.get().partitionId() << 32)

        def emitted() -> ArrowBatches:
            if flush.docs:
                copy = next(copies)
                for bin_of, kind, *row in flush.rows():
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((bin_of, kind, copy, *row), kinds)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                flush.add(doc_id.as_py(), text.as_py())
                if flush.windows >= FLUSH_SUFFIXES:
                    yield from emitted()
        yield from emitted()

    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    return known.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _SENT)


def _blocks(bins: int, ids: np.ndarray, tags: np.ndarray, copies: np.ndarray, bin_of: int, masks: list[bytes]) -> pa.RecordBatch:
    """Hits of documents as a row for each block of documents: entries of id, tag, copy, bin and mask."""
    block = (mixed(ids.astype(np.uint64)) % np.uint64(max(1, bins))).astype(np.int64)
    entries: dict[int, list[bytes]] = {}
    for b, i, t, c, m in zip(block.tolist(), ids.tolist(), tags.tolist(), copies.tolist(), masks):
        entries.setdefault(b, []).append(struct.pack(_ENTRY, i, t, c, bin_of, len(m)) + m)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(entries), pa.int32()), pa.array([b"".join(e) for e in entries.values()], pa.binary())], names=["block", "entries"]
    )


def _repeats(rows: list[tuple], bin_of: int, bins: int) -> pa.RecordBatch | None:
    """A bin's subtrees: for each document with a window of a smaller one, which of its windows."""
    ids = np.concatenate([np.cumsum(_wide(r[1])) for r in rows])
    tags = np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows])
    counts = np.concatenate([_wide(r[3]) for r in rows])
    label = np.concatenate([np.frombuffer(r[4], np.uint64) for r in rows])
    copies = np.concatenate([np.full(len(r[2]) // 4, r[0], np.int64) for r in rows])
    owner = np.repeat(np.arange(len(ids)), counts)
    order = np.argsort(label, kind="stable")
    ordered = label[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    by_leaf = ids[owner[order]]
    source = np.repeat(np.minimum.reduceat(by_leaf, starts), np.diff(np.append(starts, len(label))))
    hit = np.empty(len(label), bool)
    hit[order] = by_leaf > source
    members = np.unique(owner[hit])
    if not len(members):
        return None
    ends = np.cumsum(counts)
    masks = [np.packbits(hit[ends[m] - counts[m] : ends[m]]).tobytes() for m in members]
    return _blocks(bins, ids[members], tags[members], copies[members], bin_of, masks)


def _decided(row: tuple, bins: int) -> pa.RecordBatch:
    """A task's own decisions; they stand under bin -1."""
    ids, tags, sizes = np.cumsum(_wide(row[1])), np.frombuffer(row[2], np.uint32), _wide(row[3])
    ends = np.cumsum((sizes + 7) // 8)
    masks = [row[4][e - (n + 7) // 8 : e] for e, n in zip(ends.tolist(), sizes.tolist())]
    return _blocks(bins, ids, tags, np.full(len(ids), row[0], np.int64), -1, masks)


def _hits(sent: DataFrame, bins: int) -> DataFrame:
    """Rows for the bins to (doc_id, marks): a row per document with hits, ``marks`` its entries.

    Bins answer by blocks of documents, so that there are rows as there are documents, not a row
    for each document and bin.
    """

    def search(batches: ArrowBatches) -> ArrowBatches:
        at, rows = None, []
        for batch in batches:
            for bin_of, kind, *row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if kind:
                    yield _decided(row, bins)
                    continue
                if bin_of != at:
                    if rows and (found := _repeats(rows, at, bins)) is not None:
                        yield found
                    at, rows = bin_of, []
                rows.append(row)
        if rows and (found := _repeats(rows, at, bins)) is not None:
            yield found

    def gather(batches: ArrowBatches) -> ArrowBatches:
        def documents(block: list[bytes]) -> pa.RecordBatch:
            # Equal rows have equal hits, but which are decided by a task depends on the other
            # documents of its flush, so masks of one flush only are read together.
            own: dict[int, dict[int, tuple[int, dict[int, bytes]]]] = {}
            for raw in block:
                at = 0
                while at < len(raw):
                    doc_id, tag, copy, bin_of, size = struct.unpack_from(_ENTRY, raw, at)
                    stop = at + _ENTRY_BYTES + size
                    texts = own.setdefault(doc_id, {})
                    if tag not in texts or copy < texts[tag][0]:
                        texts[tag] = (copy, {})
                    if copy == texts[tag][0]:
                        texts[tag][1][bin_of] = raw[at:stop]
                    at = stop
            marks = [b"".join(e for _, entries in texts.values() for e in entries.values()) for texts in own.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array(marks, pa.binary())], names=["doc_id", "marks"])

        at, held = None, []
        for batch in batches:
            for block, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != at:
                    if held:
                        yield documents(held)
                    at, held = block, []
                held.append(entries)
        if held:
            yield documents(held)

    dealt = sent.repartitionById(max(1, bins), F.col("bin")).sortWithinPartitions("bin", "kind")
    blocks = dealt.mapInArrow(search, "block int, entries binary")
    return blocks.repartitionById(max(1, bins), F.col("block")).sortWithinPartitions("block").mapInArrow(gather, "doc_id bigint, marks binary")


def _marks(raw: bytes | None, tag: int) -> list[tuple[int, bytes]]:
    """The (bin, mask) entries of the text with this tag."""
    out, at = [], 0
    while raw and at < len(raw):
        _, own, _, bin_of, size = struct.unpack_from(_ENTRY, raw, at)
        at += _ENTRY_BYTES + size
        if own == tag:
            out.append((bin_of, raw[at - size : at]))
    return out


def removed_words(words: list[bytes], routes: Routes, own: list[tuple[int, bytes]]) -> np.ndarray:
    """Which words of a document its hits (bin, mask) cover."""
    covered = np.zeros(len(words) + 1, np.int64)
    _, chosen = routes.of(words)
    sent = np.ones(len(chosen), bool)
    starts = []
    for bin_of, mask in own:
        if bin_of < 0:
            bits = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(chosen)).astype(bool)
            sent &= ~bits
            starts.append(np.flatnonzero(bits))
    for bin_of, mask in own:
        if bin_of >= 0:
            places = np.flatnonzero(sent & (chosen == bin_of))
            starts.append(places[np.unpackbits(np.frombuffer(mask, np.uint8), count=len(places)).astype(bool)])
    at = np.concatenate(starts)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + routes.window, -1)
    return covered.cumsum()[:-1] > 0


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, out: str = "repeats") -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_removed, kept.

    Removed are the words inside a window whose word sequence also starts in a document with a
    smaller id; ``kept`` are the others joined by one space, null if nothing was removed. Ids are
    whole numbers. Rows with a null id are no document's source and lose nothing; of rows that
    share an id none is the other's source. Null, empty and short texts lose nothing. An
    existing column ``out`` is replaced.

    ``docs`` is read four times and must give the same rows in the same order each time, as a
    stored table does; materialise anything else first. Shuffled are some nine bytes for each
    different window of a task's share, the hits, and once the documents.
    """
    routes = plan_routes(docs, text_col, window)
    own = _hits(_sent(docs, id_col, text_col, routes), routes.bins).toDF("__doc", "__hits")

    @F.arrow_udf(SPANS)
    def apply(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for text, marks in zip(texts, found):
            text, marks = text.as_py(), marks.as_py()
            words = words_of(text)
            marks = _marks(marks, tag_of(text)) if marks and text else []
            if not marks:
                rows.append((len(words), 0, None))
                continue
            gone = removed_words(words, routes, marks)
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode()
            rows.append((len(words), int(gone.sum()), kept))
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["n_words", "n_removed", "kept"])

    plain = docs.drop(out)
    met = plain.join(own, F.col(id_col).cast("long") == F.col("__doc"), "left")
    return met.withColumn(out, evaluated_once(apply)(F.col(text_col), F.col("__hits"))).select(*plain.columns, out)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut from ``text_col``; untouched texts keep their white space.

    Other columns stay as they are; a document all of whose words are repeats has an empty text.
    """
    cut = deduplicated(docs, id_col, text_col, window, "__repeats")
    return cut.withColumn(text_col, F.coalesce(F.col("__repeats.kept"), F.col(text_col))).select(*docs.columns)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spaces = r"[\x20\x09-\x0D]+"
    whole = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), spaces, " "), F.lit(" "))
    return cut.select(
        "doc_id", "repeats.n_words", "repeats.n_removed", F.sha2(F.coalesce("repeats.kept", whole), 256).alias("kept_sha256")
    )


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
ORACLES = {
    "op3_substring_dedup": rf"""
with d as (
    select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
), g as (
    select doc_id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') as win
    from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d)
), hit as (
    select doc_id, i from g qualify doc_id > min(doc_id) over (partition by win)
), gone as (
    select doc_id, list_distinct(flatten(list(range(i, i + {WINDOW})))) as gone_at from hit group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(len(gone_at), 0)::bigint as n_removed,
       sha256(array_to_string(case when gone_at is null then w else list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(gone_at, i)), lambda i: w[i]) end, ' ')) as kept_sha256
from d left join gone using (doc_id)
"""
}
