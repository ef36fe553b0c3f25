"""SimHash fingerprints, and near-duplicates by an inverted index of their positional bytes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.common import ArrowBatches, encoded, per_batch, table, tasks_for
from quillsieve.llm.components import components
from quillsieve.session import materialise

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Bytes of stored fingerprints whose index rows one task makes.
INDEX_BYTES = 4 * 1024 * 1024
_SEED = 42
#: Groups up to this size compare every pair; larger ones look up each member's neighbours.
_FEW = 24
#: Hashes unpacked into bits at once.
_CHUNK = 16_384


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text, unsigned.

    A-Z become lower case; shingles of words are joined by a space and count as often as they
    occur. A bit is 1 if it is set in over half of the shingles' XXH64. A text of fewer words is
    one shingle; null and a text without words give 0.
    """
    words = [] if text is None else encoded(text).lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), _SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, fp): a row per document, the fingerprint as a signed 64-bit number."""

    def make(ids: pa.Array, texts: pa.Array) -> list:
        made = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
        return [ids, pa.array(made.view(np.int64))]

    kind = docs.schema[id_col].dataType.simpleString()
    return per_batch(docs, f"`{id_col}` {kind}, fp bigint", make, id_col, text_col)


def _near(members: np.ndarray, free: int, max_bits: int) -> list[tuple[int, int]]:
    """Links that span the members within ``max_bits`` of each other, all equal outside ``free``.

    Members are distinct. At most one link fewer than members, however many pairs are near.
    """
    n = len(members)
    if n <= _FEW:
        values = [int(x) for x in members]
        pairs = [(i, j) for i, j in combinations(range(n), 2) if ((values[i] ^ values[j]) & (1 << 64) - 1).bit_count() <= max_bits]
    else:
        order = np.sort(members.view(np.uint64))
        members = order.view(np.int64)
        positions = [b for b in range(64) if free >> b & 1]
        pairs = []
        for size in range(1, max_bits + 1):
            for bits in combinations(positions, size):
                other = order ^ np.uint64(sum(1 << b for b in bits))
                at = np.minimum(np.searchsorted(order, other), n - 1)
                hits = np.nonzero((order[at] == other) & (at > np.arange(n)))[0]
                pairs.extend(zip(hits.tolist(), at[hits].tolist()))
    top = list(range(n))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    links = []
    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            top[max(a, b)] = min(a, b)
            links.append((int(members[i]), int(members[j])))
    return links


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp) to links (u, v) with the components of all pairs within ``max_bits``.

    Two fingerprints that differ in at most ``max_bits`` bits share at least ``8 - max_bits`` of
    their eight positional bytes. The inverted index therefore has a posting list for every set
    of that many byte positions with their values: a pair that shares m bytes meets in as many
    lists as m has subsets of that size, so its tally reaches the guaranteed minimum exactly if it
    meets at all, and other pairs are never made. Each list is then verified bit by bit. Lists of
    single bytes would each hold a 256th of all fingerprints and pair them quadratically.

    A list's members differ in ``max_bits`` bytes only, so it has at most 256 to that power of
    them (65,536 for two), and it gives fewer links than members.
    """
    if not 1 <= max_bits <= 2:
        raise ValueError("1 or 2 bits: longer lists would have no useful bound")
    frees = [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(8), max_bits)]
    signed = [x - (1 << 64) if x >> 63 else x for x in frees]
    lists = F.array(*(F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.lit(~x)).alias("kept")) for i, x in enumerate(signed)))
    posting = (
        distinct.select("fp", F.explode(lists).alias("p"))
        .groupBy("p.at", "p.kept")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
    )

    def verify(batches: ArrowBatches) -> ArrowBatches:
        for batch in batches:
            links = []
            for at, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                links += _near(members.values.to_numpy(zero_copy_only=False).astype(np.int64), frees[at], max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["u", "v"]
            )

    return posting.select("at", "members").mapInArrow(verify, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id_col, fp, component_id) for every row: the smallest id reachable over near fingerprints.

    Equal fingerprints are near, those of texts without words (0) included; copies are joined by
    their fingerprint and never paired. Rows that share an id each keep their own fingerprint.
    Null ids are never the smallest; a component of null ids alone has a null component_id. An
    empty table gives no rows; other columns are not looked at.
    """
    marks = materialise(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    first = marks.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    # Copies are summed up before they are dealt out. A fingerprint becomes as many index rows as it
    # has posting lists, so these tasks are small.
    distinct = first.select("fp").repartition(tasks_for(marks, INDEX_BYTES), "fp")
    roots = components(near_links(distinct, max_bits)).withColumnRenamed("id", "fp")
    linked = materialise(first.join(roots, "fp"), "linked")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    classes = linked.join(least, "root").select("fp", "least_id")
    # One join per row's fingerprint, so that adaptive execution may split a hot one.
    named = first.join(classes, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id"))
    return marks.join(materialise(named, "classes"), "fp").select(id_col, "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest: one document of each group.

    Columns are those of ``docs``. Rows that repeat an id are one document and stay together;
    rows with a null id can't be told apart and stay.
    """
    marks = near_duplicates(docs, id_col, text_col, **options)
    gone = marks.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}
ORACLES: dict[str, str] = {}
