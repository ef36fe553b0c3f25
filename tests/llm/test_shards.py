import collections
import random
import zlib

import pytest

from quillsieve.llm.shards import op9_histogram_sharding, row_key, shard_by_bytes
from tests.llm.data import DOCS, awkward_texts, docs, no_docs


def checked(rows, shards):
    """Slots are gapless; returns the bytes of each shard."""
    slots, sizes = collections.defaultdict(list), [0] * shards
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += len((r.text or "").encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_sizes_are_as_near_as_rows_allow(spark, shards):
    dice = random.Random(shards)
    rows = [(i, "x" * dice.randint(0, 200)) for i in range(4000)]
    rows += [(10_000 + i, "one text of a third of all rows") for i in range(2000)]
    got = shard_by_bytes(docs(spark, rows).repartition(7), shards).collect()
    sizes = checked(got, shards)
    assert len(got) == len(rows) and {(r.doc_id, r.text) for r in got} == set(rows)
    mean = sum(sizes) / shards
    assert max(abs(s - mean) for s in sizes) <= 216 + 0.002 * mean


def test_awkward_rows(spark):
    got = shard_by_bytes(docs(spark), 5).collect()
    checked(got, 5)
    key = lambda r: repr(tuple(r))
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(awkward_texts(), key=key)
    assert set(shard_by_bytes(docs(spark), 5).columns) == {c.split()[0] for c in DOCS.split(", ")} | {"slot"}
    assert shard_by_bytes(no_docs(spark), 5).count() == 0


def test_same_rows_same_places(spark):
    a = {(r.doc_id, r.text): (r.shard, r.slot) for r in shard_by_bytes(docs(spark).repartition(5), 4).collect()}
    b = {(r.doc_id, r.text): (r.shard, r.slot) for r in shard_by_bytes(docs(spark).coalesce(1), 4).collect()}
    assert {k: v for k, v in a.items() if k[0] != 9} == {k: v for k, v in b.items() if k[0] != 9}


def test_key_has_63_bits(spark):
    df = docs(spark)
    assert df.where(row_key(df.doc_id, df.text) < 0).count() == 0


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op9_histogram_sharding(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 40
