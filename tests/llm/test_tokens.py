import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillsieve.llm.bpe import RANKS, _chunks, decode, encode, load_ranks, merge, round_trip
from quillsieve.llm.elias_fano import EliasFano
from quillsieve.llm.token_files import TOKENIZER, TokenFile, _loaded, read_tokens, write_tokens
from quillsieve.session import new_folder
from tests.llm.data import awkward_texts, docs, no_docs

LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(), special_tokens={})
FAST = Tokenizer.from_file(TOKENIZER)
FAST.encode_special_tokens = True
TEXTS = st.text(alphabet="ab é\n\t'sré😀12.!　\x1c", max_size=80)
EXTRA = ["<|endoftext|> x <|endoftext|>", "  a  b\n\n c\t d", " lead", "trail ", "a\r\nb", "\x1c a \x1d", "é" * 300, "ab" * 4000, "\n", "a\n b"]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_chunks_give_what_the_libraries_give(text):
    assert np.frombuffer(_chunks(RANKS, public_tokenizers.PATTERN).ids([text])[0], np.int32).tolist() == LIBRARY.encode_ordinary(text)
    chunks, kind = _loaded(TOKENIZER)
    assert np.frombuffer(chunks.ids([text])[0], kind).tolist() == FAST.encode(text, add_special_tokens=False).ids


def test_long_words_merge_as_short_ones():
    ranks = load_ranks()
    for word in (b"ab" * 500, "é".encode() * 200, b"a" * 1000, b"the" * 70 + b"!"):
        assert merge(word, ranks) == LIBRARY._encode_single_piece(word)


def test_encode_and_decode_awkward_rows(spark):
    rows = awkward_texts() + [(100 + i, t) for i, t in enumerate(EXTRA)]
    coded = docs(spark, rows).select("doc_id", "text", encode(F.col("text")).alias("ids"))
    for r in coded.select("text", "ids", decode(F.col("ids")).alias("back")).collect():
        assert r["ids"] == LIBRARY.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()
    same = round_trip(docs(spark, rows))
    assert same.columns == docs(spark).columns
    assert {(r.doc_id, r.text) for r in same.collect()} == {(i, t or "") for i, t in rows}


def test_decode_of_unknown_ids_is_null(spark):
    df = spark.createDataFrame([([50256],), ([-1],), ([],), ([0, 1],)], "ids array<int>")
    assert [r.b if r.b is None else bytes(r.b) for r in df.select(decode(F.col("ids")).alias("b")).collect()] == [None, None, b"", b'!"']


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
@pytest.mark.parametrize("step", [1, 2, 100, 10**6])
def test_elias_fano(n, step):
    numbers = np.cumsum(np.random.default_rng(n + step).integers(0, step, n))
    made = EliasFano.from_bytes(EliasFano.of(numbers).to_bytes())
    assert (made.numbers() == numbers).all()
    assert [made.select(i) for i in range(0, n, 7)] == numbers[::7].tolist()
    if n == 3000:
        assert len(made.to_bytes()) * 8 < n * (3.2 + max(0, np.log2(step)))
    with pytest.raises(IndexError):
        made.select(n)


def test_files_of_awkward_rows(spark):
    rows = awkward_texts() + [(100 + i, t) for i, t in enumerate(EXTRA)]
    folder = new_folder(spark, "tokens")
    index = write_tokens(docs(spark, rows), folder)
    got = read_tokens(index, folder, "doc_id", "bigint").collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        ids = FAST.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    start, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and (r.n_tokens, r.ids_crc32, r["ids"]) in want[r.doc_id]
        assert last is None or last <= r.doc_id
        start, last = start + r.n_tokens, r.doc_id if r.doc_id is not None else last
    first = index.orderBy("shard").first()
    shard = TokenFile(folder, first.file)
    assert [len(shard.document(i)) for i in range(first.n_docs)] == np.diff([0, *shard.bounds.numbers()]).tolist()


def test_empty_table_has_no_files(spark):
    folder = new_folder(spark, "tokens")
    index = write_tokens(no_docs(spark), folder)
    assert index.count() == 0 and read_tokens(index, folder, "doc_id", "bigint").count() == 0


def test_queries_against_the_libraries(spark, sf_dir):
    from quillsieve.llm.bpe import op7_byte_bpe
    from quillsieve.llm.token_files import op6_token_files

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    start, want6, want7 = 0, {}, {}
    for i in sorted(texts):
        ids = FAST.encode(texts[i], add_special_tokens=False).ids + [2]
        want6[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        ids = LIBRARY.encode_ordinary(texts[i])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want7[i] = (len(ids), digest, hashlib.sha256(texts[i].encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in op6_token_files(spark, sf_dir).collect()} == want6
    assert {r.doc_id: tuple(r)[1:] for r in op7_byte_bpe(spark, sf_dir).collect()} == want7
