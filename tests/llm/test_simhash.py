import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quillsieve.llm.components import components
from quillsieve.llm.simhash import fingerprint, keep_first, near_duplicates, near_links
from tests.compare import duck
from tests.llm.data import awkward_texts, docs, no_docs

SIGN = 1 << 63


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, max_bits=2):
    """Root of each value, all pairs compared."""
    top = list(range(len(values)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab AB\n\té 😀", max_size=60))
def test_fingerprint_by_bits(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_links_keep_every_class_of_random_and_dense_values(spark):
    dice = random.Random(5)
    centre = dice.getrandbits(64)
    values = {dice.getrandbits(64) for _ in range(200)}
    for low in range(300):  # many values equal in six bytes
        values.add(centre & ~0xFFFF | low * 7)
    for _ in range(200):
        x = dice.choice(sorted(values))
        values.add(x ^ (1 << dice.randrange(64)) ^ (1 << dice.randrange(64)))
    values = sorted(values)
    links = near_links(spark.createDataFrame([(v - (v >= SIGN) * 2 * SIGN,) for v in values], "fp long"))
    assert all(((r.u ^ r.v) % (2 * SIGN)).bit_count() <= 2 for r in links.collect())
    roots = {r.id: r.root for r in components(links).collect()}
    signed = [v - (v >= SIGN) * 2 * SIGN for v in values]
    mine = [roots.get(v, v) for v in signed]
    want = classes(values)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 600)]
    rows = path + star + [(7, 7), (3, 2), (2, 3)]
    got = {r.id: r.root for r in components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 600)}, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_awkward_rows(spark):
    rows = awkward_texts()
    marks = [slow_fingerprint(t) for _, t in rows]
    at = classes(marks)
    least = {}
    for (doc_id, _), c in zip(rows, at):
        if doc_id is not None:
            least[c] = min(least.get(c, doc_id), doc_id)
    want = sorted(((d, m - (m >= SIGN) * 2 * SIGN, least.get(c)) for (d, _), m, c in zip(rows, marks, at)), key=repr)
    got = sorted((tuple(r) for r in near_duplicates(docs(spark)).collect()), key=repr)
    assert got == want
    assert near_duplicates(no_docs(spark)).count() == 0


def test_one_document_of_each_class_stays(spark):
    kept = keep_first(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 4 in ids and 5 not in ids and 6 not in ids
    assert ids.count(None) == 2


def test_query_against_all_pairs(spark, sf_dir):
    from quillsieve.llm.simhash import op2_simhash_near_dedup

    rows = duck(sf_dir).sql("select doc_id, text from documents order by doc_id").fetchall()
    marks = np.array([slow_fingerprint(t) for _, t in rows], np.uint64)
    at = classes([int(x) for x in marks])
    want = {d: (f"{int(m):016x}", rows[c][0]) for (d, _), m, c in zip(rows, marks, at)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op2_simhash_near_dedup(spark, sf_dir).collect()}
    assert got == want
