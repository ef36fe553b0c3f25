import hashlib
import zlib

from pyspark.sql import functions as F

from quillsieve.llm.merkle import manifest, op13_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root string, _mk_g string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row):
    return h(*[field(v) for v in row[:5]])


def runs(nodes, fanout=8):
    return [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]


def tree(nodes, fanout=8):
    """Levels of a list of digests; returns the top and, per start index, its (left, right) steps."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, new_members = [], []
        for r, run in enumerate(runs(nodes, fanout)):
            for k in range(len(run)):
                for leaf_index in members[r * fanout + k]:
                    paths[leaf_index].append(("".join(run[:k]), "".join(run[k + 1 :])))
            parents.append(h(*run))
            new_members.append([x for k in range(len(run)) for x in members[r * fanout + k]])
        nodes, members = parents, new_members
    return nodes[0], paths


def slow(rows, fanout=8):
    """Brute force: per row (doc_id, leaf, subroot, root, proof, folded, verified)."""
    def lang_key(lang):
        return (lang is not None, (lang or "").encode())

    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lang_key)
    subs, inner = [], {}
    for lang in langs:
        group = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        top, paths = tree([leaf_of(r) for r in group], fanout)
        subs.append(top)
        inner[lang] = (group, top, paths)
    root, top_paths = tree(subs, fanout)
    out = []
    for li, lang in enumerate(langs):
        group, sub, paths = inner[lang]
        for row, path in zip(group, paths):
            steps = path + top_paths[li]
            lf = leaf_of(row)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            text = row[4].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if tampered and row[4] is not None else row[4]
            cur = leaf_of((row[0], row[1], row[2], row[3], text))
            for left, right in steps:
                cur = h(left, cur, right)
            out.append((row[0], lf, sub, root, h(*[lr for s in steps for lr in s]), cur, cur == root))
    return sorted(out, key=repr)


ROWS = [
    (i, f"s{i % 3}", ["en", "fr", None, "de", "ÉS", "Z"][i % 6] if i < 150 else "en", i * 3, f"Text {i} ABC é" if i % 7 else None)
    for i in range(200)
] + [
    (5, "s2", "fr", 15, "Text 5 ABC é"),  # a repeated row
    (None, None, "fr", None, "x"),
    (7, "s1", "lone", 1, "Only ONE"),
]


def test_manifest_against_brute_force(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame(ROWS, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{path}/documents.parquet")
    got = sorted((tuple(r) for r in op13_merkle_manifest(spark, path).collect()), key=repr)
    assert got == slow(ROWS)
    assert any(not r[6] for r in got) and any(r[6] for r in got)


def test_small_fanout_many_levels_and_clashing_names(spark):
    rows = [(i, "s", "en" if i % 5 else None, 1, "t") for i in range(70)]
    df = spark.createDataFrame([r + ("x", "y", "z") for r in rows], SCHEMA)
    got = manifest(df, ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id", fanout=2)
    got = got.select("doc_id", "leaf", "subroot", "root", "steps", "_mk_g").collect()
    assert len(got) == 70 and all(r["_mk_g"] == "z" for r in got)
    want = {r[0]: r for r in slow(rows, fanout=2)}
    for r in got:
        assert (r["leaf"], r["subroot"], r["root"]) == want[r["doc_id"]][1:4]


def test_one_row_and_empty(spark):
    one = spark.createDataFrame([(1, None, None, None, None, None, None, None)], SCHEMA)
    r = manifest(one, ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id").collect()[0]
    assert r["leaf"] == r["subroot"] == r["root"] == h("1:1", "-", "-", "-", "-") and r["steps"] == []
    empty = spark.createDataFrame([], SCHEMA)
    assert manifest(empty, ("doc_id", "source", "lang", "n_chars", "text"), "lang", "doc_id").count() == 0


def test_query_on_given_table(spark, sf_dir):
    got = op13_merkle_manifest(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert got.select(F.countDistinct("root")).first()[0] == 1
