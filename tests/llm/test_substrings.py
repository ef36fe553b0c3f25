import hashlib

import pytest

from quillsieve.llm import substrings
from quillsieve.llm.substrings import deduplicated, without_repeats
from tests.compare import difference
from tests.llm.data import awkward_texts, docs, no_docs, words


def brute(rows, window=13):
    first = {}
    for doc_id, text in rows:
        w = (text or "").encode().split()
        for s in range(len(w) - window + 1):
            if doc_id is not None:
                key = tuple(w[s : s + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[s : s + window])] < doc_id:
                gone.update(range(s, s + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((doc_id, len(w), len(gone), kept if gone else None))
    return sorted(out, key=repr)


def stored(spark, tmp_path, df):
    df.repartition(3, "doc_id").write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


def result(df):
    return sorted(((r.doc_id, *r.repeats) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bin_suffixes, flush", [(2_000_000, 1_500_000), (50, 100), (20, 60), (1, 1)])
def test_awkward_texts_in_large_and_tiny_bins(spark, tmp_path, monkeypatch, bin_suffixes, flush):
    plan = substrings.plan_routes
    monkeypatch.setattr(substrings, "plan_routes", lambda d, t, w: plan(d, t, w, bin_suffixes))
    monkeypatch.setattr(substrings, "FLUSH_SUFFIXES", flush)
    rows = [r for r in awkward_texts() if len(r[1] or "") < 10_000]
    assert result(deduplicated(stored(spark, tmp_path, docs(spark, rows)))) == brute(rows)


def test_whole_fixture_and_empty_table(spark, tmp_path):
    assert result(deduplicated(stored(spark, tmp_path, docs(spark)))) == brute(awkward_texts())
    assert deduplicated(no_docs(spark)).count() == 0


def test_texts_are_cut_and_columns_stay(spark, tmp_path):
    cut = without_repeats(stored(spark, tmp_path, docs(spark)))
    assert cut.columns == docs(spark).columns
    want = {(d, k) for d, _, n, k in brute(awkward_texts()) if n}
    got = {(r.doc_id, r.text) for r in cut.collect()}
    assert want <= got and (6, " \n\t ") in got and (1, "") not in got and (2, "") in got


def test_query_against_sql(spark, sf_dir):
    assert difference(spark, "op3_substring_dedup", sf_dir)[0] is None


def test_kept_digest(spark, sf_dir):
    from quillsieve.llm.substrings import op3_substring_dedup

    row = op3_substring_dedup(spark, sf_dir).where("n_removed = 0").first()
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256(b" ".join(text.encode().split())).hexdigest()


@pytest.mark.parametrize("flush", [1_500_000, 60])
def test_repeated_rows_of_several_tasks(spark, tmp_path, monkeypatch, flush):
    monkeypatch.setattr(substrings, "FLUSH_SUFFIXES", flush)
    plan = substrings.plan_routes
    monkeypatch.setattr(substrings, "plan_routes", lambda d, t, w: plan(d, t, w, 20))
    first, second = words(21, 30), words(22, 30)
    row = (9, " ".join(words(23, 20) + first + words(24, 20) + second + words(25, 20)))
    # The copies lie in different tasks; each but the last stands beside another smaller document.
    tasks = [[(1, " ".join(first)), row], [(2, " ".join(second)), row], [row, row], [row]]
    for rows in tasks:
        docs(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    assert stored.rdd.getNumPartitions() > 1
    assert result(deduplicated(stored)) == brute([r for rows in tasks for r in rows])
