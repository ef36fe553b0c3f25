import hashlib
import re
import string

import pytest

from quillsieve.llm.decontaminate import WORDS, contamination, drop_contaminated, is_contaminated
from tests.compare import difference
from tests.llm.data import awkward_texts, docs, no_docs, words

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def split(text):
    return re.findall(WORDS, (text or "").translate(FOLD))


def brute(rows, items, window=13):
    wins = {}
    for item, text in items:
        w = split(text)
        if w and item is not None:
            for s in range(max(1, len(w) - window + 1)):
                wins.setdefault(tuple(w[s : s + window]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if (key := tuple(w[s : s + n])) in wins:
                    hit.update(range(s, s + n))
                    found |= wins[key]
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=repr)


ITEMS = [
    (1, " ".join(words(2, 30))),
    (2, "A, " + " ".join(words(2, 30)[5:25]).upper()),
    (3, "the " * 40),
    (4, "one"),
    (5, "we ll 123"),
    (6, " ".join(words(1, 80)[10:18])),
    (7, None),
    (8, "?!"),
    (None, " ".join(words(3, 30))),
    (9, " ".join(words(3, 30_000)[20_000:20_013])),
    (9, " ".join(words(3, 30_000)[29_980:])),
]


def test_every_window_length_and_awkward_texts(spark):
    bench = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, n_words int")
    assert result(contamination(docs(spark), bench)) == brute(awkward_texts(), ITEMS)


def test_blocks_of_the_benchmark_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr("quillsieve.llm.decontaminate.BLOCK_WINDOWS", 20)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(contamination(docs(spark), bench)) == brute(awkward_texts(), ITEMS)


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert result(contamination(docs(spark), bench)) == brute(awkward_texts(), [])
    assert contamination(no_docs(spark), bench).count() == 0
    assert drop_contaminated(docs(spark), bench).count() == len(awkward_texts())


def test_contaminated_rows_go_and_columns_stay(spark):
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    kept = drop_contaminated(docs(spark), bench)
    assert kept.columns == docs(spark).columns
    bad = [(d, n, h) for d, n, h, _ in brute(awkward_texts(), ITEMS[:1]) if h and 20 * h >= n]
    assert kept.count() == len(awkward_texts()) - len(bad) and bad
    flags = contamination(docs(spark), bench).where(is_contaminated_column())
    assert flags.count() == len(bad)


def is_contaminated_column():
    from pyspark.sql import functions as F

    return is_contaminated(F.col("n_words"), F.col("n_hit"))


def test_no_python_runs(spark, sf_dir):
    from quillsieve.llm.decontaminate import op1_benchmark_decontamination

    plan = op1_benchmark_decontamination(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert "BroadcastHashJoin" in plan


def test_query_against_sql(spark, sf_dir):
    assert difference(spark, "op1_benchmark_decontamination", sf_dir)[0] is None


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize("text", ["Éa b", "KK x", "ÅB"])
def test_only_ascii_letters_are_folded(spark, text):
    from pyspark.sql import functions as F

    from quillsieve.llm.decontaminate import words as column

    assert spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("w")).first().w == split(text)
