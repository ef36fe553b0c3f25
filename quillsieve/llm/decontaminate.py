"""Benchmark decontamination by winnowing, in DataFrame functions only.

A k-gram is a run of ``GRAM`` words. Of every ``w`` neighbouring k-grams of a document the one with
the smallest hash is kept as a fingerprint. A benchmark window keeps the smallest of its own first
``w`` with its distance from the window's start. The document's choice depends on those k-grams
alone, so wherever a window occurs the document holds the same fingerprint: the join on hashes
finds it, every place of that k-gram is extended to the window, and the words are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.common import table
from quillsieve.session import materialise

WINDOW = 13
GRAM = 5
#: Benchmark windows broadcast at once, about 200 bytes each; a larger benchmark is searched for
#: in several blocks, each against all documents.
BLOCK_WINDOWS = 200_000

# Letters made lower case, and the pattern of a word once they are.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none.

    ``lower`` would change other letters too, so it serves texts that are all ASCII.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(folded, F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


def _grams(hashes: Column, k: int) -> Column:
    """Hash of each run of k words."""
    starts = F.when(F.size(hashes) >= k, F.sequence(F.lit(0), F.size(hashes) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k))))


def _least(grams: Column, w: int) -> Column:
    """The fingerprints: the smallest of each w neighbouring k-grams, each different one once."""
    starts = F.when(F.size(grams) >= w, F.sequence(F.lit(0), F.size(grams) - w)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda s: F.array_min(F.slice(grams, s + 1, w))))


def _marks(least: Column, k: int) -> Column:
    return F.transform(least, lambda f: F.struct(f.alias("f"), F.lit(k).alias("k")))


def _places(grams: Column, f: Column) -> Column:
    """Positions of a k-gram's hash."""
    return F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.get(grams, i) == f)


def _schemes(lengths: set[int], window: int, gram: int) -> dict[int, list[tuple[int, int, int]]]:
    """k to the (shortest, longest, w) of the window lengths it serves, for those that occur.

    Windows shorter than a k-gram are found by single words. A length's class uses the w that its
    shortest member still guarantees.
    """
    classes = [(gram, {n for n in lengths if n == window}), (gram, {n for n in lengths if gram <= n < window}), (1, {n for n in lengths if n < gram})]
    out: dict[int, list[tuple[int, int, int]]] = {}
    for k, members in classes:
        if members:
            out.setdefault(k, []).append((min(members), max(members), min(members) - k + 1))
    return out


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(win, items): every different window of the items with the ids, as strings, that have it.

    Items of fewer words, but not none, are one window. Items with a null id can't be named and
    are left out.
    """
    split = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = split.where(F.size("w") > 0).select("item", "w", F.explode(starts).alias("s"))
    return cut.groupBy(F.slice("w", F.col("s"), window).alias("win")).agg(F.collect_set("item").alias("items"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """What each document shares with the benchmark: a row per row of ``docs``.

    Columns: id_col, text_hash (of the text, null for null), n_words, spans (start and length of
    every occurrence of a window, sorted), n_hit (words inside any), items (their item ids as
    strings, sorted). Null, empty and wordless texts have no words. Repeated rows give equal rows;
    an empty benchmark gives no hits. Other columns are not looked at.

    Documents are read once for each block of the benchmark. Of their fingerprints only those
    with a hash of the benchmark leave the scan; a document's hits then meet with one row that
    carries its number of words.
    """
    wins = materialise(benchmark_windows(benchmark, item_col, item_text_col, window), "windows")
    found = wins.groupBy(F.size("win").alias("n")).count().collect()  # at most ``window`` rows
    schemes = _schemes({r["n"] for r in found}, window, gram)
    blocks = max(1, -(-sum(r["count"] for r in found) // BLOCK_WINDOWS))

    split = docs.select(F.col(id_col), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).isNull().alias("no_text"), words(F.col(text_col)).alias("w"))
    split = split.withColumn("n_words", F.size("w").cast("long")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    for k in schemes:
        split = split.withColumn(f"g{k}", _grams(F.col("h"), k))
    # Besides its fingerprints each document has one row without, which carries its number of words.
    picked: list[Column] = [F.array(F.struct(F.lit(None).cast("long").alias("f"), F.lit(0).alias("k")))]
    for k, members in schemes.items():
        least = reduce(lambda a, b: F.array_union(a, b), [_least(F.col(f"g{k}"), w) for _, _, w in members])
        picked.append(_marks(least, k))
    grams = [f"g{k}" for k in schemes]
    marks = split.select(id_col, "text_hash", "no_text", "n_words", "w", *grams, F.explode(F.concat(*picked)).alias("m"))
    marks = marks.select(id_col, "text_hash", "no_text", "n_words", "w", *grams, "m.f", "m.k")

    keyed = wins.withColumn("wh", F.transform("win", lambda x: F.xxhash64(x)))
    sides = []
    for k, members in schemes.items():
        for low, high, w in members:
            side = keyed.where(F.size("win").between(low, high)).withColumn("g", F.slice(_grams(F.col("wh"), k), 1, w))
            sides.append(side.select(F.array_min("g").alias("wf"), F.lit(k).alias("wk"), (F.array_position("g", F.array_min("g")) - 1).cast("int").alias("o"), "win", "items"))

    parts = []
    for block in range(blocks):
        if not sides:
            side = keyed.where("false").select(F.lit(0).cast("long").alias("wf"), F.lit(0).alias("wk"), F.lit(0).alias("o"), "win", "items")
        else:
            side = reduce(DataFrame.union, sides).where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == block)
        first = F.col("f").isNull()
        met = marks.join(F.broadcast(side), (F.col("f") == F.col("wf")) & (F.col("k") == F.col("wk")), "left")
        met = met.where((first & F.lit(block == 0)) | F.col("wf").isNotNull())
        places = F.coalesce(*[F.when(F.col("wk") == k, _places(F.col(f"g{k}"), F.col("f"))) for k in schemes], F.lit(None).cast("array<int>"))
        met = met.withColumn("p", F.explode_outer(places)).drop(*grams)
        start = F.col("p") - F.col("o")
        same = (F.col("p") >= F.col("o")) & (F.slice("w", F.greatest(start + 1, F.lit(1)), F.size("win")) == F.col("win"))
        met = met.where(first | same)
        hit = F.when(~first, F.struct(start.alias("start"), F.size("win").alias("length")))
        parts.append(met.select(id_col, "text_hash", "no_text", "n_words", first.cast("long").alias("copies"), hit.alias("hit"), F.when(~first, F.col("items")).alias("items")))

    summed = (
        reduce(DataFrame.union, parts)
        .groupBy(id_col, "text_hash", "no_text")
        .agg(F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"), F.array_sort(F.collect_set("hit")).alias("spans"), F.collect_set("items").alias("items"))
    )
    inside = F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1)))
    one = summed.select(
        id_col,
        F.when(~F.col("no_text"), F.col("text_hash")).alias("text_hash"),
        "n_words",
        "spans",
        F.size(F.array_distinct(inside)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    return one.drop("copy")


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """A twentieth of the words or more lie in shared windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with its columns."""
    found = contamination(docs, benchmark, id_col, text_col)
    gone = found.where(is_contaminated(F.col("n_words"), F.col("n_hit"))).select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash")), "left_anti")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


QUERIES = {"op1_benchmark_decontamination": op1_benchmark_decontamination}
ORACLES = {
    "op1_benchmark_decontamination": rf"""
with d as (
    select row_number() over () as row_id, doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORDS}'), []) as w
    from documents
), b as (
    select item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORDS}') as w from benchmark where text is not null
), bw as (
    select distinct item_id, w[s : s + {WINDOW - 1}] as win
    from (select item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) as s from b where len(w) > 0)
), sizes as (
    select distinct len(win) as n from bw
), dw as (
    select row_id, n, s, w[s : s + n - 1] as win from (select row_id, w, n, unnest(range(1, len(w) - n + 2)) as s from d, sizes)
), hits as (
    select row_id, item_id, s, n from dw join bw using (win)
), inside as (
    select row_id, count(distinct i) as n_hit from (select row_id, unnest(range(s, s + n)) as i from (select distinct row_id, s, n from hits)) group by row_id
), items as (
    select row_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct row_id, item_id::varchar as item_id from hits) group by row_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join inside using (row_id) left join items using (row_id)
"""
}
