"""Asking a language model once per row, with resume, strict parsing and throughput."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions import answers, text
from quillsieve.operators.tasks import TaskSpec, count_words
from quillsieve.session import materialise
from quillsieve.sizing import small_side, spread

#: Takes a list of chat requests, returns one answer for each: text, or the exception it met.
Responder = Callable[[list[list[dict]]], Sequence[str | Exception]]

_EXCHANGE = "response string, error string, task_no long, batch_no long, elapsed_s double"


#: The Bloom filter of finished keys, blocked: each key picks one 64-bit word and sets seven
#: bits in it, about ten bits a key (a few in a hundred false hits). Words are a power of two,
#: never more than 2**20 (8 MB broadcast). Past that bound the filter lets more unfinished
#: rows through to the exact check; results never change.
BLOOM_BITS_PER_KEY = 10
BLOOM_MAX_BITS = 1 << 26
BLOOM_PROBES = 7
#: Words of the filter one group puts in order.
BLOOM_BLOCK = 1024


def _bloom_bits(n_keys: int) -> int:
    wanted = max(64, n_keys * BLOOM_BITS_PER_KEY)
    return min(BLOOM_MAX_BITS, 1 << (wanted - 1).bit_length())


def _word(value: Column, bits: int) -> Column:
    """The word of a key: one seeded 64-bit hash, masked to the number of words."""
    return F.xxhash64(value, F.lit("word")).bitwiseAND(F.lit(bits // 64 - 1)).cast("int")


def _mask(value: Column) -> Column:
    """The bits a key sets in its word: one seeded hash a probe, each giving a bit number."""
    mask = F.lit(0).cast("long")
    for j in range(BLOOM_PROBES):
        bit = F.xxhash64(value, F.lit(f"probe-{j}")).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom_filter(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """One row, ``bitmap``: the filter as ``bits / 64`` longs, aggregated over all tasks.

    Each task sets the bits of its keys; words are combined by ``bit_or`` in a shuffle of at
    most ``bits / 64`` rows, filled up with the empty words, and put in order: first within
    blocks, by all tasks, then block by block in one row.
    """
    places = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("_w"), F.lit(0).cast("long").alias("_v"))
    own = keys.select(_word(F.col(column), bits).alias("_w"), _mask(F.col(column)).alias("_v"))
    words = own.union(places).groupBy("_w").agg(F.bit_or("_v").alias("_v"))
    in_order = lambda place, value: F.transform(F.sort_array(F.collect_list(F.struct(place, value))), lambda x: x[value])
    block = F.floor(F.col("_w") / BLOOM_BLOCK).cast("int")
    blocks = words.groupBy(block.alias("_b")).agg(in_order("_w", "_v").alias("_vs"))
    return blocks.agg(F.flatten(in_order("_b", "_vs")).alias("bitmap"))


def might_contain(bitmap: Column, value: Column, bits: int) -> Column:
    """False only for a value whose key is surely not in the filter.

    A key's bits lie in one word, so the bitmap (a scalar subquery) is read once a row.
    """
    mask = _mask(value)
    return F.element_at(bitmap, _word(value, bits) + 1).bitwiseAND(mask) == mask


def resume(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not among the finished ones. A finished null key covers null keys.

    Finished keys are cast to the type of ``df``'s key; one that does not cast is left out.
    Their distinct values are counted and put in a blocked Bloom filter, built by all tasks and
    broadcast as one scalar. A row that misses the filter passes where it is, with no shuffle.
    Only keys of possible hits are checked exactly, by a join of keys alone; the few false
    hits found are the only rows of texts joined, against a side checked for size before it
    is broadcast.
    """
    kind = df.schema[key].dataType
    finished = done.select(F.col(key).isNull().alias("_none"), F.col(key).try_cast(kind).alias("_done"))
    covers_null = finished.where("_none").limit(1).count() > 0
    keys = materialise(finished.where(~F.col("_none") & F.col("_done").isNotNull()).select("_done").distinct(), "finished-keys")
    nulls = df.where(F.col(key).isNull() & F.lit(not covers_null))
    present = df.where(F.col(key).isNotNull())
    n_keys = keys.count()
    if n_keys == 0:
        return nulls.unionByName(present)
    bits = _bloom_bits(n_keys)
    bitmap = bloom_filter(keys, "_done", bits).scalar()
    hit = might_contain(bitmap, F.col(key), bits)
    missed = present.where(~hit)
    hits = present.where(hit)
    # Keys of possible hits that are not finished: false hits, about one in a hundred.
    false_hits = hits.select(F.col(key).alias("_done")).distinct().join(keys, "_done", "left_anti")
    kept = hits.join(small_side(false_hits), hits[key] == F.col("_done"), "left_semi")
    return nulls.unionByName(missed).unionByName(kept)


def resource_papers(papers: DataFrame, after_year: int = 2010) -> DataFrame:
    """Papers with title and abstract, later than the year, with both joined in ``text``.

    A year that is no integer drops the paper; ``rejected_years`` counts those.
    """
    complete = papers.filter(F.col("title").isNotNull() & F.col("abstract").isNotNull())
    recent = complete.filter(text.strip(F.col("year").cast("string")).try_cast("int") > after_year)
    return recent.withColumn("text", F.concat("title", F.lit(" "), "abstract"))


def rejected_years(papers: DataFrame) -> DataFrame:
    """How many complete papers have a year that is no integer. One row."""
    complete = papers.filter(F.col("title").isNotNull() & F.col("abstract").isNotNull())
    year = text.strip(F.col("year").cast("string")).try_cast("int")
    return complete.agg(F.count_if(year.isNull()).alias("rejected_years"))


def prepare(df: DataFrame, max_length: int, load_tokenizer: Callable[[], text.Tokenizer] | None = None) -> DataFrame:
    """Truncate ``text`` to the budget and add ``num_tokens``, counted after truncation."""
    df = spread(df)
    kept = [c for c in df.columns if c not in ("text", "num_tokens")]
    if load_tokenizer is None:
        cut = df.select(*kept, F.slice(text.words(F.col("text")), 1, max_length).alias("_words"))
        return cut.select(*kept, F.array_join("_words", " ").alias("text"), F.coalesce(F.size("_words"), F.lit(0)).cast("long").alias("num_tokens"))
    cut = df.select(*kept, text.truncate_tokens(F.col("text"), max_length, load_tokenizer).alias("_cut"))
    return cut.select(*kept, "_cut.text", "_cut.num_tokens")


def ask(df: DataFrame, task: TaskSpec, load_responder: Callable[[], Responder], batch_size: int = 10, on_error: str | None = None) -> DataFrame:
    """Add the raw answer of each row: ``response, error`` and the batch it was asked in.

    Evaluating the result asks again, so write it before using it twice. A task that is retried
    asks its rows again; keyed results and ``resume`` make that harmless.
    """
    on_error = on_error or task.errors
    if on_error not in ("default", "fail"):
        raise ValueError("on_error must be 'default' or 'fail'")
    system = task.system

    @F.pandas_udf(_EXCHANGE)
    def exchange(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        responder = load_responder()
        task_no = TaskContext.get().partitionId()
        batch_no = 0
        for users in batches:
            rows = []
            for start in range(0, len(users), batch_size):
                part = users.iloc[start : start + batch_size]
                requests = [[{"role": "system", "content": system}, {"role": "user", "content": u}] for u in part]
                began = time.perf_counter()
                try:
                    replies = list(responder(requests))
                    if len(replies) != len(requests):
                        raise ValueError(f"responder gave {len(replies)} answers to {len(requests)} requests")
                except Exception as error:
                    if on_error == "fail":
                        raise
                    replies = [error] * len(requests)
                elapsed = time.perf_counter() - began
                for reply in replies:
                    failed = isinstance(reply, Exception)
                    if failed and on_error == "fail":
                        raise reply
                    rows.append((None if failed else reply, repr(reply) if failed else None, task_no, batch_no, elapsed))
                batch_no += 1
            yield pd.DataFrame(rows, columns=["response", "error", "task_no", "batch_no", "elapsed_s"])

    asked = df.select("*", text.evaluated_once(exchange)(task.user()).alias("_exchange"))
    return asked.select(*df.columns, "_exchange.*")


def recorded(df: DataFrame, recordings: DataFrame, key: str = "id") -> DataFrame:
    """Answers from a table ``key, response`` instead of a model; rows without one get an error."""
    unique = recordings.groupBy(F.col(key).alias("_key")).agg(F.max("response").alias("response"))
    joined = df.join(unique, df[key] == F.col("_key"), "left").drop("_key")
    return joined.withColumn("error", F.when(F.col("response").isNull(), F.lit("no recorded answer")))


def parse_responses(asked: DataFrame, task: TaskSpec, model: str | Column, language: str | Column | None = None, load_tokenizer: Callable[[], text.Tokenizer] | None = None) -> DataFrame:
    """Result rows from raw answers: parsed fields over defaults, input fields protected.

    Batch bookkeeping columns are carried along where present, as are ``run_id`` and ``source_file``.
    """
    model = F.lit(model) if isinstance(model, str) else model
    carried = [c for c in ("run_id", "source_file", "task_no", "batch_no", "elapsed_s") if c in asked.columns]
    if task.kind == "rewrite":
        return _rewrites(asked, model, carried, load_tokenizer)
    parsed_df = asked.withColumn("_parsed", answers.parse_answer(F.col("response")))
    parsed = F.col("_parsed")
    failed = F.when(~parsed["ok"], F.coalesce(F.col("error"), F.lit("answer is not a JSON object")))
    extra = F.when(parsed["ok"], parsed["extra"])
    reasoning = answers.merged(parsed, "reasoning", F.lit(""))
    tokens = [F.col("num_tokens")] if "num_tokens" in asked.columns else []
    if task.kind == "category":
        return parsed_df.select(
            "id", "title", "abstract", "url",
            reasoning.alias("reasoning"),
            answers.merged(parsed, "category", F.lit("")).alias("category"),
            extra.alias("extra"), failed.alias("error"), *tokens, *carried,
        )
    raw, kind = answers.merged_score(parsed)
    scored = parsed_df.withColumns({"_raw": raw, "_kind": kind})
    return scored.select(
        answers.score_number(F.col("_raw"), F.col("_kind")).alias("score"),
        F.col("_raw").alias("score_raw"),
        F.col("_kind").alias("score_json_type"),
        reasoning.alias("reasoning"),
        answers.merged(parsed, "keywords", F.array().cast("array<string>")).alias("keywords"),
        F.when(parsed["ok"], text.answer_thinking(F.col("response"))).otherwise(F.lit("")).alias("thinking"),
        "id", "url", F.col("text").alias("input_text"), model.alias("model"),
        (F.lit(language) if isinstance(language, str) or language is None else language).cast("string").alias("language"),
        extra.alias("extra"), failed.alias("error"), *tokens, *carried,
    )


def _rewrites(asked: DataFrame, model: Column, carried: list[str], load_tokenizer) -> DataFrame:
    answer = F.coalesce(F.col("response"), F.lit(""))
    if load_tokenizer is None:
        count = text.word_count(answer).cast("long")
    else:
        count = text.truncate_tokens(answer, 2**31 - 1, load_tokenizer)["full_tokens"]
    return asked.select(
        answer.alias("text"), "id", "url", F.col("text").alias("input_text"), "num_tokens", model.alias("model"),
        F.when(F.col("response").isNull(), F.lit(0)).otherwise(count).cast("long").alias("num_generated_tokens"),
        "error", *carried,
    )


def generate(
    df: DataFrame,
    task: TaskSpec,
    load_responder: Callable[[], Responder],
    model: str,
    language: str | None = None,
    max_tokens: int = 4096,
    batch_size: int = 10,
    load_tokenizer: Callable[[], text.Tokenizer] | None = None,
    on_error: str | None = None,
) -> DataFrame:
    """Truncate, ask and parse: one result row per input row."""
    counter = count_words if load_tokenizer is None else (lambda t, tok=load_tokenizer(): len(tok.encode(t)))
    ready = prepare(df, task.input_budget(counter, max_tokens), load_tokenizer)
    return parse_responses(ask(ready, task, load_responder, batch_size, on_error), task, model, language, load_tokenizer)


def batch_metrics(results: DataFrame, tokens: str) -> DataFrame:
    """Rows, tokens and seconds of each batch of requests."""
    return results.groupBy("task_no", "batch_no").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum(tokens).alias("num_tokens"), F.max("elapsed_s").alias("elapsed_s")
    )


def throughput(batches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the batches' own rates, 0 for a batch that took no time, and the token total."""
    rate = lambda amount: F.avg(
        F.when(F.col("elapsed_s") > 0, F.try_divide(F.col(amount).cast("double"), F.col("elapsed_s"))).otherwise(F.lit(0.0))
    )
    return batches.groupBy(*by).agg(
        rate("num_rows").alias("rows_per_second"),
        rate("num_tokens").alias("tokens_per_second"),
        F.sum("num_tokens").alias("total_tokens"),
    )
