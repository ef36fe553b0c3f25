"""Text columns: whitespace, tokens, truncation, answer clean-up, prompts and run keys.

All of it is built from Spark's own functions, apart from truncation with a subword tokenizer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Python's ``str.strip`` and ``str.split`` see it, as a Java character class.
#: Measured faster than the same class spelt out by ranges.
WHITESPACE = r"(?U)[\s\x1c-\x1f]"
# The characters of that class.
WHITESPACE_CHARACTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def evaluated_once(batch_function):
    """Keep the optimizer from copying a Python function into the filters above it.

    A filter on the result of a deterministic function is pushed below it by repeating the call.
    Filters on other columns stay above too, so place those before the function.
    """
    return batch_function.asNondeterministic()


def strip(text: Column) -> Column:
    """Drop whitespace of any script at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def words(text: Column) -> Column:
    """Whitespace-separated tokens; an empty array for blank text."""
    return F.array_remove(F.split(text, rf"{WHITESPACE}+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def truncate_words(text: Column, max_length: int) -> Column:
    """The first ``max_length`` tokens joined by single spaces."""
    return F.array_join(F.slice(words(text), 1, max_length), " ")


def truncated_word_count(text: Column, max_length: int) -> Column:
    """Number of tokens left after truncation."""
    return F.least(word_count(text), F.lit(max_length))


class Tokenizer(Protocol):
    def encode(self, text: str) -> list: ...

    def decode(self, tokens: list) -> str: ...


def truncate_tokens(text: Column, max_length: int, load: Callable[[], Tokenizer]) -> Column:
    """Truncate with a subword tokenizer: ``struct<text, num_tokens, full_tokens>``.

    ``load`` is called once per Python task. ``num_tokens`` counts after truncation.
    """

    @F.pandas_udf("text string, num_tokens long, full_tokens long")
    def truncate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = load()
        for texts in batches:
            tokens = [tokenizer.encode(t) if t is not None else [] for t in texts]
            yield pd.DataFrame(
                {
                    "text": [None if t is None else tokenizer.decode(ids[:max_length]) for t, ids in zip(texts, tokens)],
                    "num_tokens": [min(len(ids), max_length) for ids in tokens],
                    "full_tokens": [len(ids) for ids in tokens],
                }
            )

    return evaluated_once(truncate)(text)


def file_tokenizer(path: str) -> Callable[[], Tokenizer]:
    """Loader for a tokenizer definition file that every executor can read at ``path``."""

    def load() -> Tokenizer:
        from tokenizers import Tokenizer as Definition

        definition = Definition.from_file(path)

        class Loaded:
            def encode(self, text: str) -> list:
                return definition.encode(text).ids

            def decode(self, tokens: list) -> str:
                return definition.decode(tokens, skip_special_tokens=True)

        return Loaded()

    return load


def strip_fences(answer: Column) -> Column:
    """Remove every code fence marker, also those inside strings."""
    without_json = strip(F.replace(answer, F.lit("```json"), F.lit("")))
    return strip(F.replace(without_json, F.lit("```"), F.lit("")))


def answer_body(answer: Column) -> Column:
    """An answer without its thinking part and fences; null if the thinking never ends."""
    after = strip(F.get(F.split(answer, "</think>"), F.lit(1)))
    return strip_fences(F.when(F.contains(answer, F.lit("<think>")), after).otherwise(answer))


def answer_thinking(answer: Column) -> Column:
    """Text of the thinking part, empty if there is none."""
    opened = F.get(F.split(answer, "<think>"), F.lit(1))
    thinking = strip(F.get(F.split(opened, "</think>"), F.lit(0)))
    return F.when(F.contains(answer, F.lit("<think>")), thinking).otherwise(F.lit(""))


def output_tag(answer: Column) -> Column:
    """Content of the first ``<output>`` element, over lines; null if there is none."""
    pattern = r"(?s)<output>(.*?)</output>"
    return F.when(F.regexp_like(answer, F.lit(pattern)), strip(F.regexp_extract(answer, pattern, 1)))


def messages(system: str, user: Column) -> Column:
    """A chat request: the system message, then the user's."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", user))


def run_key(prompt: str, model: Column) -> Column:
    """Folder name of a run: ten hex digits over prompt and model."""
    return F.substring(F.sha2(F.concat(F.lit(prompt), model), 256), 1, 10)


def run_key_of(prompt: str, model: str) -> str:
    """The same for one known model."""
    return hashlib.sha256((prompt + model).encode()).hexdigest()[:10]


def checkpoint_name(base_model: Column, distilled_model: Column) -> Column:
    """Folder name of a head: encoder and labelling model, slashes escaped."""
    escape = lambda c: F.replace(c, F.lit("/"), F.lit("__"))
    return F.concat(escape(base_model), F.lit("@"), escape(distilled_model))


def model_of_path(path: Column) -> Column:
    """Model name from the first part of a checkpoint path."""
    return F.replace(F.split_part(path, F.lit("/"), F.lit(1)), F.lit("__"), F.lit("/"))
