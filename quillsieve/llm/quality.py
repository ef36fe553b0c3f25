"""Quality rules as a short-circuit cascade ordered by measured rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.text import evaluated_once
from quillsieve.llm.common import ArrowBatches, table, words_of

#: Rows whose rules are timed to choose an order. The order never changes a verdict.
SAMPLE_ROWS = 512
_SLICE = 64
_WORD_PACKED = 2_097_151  # three numbers up to this fit in 63 bits

# The characters that count as symbols, and the white space that parts words.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


class Text:
    """A text and what rules look at, each worked out once and only when a rule asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return words_of(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """The lines with a word."""
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a 3-word window that the text has twice or more."""
        if self.n_words < 4:
            return 0
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, self.n_words)
        pairs = ids[:-1] * len(seen) + ids[1:]
        if len(seen) > _WORD_PACKED:
            pairs = np.unique(pairs, return_inverse=True)[1]
        _, at, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        twice = counts[at] > 1
        inside = np.zeros(self.n_words, bool)
        for shift in range(3):
            inside[shift : shift + len(twice)] |= twice
        return int(inside.sum())

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _upper_share(t: Text) -> float:
    letters = sum(map(str.isalpha, t.text))
    return sum(map(str.isupper, t.text)) / letters if letters else 0.0


def _wordlike_share(t: Text) -> float:
    """Share of words with a letter; every byte beyond ASCII counts as one."""
    return sum(any(65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in w) for w in t.words) / max(1, t.n_words)


#: The rules in the order they are tried where no sample says otherwise. A text without words
#: passes all but the base rules.
RULES = (
    Rule("too_short", lambda t: t.n_words < 50),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("exclamations", lambda t: 5 * t.text.count("!") > t.n_words),
    Rule("duplicate_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 12 * t.n_words),
    Rule("capitals", lambda t: _upper_share(t) > 0.3),
    Rule("wordlike", lambda t: t.n_words > 0 and _wordlike_share(t) < 0.6),
    Rule("repeats", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)


def measured(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Rule name to (seconds a row, share of rows rejected), each rule alone on a fresh text.

    Rules are timed on the executors, on at most ``rows`` of the rows a scan gives first; only the
    times and verdicts reach the driver. An empty table gives an empty dictionary.
    """

    def run(batches: ArrowBatches) -> ArrowBatches:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                out: list[list] = [[], []]
                for text in batch.column(0).slice(start, _SLICE).to_pylist():
                    spent, verdicts = [], []
                    for rule in rules:
                        fresh = Text(text)
                        began = time.perf_counter()
                        verdicts.append(bool(rule.rejects(fresh)))
                        spent.append(time.perf_counter() - began)
                    out[0].append(spent)
                    out[1].append(verdicts)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.float64())), pa.array(out[1], pa.list_(pa.bool_()))], names=["spent", "rejected"])

    seen = docs.select(text_col).mapInArrow(run, "spent array<double>, rejected array<boolean>").limit(rows).collect()
    n = len(seen)
    return {r.name: (sum(x[0][i] for x in seen) / n, sum(x[1][i] for x in seen) / n) for i, r in enumerate(rules)} if n else {}


def ordered(rules: tuple[Rule, ...], figures: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Rules by rejections per second, highest first; the given order breaks ties."""

    def rank(rule: Rule) -> float:
        cost, share = figures.get(rule.name, (1.0, 0.0))
        return -share / max(cost, 1e-9)

    return tuple(sorted(rules, key=rank))


def judgement(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the first rule that rejects a text, null where none does; later rules are not run."""

    @F.arrow_udf("string")
    def judge(texts: pa.Array) -> pa.Array:
        def first(text: str | None) -> str | None:
            seen = Text(text)
            return next((r.name for r in rules if r.rejects(seen)), None)

        return pa.array([first(t.as_py()) for t in texts], pa.string())

    return evaluated_once(judge)(text)


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "rejected_by") -> DataFrame:
    """``docs`` with ``out``: the rule that rejects a row, null if it is kept.

    Null and empty texts have no words and fail ``too_short``. Which of several rejecting rules is
    named depends on the measured order; whether one is does not. Every row is judged on its whole
    text; repeated rows get equal verdicts. An existing column ``out`` is replaced.
    """
    return docs.withColumn(out, judgement(F.col(text_col), ordered(rules, measured(docs, text_col, rules))))


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows no rule rejects, with the columns of ``docs``."""
    return judge(docs, text_col, rules, "__rejected_by").where(F.col("__rejected_by").isNull()).select(*docs.columns)


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, rejected_by string"


def report(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality") -> DataFrame:
    """``docs`` with a struct ``out`` of the base measures and the cascade's ``rejected_by``.

    Texts that fail the base rules don't enter the cascade; their ``rejected_by`` is ``base``.
    """
    chosen = ordered(rules, measured(docs, text_col, rules))

    @F.arrow_udf(MEASURES)
    def measure(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            t = Text(text.as_py())
            verdict = "base" if t.base_failed else next((r.name for r in chosen if r.rejects(t)), None)
            rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed, verdict))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.string()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by"]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return docs.withColumn(out, evaluated_once(measure)(F.col(text_col)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        report(table(spark, sf_dir, "documents"))
        .select("doc_id", "quality.*")
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
        .drop("rejected_by")
    )


# The rules once more, as SQL over the same table.
ORACLES = {
    "op8_quality_rules": r"""
with w as (
    select row_number() over () as row_id, doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
    from documents
), g as (
    select row_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram
    from (select row_id, words, unnest(range(1, len(words) - 1)) as i from w)
), twice as (
    select row_id, i from g qualify count(*) over (partition by row_id, gram) > 1
), inside as (
    select row_id, count(distinct i + s) as n from twice, (select unnest([0, 1, 2]) as s) group by row_id
), m as (
    select doc_id, text, words, lines, len(words)::bigint as n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           coalesce(n, 0)::bigint as n_repeat_words
    from w left join inside using (row_id)
), b as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed
            or 10 * n_symbols > n_words
            or 5 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
            or 2 * n_dup_lines > len(lines)
            or not word_chars between 2 * n_words and 12 * n_words
            or length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 0.3 * length(regexp_replace(text, '[^\p{L}]', '', 'g'))
            or len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < 0.6 * n_words) as kept
from b
"""
}
QUERIES = {"op8_quality_rules": op8_quality_rules}
