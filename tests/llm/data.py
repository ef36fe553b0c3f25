"""Small awkward tables shared by the tests of the optional folder."""

from __future__ import annotations

import random

#: Columns whose names clash with what operators add or use inside.
DOCS = "doc_id long, text string, shard string, fp string, n_words string, rejected_by string, tag string, bin string, key string"


def words(seed: int, n: int) -> list[str]:
    dice = random.Random(seed)
    return ["".join(dice.choices("abcdeé", k=dice.randint(1, 4))) for _ in range(n)]


def awkward_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, copies, near copies, ties and odd white space."""
    base = words(1, 80)
    shared = words(2, 30)
    long = words(3, 30_000)
    return [
        (1, " ".join(base)),
        (2, " ".join(base)),
        (3, " ".join(base[:40] + ["changed"] + base[41:])),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, " ".join(long)),
        (8, " ".join(words(4, 20) + shared + words(5, 20))),
        (9, "\n".join(words(6, 20) + shared + words(7, 20))),
        (9, " ".join(words(8, 20) + shared)),
        (9, " ".join(words(8, 20) + shared)),
        (None, " ".join(words(9, 20) + shared)),
        (None, None),
        (10, "the " * 300),
        (11, "x" * 5_000),
        (12, "One  two\r\nthree\x0bfour\x0cfive six　seven 😀 İstanbul ÉCOLE K"),
        (13, " ".join(base).upper()),
        (-5, " ".join(shared)),
        (14, "one"),
        (15, "don't we'll 123 456\n\n\n  end "),
    ]


def docs(spark, rows=None):
    rows = awkward_texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "s", None, "n", "r", None, "b", "k") for i, t in rows], DOCS)


def no_docs(spark):
    return docs(spark, [])
