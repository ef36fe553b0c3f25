"""The four requests made of a language model, as specifications of one generation job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.functions.text import messages

#: Fixed value: tokens set aside for the chat format around a prompt.
CHAT_TOKENS = 21
#: Fixed value: tokens a model may read and write per request.
MAX_TOKENS = 4096

# Categories of the resource task.
CATEGORIES = ("ar", "en", "fr", "ru", "jp", "other", "multi", "none")


@dataclass(frozen=True)
class TaskSpec:
    """One kind of request.

    ``kind`` names the parse rule and the default row: ``score``, ``category`` or ``rewrite``.
    ``sample_answer`` sizes the room left for an answer; without one half the tokens are kept.
    ``errors`` is what a failed request does unless the caller says otherwise.
    """

    name: str
    kind: str
    system: str
    prompt: str
    sample_answer: str | None = None
    errors: str = "fail"

    def user(self, fields: Callable[[str], Column] = F.col) -> Column:
        """Text of the user's message for a row."""
        if self.kind == "category":
            # The paper's own fields, not the truncated text.
            body = F.concat(F.lit("Title: "), fields("title"), F.lit("\nAbstract: "), fields("abstract"))
        else:
            body = fields("text")
        return F.concat(F.lit(self.prompt), body)

    def messages(self, fields: Callable[[str], Column] = F.col) -> Column:
        return messages(self.system, self.user(fields))

    def input_budget(self, count_tokens: Callable[[str], int], max_tokens: int = MAX_TOKENS) -> int:
        """Tokens a text may have so that prompt and answer still fit."""
        prompt = count_tokens(self.prompt) + CHAT_TOKENS
        answer = max_tokens // 2 if self.sample_answer is None else count_tokens(self.sample_answer)
        budget = max_tokens - prompt - answer
        if budget < 1:
            raise ValueError(f"task {self.name}: no room for a text in {max_tokens} tokens")
        return budget


def count_words(text: str) -> int:
    """Token count of the default tokenizer."""
    return len(text.split())


SCORE = TaskSpec(
    name="score",
    kind="score",
    system="You judge how useful web pages are for teaching.",
    prompt=(
        "Judge the extract of a web page below for use in primary and grade school teaching.\n"
        "Add up one point each for: relevant basic information; some educational aim; key concepts of a curriculum; "
        "clear and coherent teaching material; outstanding value for pupils.\n"
        "Give 0 to incoherent, explicit, harmful or promotional content.\n"
        "Answer with one JSON object and nothing else. Its keys are "
        '"keywords" (a list of at most five English keywords), "reasoning" (a few sentences) and "score" (0 to 5).\n'
        "Extract:\n"
    ),
    sample_answer=(
        '```json\n{"keywords": ["photosynthesis", "plants", "energy"], "reasoning": "The extract explains how plants '
        "turn light into energy in plain words. It fits the science curriculum of a grade school and comes with a short "
        'exercise, yet a part of it advertises a book.", "score": 3}\n```'
    ),
)

RESOURCE_CATEGORY = TaskSpec(
    name="resource_category",
    kind="category",
    system="You sort papers by the resources they publish.",
    prompt=(
        "Does the paper below publish a dataset or another language resource, and in which language?\n"
        f"Answer with one JSON object with the keys \"reasoning\" and \"category\". Categories: {', '.join(CATEGORIES)}. "
        'Use "multi" for several languages, "other" for a language not listed and "none" if no resource is published.\n'
    ),
    sample_answer='{"reasoning": "The abstract announces a new annotated corpus of French news.", "category": "fr"}',
    errors="default",
)

SYNTHESIZE = TaskSpec(
    name="synthesize",
    kind="rewrite",
    system="You write articles for a general audience.",
    prompt=(
        "Write an informative blog post in Arabic that goes deeper into the topic of the extract below. "
        "Be accurate and engaging, use examples, and give neither a title nor a greeting.\nExtract:\n"
    ),
)

TRANSLATE = TaskSpec(
    name="translate",
    kind="rewrite",
    system="You rephrase texts in Arabic.",
    prompt=(
        "Rephrase the English extract below in Arabic. It need not be word by word. "
        "Answer with the Arabic text only.\nExtract:\n"
    ),
)

TASKS = {task.name: task for task in (SCORE, RESOURCE_CATEGORY, SYNTHESIZE, TRANSLATE)}
