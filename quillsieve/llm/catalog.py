"""All queries of this folder, with the SQL that checks them where SQL can."""

from __future__ import annotations

from quillsieve.llm import bpe, chat_format, decontaminate, html_text, licenses, merkle, quality, repair, shards, simhash, substrings, token_files, warc

_PARTS = (decontaminate, simhash, substrings, html_text, licenses, token_files, bpe, quality, shards, warc, chat_format, repair, merkle)

QUERIES = {n: q for part in _PARTS for n, q in part.QUERIES.items()}
ORACLES = {n: sql for part in _PARTS for n, sql in part.ORACLES.items()}
