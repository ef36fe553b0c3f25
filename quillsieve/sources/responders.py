"""Responder for a chat server that speaks the common completions protocol."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from quillsieve.operators.generation import Responder


def chat_server(base_url: str, model: str, temperature: float = 0.1, api_key: str = "EMPTY") -> Callable[[], Responder]:
    """Loader of a responder that sends the requests of a batch at once.

    Needs the ``openai`` client on the executors. A failed request yields its exception, which
    the job turns into a default row or an error, as told.
    """

    def load() -> Responder:
        try:
            from openai import OpenAI
        except ImportError as error:
            raise ImportError("a chat server responder needs the openai package on every executor") from error
        client = OpenAI(base_url=base_url, api_key=api_key)

        def one(messages: list[dict]) -> str | Exception:
            try:
                reply = client.chat.completions.create(model=model, messages=messages, temperature=temperature)
                return reply.choices[0].message.content
            except Exception as error:  # every kind of failure concerns this row only
                return error

        def respond(requests: list[list[dict]]) -> list[str | Exception]:
            with ThreadPoolExecutor(max_workers=max(1, len(requests))) as pool:
                return list(pool.map(one, requests))

        return respond

    return load
