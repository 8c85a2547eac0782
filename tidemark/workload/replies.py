"""Text functions for the registered queries: local, repeatable stand-ins for a model."""

from __future__ import annotations

import json

from tidemark.operators.infer import Throttled


def count_sources(prompt: str) -> str:
    return f"Found {prompt.count('[Source ')} records"


def headline(prompt: str) -> str:
    """A structured reply: a reasoning block, then the text block."""
    return json.dumps([{"type": "reasoning", "text": prompt}, {"type": "text", "text": " Reviewed. "}])


def by_role(prompt: str) -> str:
    """Every way a reply can come out, chosen by the role that opens the prompt."""
    role, _, text = prompt.partition(": ")
    if role == "system":
        raise ValueError("not allowed")
    if role == "assistant":
        return json.dumps([{"type": "reasoning", "text": role}, {"type": "text", "text": f" {len(text)} "}])
    return f"  {len(text)} characters "


def by_length(prompt: str) -> str:
    """All four outcomes, by the prompt's length: error, empty, broken JSON, text."""
    kind = len(prompt) % 4
    if kind == 0:
        raise ValueError("not allowed")
    return ("", '{"broken', f" {len(prompt)} ")[kind - 1]


class OnSecondCall:
    """Throttled at the first call for a prompt, answers at the second."""

    def __init__(self) -> None:
        self.asked: set[str] = set()

    def __call__(self, prompt: str) -> str:
        if prompt not in self.asked:
            self.asked.add(prompt)
            raise Throttled("slow down")
        return f"ok {prompt}"


class InBatches:
    """A text function as one that takes a list: an exception in place of each reply that failed."""

    def __init__(self, fn):
        self.fn = fn

    def _one(self, text: str):
        try:
            return self.fn(text)
        except Exception as error:  # noqa: BLE001
            return error

    def __call__(self, texts: list[str]) -> list:
        return [self._one(t) for t in texts]
