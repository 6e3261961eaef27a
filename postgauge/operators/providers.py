"""Calls of a provider that takes many texts at once.

Texts of an Arrow batch are sorted by length and sent in groups bounded by items and
characters, so a group's texts are alike in cost; answers go back to their places. A group
that fails is sent again text by text, so one bad text costs only itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

#: Takes a model name and texts, gives one answer for each text in order.
BatchProvider = Callable[[str, list[str]], list[Any]]


@dataclass(frozen=True)
class Limits:
    """Most texts and characters of one call; a longer text is sent alone."""

    items: int = 16
    chars: int = 24_000


def batched(provider: Callable[[str, str], Any]) -> BatchProvider:
    """A provider of single texts in the form for many."""

    def call(model: str, texts: list[str]) -> list[Any]:
        return [provider(model, text) for text in texts]

    return call


def groups(texts: Sequence[str], limits: Limits) -> Iterator[list[int]]:
    """Places of the texts of each call, short texts first."""
    held: list[int] = []
    size = 0
    for place in sorted(range(len(texts)), key=lambda i: (len(texts[i]), i)):
        if held and (len(held) == limits.items or size + len(texts[place]) > limits.chars):
            yield held
            held, size = [], 0
        held.append(place)
        size += len(texts[place])
    if held:
        yield held


def call_all(
    provider: BatchProvider, model: str, texts: Sequence[str], limits: Limits = Limits()
) -> tuple[list[Any], list[str | None]]:
    """Answers and failure texts by place; a failed text has no answer."""
    answers: list[Any] = [None] * len(texts)
    failures: list[str | None] = [None] * len(texts)

    def ask(places: list[int]) -> None:
        found = provider(model, [texts[i] for i in places])
        if len(found) != len(places):
            raise ValueError(f"{len(found)} answers for {len(places)} texts")
        for place, answer in zip(places, found, strict=True):
            answers[place] = answer

    for places in groups(texts, limits):
        try:
            ask(places)
            continue
        except Exception as failure:  # noqa: BLE001 - providers may raise anything
            if len(places) == 1:
                failures[places[0]] = str(failure)
                continue
        for place in places:
            try:
                ask([place])
            except Exception as failure:  # noqa: BLE001
                failures[place] = str(failure)
    return answers, failures
