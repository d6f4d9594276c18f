"""Small helpers over Python sequences."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import TypeVar

A = TypeVar("A")
B = TypeVar("B")


def find_single(items: Iterable[A], wanted: Callable[[A], bool]) -> A | None:
    """The one item that is wanted, None if there is none; more than one is an error."""
    found = [x for x in items if wanted(x)]
    if len(found) > 1:
        raise ValueError(f"{len(found)} items where one at most was expected")
    return found[0] if found else None


def find_exactly_one(items: Iterable[A], wanted: Callable[[A], bool]) -> A:
    found = find_single(items, wanted)
    if found is None:
        raise ValueError("no item where one was expected")
    return found


def split(items: Iterable[A], left: Callable[[A], B | None]) -> tuple[list[B], list[A]]:
    """What `left` turned into something, and the items that it left."""
    made, rest = [], []
    for x in items:
        y = left(x)
        if y is None:
            rest.append(x)
        else:
            made.append(y)
    return made, rest


def none_if_empty(text: str | None) -> str | None:
    return text or None
