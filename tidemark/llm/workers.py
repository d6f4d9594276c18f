"""A Python worker's memory, which the tasks of all operators share: one kept thing at a time, and no freed pages."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa

_kept: dict[str, Any] = {}


def kept(name: str, make: Callable[[], Any]) -> Any:
    """The worker's own `name`, made when it is first asked for, or after something else was."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def trim() -> None:
    """Give freed memory back to the system: an idle worker would hold it while other tasks of the executor need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        return


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """For a function over batches: memory is given back when it has ended and its own objects are gone."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        trim()

    return wrapped
