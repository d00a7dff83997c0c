"""Small helpers of the tokenising operators: a bounded memo and safe cuts of
very long texts."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

#: Longer keys are computed each time, so that a memo's memory stays bounded.
LONGEST_KEY = 64
_CUT = re.compile(r"(?<=[a-zA-Z])(?= [a-zA-Z])")


class Memo(dict):
    """``compute(key)`` remembered for the last ``limit`` to ``2 * limit``
    distinct keys; forgetting costs time only, never a result."""

    def __init__(self, compute: Callable, limit: int = 200_000, known: dict | None = None):
        super().__init__(known or {})
        self._compute, self._limit, self._known, self._old = compute, limit + len(known or {}), known or {}, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
            if len(key) > LONGEST_KEY:
                return value
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
            self.update(self._known)
        self[key] = value
        return value


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in consecutive slices of about ``size`` characters, cut only
    where a letter meets a single space before a letter: no pre-token of the
    given tokenizers spans such a place."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def tidy() -> None:
    """Gives back what a task has left behind in its Python worker, which later
    tasks use again: models and memos hold references in circles and would stay
    until some later collection, beside those of the next task.  Arrow
    keeps the memory of batches in a pool of its own."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task's function, which gives back what tasks before it have left in
    its worker and, at its end, what it leaves itself."""
    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        tidy()
        try:
            yield from run(batches)
        finally:
            tidy()
    return task
