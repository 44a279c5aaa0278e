"""Texts as runs of words: splitting, and answers kept per run.

Byte-level tokenizers cut a text into pre-tokens before they merge anything, and no pre-token
crosses a single blank that has a visible character on both sides: it starts at that blank. So a
text is the sequence of its blank-led runs, each run gets the same ids wherever it stands, and a
worker encodes a run that it has met before by looking it up.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa

_inner_blanks = re.compile(r"(?<=\S) (?=\S)")

#: Entries and longest run a worker keeps; longer runs are encoded each time they occur.
KEPT_RUNS = 500_000
KEPT_LENGTH = 48


def words(data: bytes | None) -> list[bytes]:
    """`[^\\x20\\x09-\\x0D]+`: what lies between ASCII white space. Null has none."""
    return data.split() if data else []


def byte_values(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, valid or not."""
    return column.cast(pa.binary()).to_pylist()


def text_of(data: bytes | None) -> str:
    """The text of UTF-8 bytes; null is empty, broken sequences become U+FFFD."""
    return data.decode("utf-8", "replace") if data else ""


_kept: dict = {}


def kept(key: object, make: Callable[[], object]):
    """What `make` builds, kept by the worker for later tasks of the same `key`.

    Workers outlive operators, so what one of them kept would add to all that the next ones need: a worker
    keeps one thing, and drops it before it makes another.
    """
    if _kept.get("key") != key:
        drop_kept()
        _kept.update(value=make(), key=key)
    return _kept["value"]


def drop_kept() -> None:
    """For tasks that need much memory of their own and keep nothing."""
    _kept.clear()


class _Touching(Exception):
    """A blank of the text touches other white space."""


class RunValues(dict):
    """What `answer` says of each run, kept for short runs and emptied when full."""

    def __init__(self, answer: Callable[[str], object], limit: int = KEPT_RUNS):
        super().__init__()
        self.answer, self.limit = answer, limit

    def __missing__(self, run: str):
        if not run or run[0].isspace() or run[-1].isspace():
            raise _Touching
        value = self.answer(" " + run)
        if len(run) <= KEPT_LENGTH:
            if len(self) >= self.limit:
                self.clear()
            self[run] = value
        return value

    def of(self, text: str) -> list:
        """The values of the runs of a text, in order."""
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise _Touching
            return [self.answer(first), *map(self.__getitem__, rest)]
        except _Touching:
            first, *rest = _inner_blanks.split(text)
            return [self.answer(first), *(self.answer(" " + run) for run in rest)]
