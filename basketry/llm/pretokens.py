"""Byte-level vocabularies of rank files, the split that comes before their merges, and what a task remembers."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable

import regex

#: Distinct pieces a task remembers, so that memory stays bounded on any input.
REMEMBERED = 500_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"{path} does not rank its tokens 0, 1, 2, ...")
    return [token for _, token in ranked]


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Text to its pieces, all matches of the pattern."""
    return regex.compile(pattern).findall


class Remembered(dict):
    """Pieces to results; unknown pieces are worked out together.

    Pieces that were not asked for since the last two times it filled up are forgotten.
    """

    def __init__(self, work_out: Callable[[list[str]], Iterable], limit: int = REMEMBERED):
        super().__init__()
        self.work_out, self.limit = work_out, limit
        self.older: dict = {}
        self.unknown: set[str] = set()

    def __missing__(self, piece: str) -> None:
        self.unknown.add(piece)

    def look_up(self, rows: list[list[str]]) -> list[list]:
        """The results of the pieces of all rows."""
        while True:
            found = [list(map(self.__getitem__, row)) for row in rows]
            if not self.unknown:
                return found
            asked, self.unknown = self.unknown, set()
            if len(self) + len(asked) > self.limit // 2 and len(self) > len(asked):
                self.older = dict(self)
                self.clear()
            again = asked.intersection(self.older)
            self.update((p, self.older[p]) for p in again)
            new = list(asked.difference(again))
            self.update(zip(new, self.work_out(new)))
