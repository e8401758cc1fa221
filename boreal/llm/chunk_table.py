"""Distinct-chunk table: each distinct chunk of text is tokenized once, ids are joined back by position.

A tokenizer whose tokens never cross a chunk boundary gives, for a text, the concatenation of what it
gives for the chunks. A task therefore keeps one row per *distinct* chunk (its ids) and looks every
position of every text up in it with array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np


class ChunkTable:
    """``chunk -> ids`` as one flat id array with starts and lengths.

    ``segment(chunks)`` returns one list of ids per distinct chunk; ``decode(id lists)``, if given,
    one text per list, kept beside the ids. About ``limit`` chunks are kept between calls: beyond
    that the less used half goes and is segmented again when met, which never changes a result.
    """

    def __init__(self, segment: Callable[[list[str]], list[list[int]]],
                 decode: Callable[[list[list[int]]], list[str]] | None = None, limit: int = 2_000_000):
        self.segment, self.decode, self.limit = segment, decode, limit
        self.row: dict[str, int] = {}
        self.texts: list[str] = []
        self.flat = np.empty(0, np.int32)
        self.length = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)

    def _shrink(self) -> None:
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:self.limit // 2])
        chunks = list(self.row)
        self.flat = self.flat[self._positions(kept)]
        self.length = self.length[kept]
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        self.uses = self.uses[kept]
        self.texts = [self.texts[i] for i in kept] if self.decode else []
        self.row = {chunks[i]: k for k, i in enumerate(kept)}

    def _add(self, new: list[str]) -> None:
        ids = self.segment(new)
        length = np.fromiter(map(len, ids), np.int32, len(ids))
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))])
        self.length = np.concatenate([self.length, length])
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        if self.decode:
            self.texts += self.decode(ids)

    def _positions(self, rows: np.ndarray) -> np.ndarray:
        length = self.length[rows].astype(np.int64)
        before = np.cumsum(length) - length
        return np.arange(int(length.sum())) + np.repeat(self.start[rows] - before, length)

    def rows(self, chunks: Sequence[str]) -> np.ndarray:
        """The table row of every chunk; unseen chunks are segmented first."""
        if len(self.row) > self.limit:
            self._shrink()
        new = list(set(chunks).difference(self.row))
        if new:
            self._add(new)
        at = np.fromiter(map(self.row.__getitem__, chunks), np.int64, len(chunks))
        self.uses += np.bincount(at, minlength=len(self.uses))
        return at

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in order, and the number of ids of each row."""
        return self.flat[self._positions(rows)], self.length[rows]

    def joined(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts given as chunk lists: flat ids, ids per text, and the table row of every chunk."""
        rows = self.rows(list(chain.from_iterable(texts)))
        flat, length = self.ids(rows)
        chunks = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])[chunks]
        return flat, np.diff(total), rows


def blocks(values: Sequence[str], chars: int) -> list[tuple[int, int]]:
    """Ranges of consecutive texts with about ``chars`` characters each (a longer text alone)."""
    return ranges([len(v) for v in values], chars)


def ranges(sizes: Sequence[int], most: int) -> list[tuple[int, int]]:
    """Ranges of consecutive sizes that add up to about ``most`` each (a greater one alone)."""
    out, begin, size = [], 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            out.append((begin, i))
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        out.append((begin, len(sizes)))
    return out
