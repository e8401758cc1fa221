"""Cost-balanced packing of documents into fixed-capacity token sequences.

Method: a document's attention cost is estimated as ``linear * n + quadratic * n^2`` of its tokens in a
sequence. Documents are taken by descending cost; each goes to the sequence with the lowest cost so far
among those with remaining capacity. A document longer than the remaining room is cut there and its rest
goes on as a smaller document; a document longer than a whole sequence first fills whole sequences alone.

Scale: a task tokenizes the rows it reads and packs them shard by shard (about ``shard_tokens`` tokens,
whole documents), so memory is bounded, nothing is shuffled and ids never travel: a lost task is redone
alone. A worker holds the texts of a block (``BLOCK_CHARS``) and the ids of ``KNOWN_CHUNKS`` distinct chunks. Sequences of a shard are all full: what is left below one capacity is laid into sequences whose
lengths are powers of two, which need no padding. Sequence ids are unique (``partition * 2^36 + n``).

Tokens: the ids of a ``tokenizers`` file without special tokens, then ``end_id``. White space never
reaches a token of a tokenizer that drops it, so each distinct white-space-free chunk is encoded once
(``ChunkTable``). A tokenizer that does not drop white space is refused.

Edge cases: null and empty texts are one ``end_id``; ties in cost keep the order of the rows in their
file; repeated rows are packed each; an empty table gives no pieces; a null document id is kept as null;
other columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.chunk_table import ChunkTable, ranges
from boreal.llm.worker import claim, keep

BLOCK_CHARS = 1_000_000
JOINED = 300  # chunks encoded in one call
#: Distinct chunks a worker keeps: about 200 bytes each, whatever the number in the corpus.
KNOWN_CHUNKS = 600_000
#: White space of both Python and the tokenizer's pattern; other kinds stay inside a chunk.
SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Marks that compose with a small letter (h, j, t, w or y) but not with its capital.
MARKS = "\u0308\u030a\u030c\u0331\u0344"
STOPS = ".,;:!?"


class WordCodec:
    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        if self._ids("Ab, c.\n  d") != [i for w in ("ab", ",", "c", ".", "d") for i in self._ids(w)]:
            raise ValueError("this tokenizer keeps white space or case")
        self.stop = {c: self._ids(c) for c in STOPS}
        self.parted: dict[str, bool] = {}
        self.table = ChunkTable(self._segment, limit=KNOWN_CHUNKS)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _parts(self, letter: str) -> bool:
        """Whether a stop behind this character is a token of its own. The tokenizer says so: the lower case of a
        letter may end in a mark, which joins the stop."""
        if letter not in self.parted:
            e = self.tokenizer.encode(f"a{letter}{STOPS[0]}", add_special_tokens=False)
            last = [i for i, word in zip(e.ids, e.word_ids) if word == e.word_ids[-1]]
            self.parted[letter] = last == self.stop[STOPS[0]]
        return self.parted[letter]

    def _segment(self, chunks: list[str]) -> list[list[int]]:
        """A chunk that ends in a letter and one stop is its base and the stop: bases are encoded once."""
        parted = {x for x in {c[-2:-1] for c in chunks if c[-1] in STOPS} if x.isalpha() and self._parts(x)}
        bases = [c[:-1] if c[-1] in STOPS and c[-2:-1] in parted else c for c in chunks]
        new = list(set(bases).difference(self.table.row))
        ids: dict[str, list[int]] = {}
        for k in range(0, len(new), JOINED):
            part = new[k:k + JOINED]
            e = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            cut = np.searchsorted(e.word_ids, np.arange(len(part) + 1)).tolist()
            flat = e.ids
            ids.update(zip(part, [flat[a:b] for a, b in zip(cut, cut[1:])]))
        kept = {b: p.tolist() for b, p in self._known(set(bases).difference(ids))}
        ids.update(kept)
        return [ids[b] if len(b) == len(c) else ids[b] + self.stop[c[-1]] for b, c in zip(bases, chunks)]

    def _known(self, bases: set[str]) -> Iterator[tuple[str, np.ndarray]]:
        names = list(bases)
        rows = np.fromiter(map(self.table.row.__getitem__, names), np.int64, len(names))
        flat, length = self.table.ids(rows)
        return zip(names, np.split(flat, np.cumsum(length)[:-1]))

    @staticmethod
    def chunks(text: str) -> list[str]:
        if text.isascii():
            text = text.lower()
        elif not any(m in text for m in MARKS):
            text = text.encode().lower().decode()  # A-Z only: fewer distinct chunks
        return SPACE.split(text.strip(" \t\n\r\x0b\x0c")) if OTHER_SPACE.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words = [[c for c in self.chunks(t) if c] for t in texts]
        flat, length, _ = self.table.joined(words)
        return np.split(flat, np.cumsum(length)[:-1])


@lru_cache(maxsize=2)
def codec(tokenizer_file: str) -> WordCodec:
    keep(codec.cache_clear)
    return WordCodec(tokenizer_file)


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of ``(document, start, length)``; every sequence is full."""
    whole, rest = [], []
    for i, n in enumerate(lengths):
        cut = n // capacity * capacity
        whole += [[(i, s, capacity)] for s in range(0, cut, capacity)]
        if n > cut:
            rest.append((i, cut, n - cut))
    rest.sort(key=lambda x: -x[2])  # cost grows with length; ties keep their order
    full, left = divmod(sum(x[2] for x in rest), capacity)
    rooms = [capacity] * full + [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in rooms]
    # The short last sequences open when the full ones are filled.
    heap, later = [(0.0, k) for k in range(full)], list(range(full, len(rooms)))[::-1]
    for doc, start, n in rest:
        while n:
            cost, k = heapq.heappop(heap) if heap else (0.0, later.pop())
            put = min(n, rooms[k])
            sequences[k].append((doc, start, put))
            rooms[k] -= put
            start, n = start + put, n - put
            if rooms[k]:
                heapq.heappush(heap, (cost + linear * put + quadratic * put * put, k))
    return whole + sequences


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 2, linear: float = 1.0,
         quadratic: float = 1.0 / 4096, shard_tokens: int = 2_000_000, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's; ``ids`` are the
    piece's ids as little-endian unsigned 32-bit numbers (binary).
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def pieces(shard: list[tuple[int | None, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
        sequences = assign([len(ids) for _, ids in shard], capacity, linear, quadratic)
        rows = [(shard[d][0], s, n, len(shard[d][1]), first + k, o, shard[d][1][s:s + n].tobytes())
                for k, seq in enumerate(sequences)
                for (d, s, n), o in zip(seq, np.cumsum([0] + [p[2] for p in seq]).tolist())]
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]), first + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing")
        c = codec(tokenizer_file)
        sequence = TaskContext.get().partitionId() << 36
        shard, size = [], 0
        for batch in batches:
            for a, b in ranges(pc.utf8_length(batch.column("text")).to_pylist(), BLOCK_CHARS):
                part = batch.slice(a, b - a)
                for i, tokens in zip(part.column("doc_id").to_pylist(), c.encode(part.column("text").to_pylist())):
                    shard.append((i, np.append(tokens, end_id).astype("<u4")))
                    size += len(tokens) + 1
                if size >= shard_tokens:
                    out, sequence = pieces(shard, sequence)
                    yield out
                    shard, size = [], 0
        if shard:
            yield pieces(shard, sequence)[0]

    return source.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
                                  "offset long, ids binary")
