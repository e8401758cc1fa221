"""SentencePiece encoding and decoding with a distinct-chunk table.

Method: a BPE model whose pieces hold the white-space marker only in front cannot merge across a marked
word's boundary. A text is cut into marked words (a run of markers and what follows up to the next
marker), every *distinct* marked word is segmented once by the sentencepiece library, and its ids are
joined back by position. Decoding does the same with the decoded texts of the words' ids. A model whose
pieces hold a marker behind another character, or whose normaliser changes texts, is refused.

The distinct-chunk table belongs to a Python worker and is bounded; the operator is one map over the
rows, without a shuffle, and a lost task is redone alone.

Edge cases: null and empty texts give no ids and an empty decoded text; a literal marker character
counts as a space, as in the library; repeated rows give repeated results; an empty table gives an
empty result; other columns pass through unless their names are those of the results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.llm.chunk_table import ChunkTable, blocks
from boreal.llm.worker import claim, keep

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
BLOCK_CHARS = 2_000_000


class PieceCodec:
    """Encoder and decoder of one model."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if any(MARK in self.sp.id_to_piece(i).lstrip(MARK) for i in range(len(self.sp))):
            raise ValueError("pieces of this model cross white-space markers")
        if self.sp.decode(self.sp.encode("ﬁ  ① x ")) != "ﬁ  ① x ":
            raise ValueError("this model's normaliser changes texts")
        self.lone_mark = [self.sp.piece_to_id(MARK)]
        self.table = ChunkTable(self._segment, self._decode, limit=600_000)

    def _segment(self, words: list[str]) -> list[list[int]]:
        # the library puts one marker in front of what it is given, so it is left out here
        ids = self.sp.encode([w[1:] for w in words], num_threads=1)
        return [i if w != MARK else self.lone_mark for w, i in zip(words, ids)]

    def _decode(self, ids: list[list[int]]) -> list[str]:
        # the library drops the marker in front of the first piece; every word starts with one
        return [" " + text for text in self.sp.decode(ids, num_threads=1)]

    def encode_decode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids, ids per text, decoded texts."""
        words = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        flat, length, rows = self.table.joined(words)
        decoded, at, kept = [], 0, self.table.texts
        rows = rows.tolist()
        for ws in words:
            decoded.append("".join([kept[r] for r in rows[at:at + len(ws)]])[1:])
            at += len(ws)
        return flat, length, decoded


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    keep(codec.cache_clear)
    return PieceCodec(model_file)


def encode_decode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids",
                  decoded: str = "decoded") -> DataFrame:
    """The rows of ``docs`` without ``text``, with ``ids`` (array<int>) and ``decoded`` (string).

    ``ids`` equal the library's ``encode(text)`` without begin or end ids; ``decoded`` equals its
    ``decode(ids)``. Columns of ``docs`` named like the results give way to them.
    """
    columns = [c for c in docs.columns if c not in (ids, decoded, text)]
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = T.StructType(source.schema.fields[:-1] + [
        T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("sentencepieces")
        c = codec(model_file)
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                flat, length, back = c.encode_decode(texts[a:b])
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in range(len(columns))] + [
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(back, pa.string())],
                    names=[*columns, ids, decoded])

    return source.mapInArrow(run, schema)
