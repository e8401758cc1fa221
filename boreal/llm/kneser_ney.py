"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, scored from memory-mapped arrays.

Method: the tokens of a text are its words and one end, after ``order - 1`` begin marks. Spark counts the distinct n-grams of
``order`` tokens (combined in each task before the shuffle, dealt out by their hash, so that a frequent word's n-grams
spread). Level by level these become the tables of shorter n-grams: an n-gram's number, its continuations (distinct
tokens before it) and, as a context, its total and the number of followers seen once, twice and more. Tables are stored as
sorted hash arrays, one set of files per bucket, in the shared folder; workers memory-map them and look
n-grams up by binary search. Discounts come from the counts of counts of each level. The probability of a word after a
context interpolates the discounted n-gram with the probability after the context without its first token, down to the
discounted continuation unigram, and that with one over the vocabulary and one unknown word: all words' probabilities add up to one.

Scale: tasks hold the distinct n-grams of one partition or bucket; words travel as 64-bit hashes, once per block, n-grams as
numbers of words. Only counts of counts (a few numbers
per bucket, added up by Spark) reach the driver. A lost task is redone: it writes its files under
another name first and renames them. Files on a store that cannot be memory-mapped are copied once to a
worker's own temporary folder, which is removed when the worker ends.

Edge cases: null and empty texts are one end token; null ids and null texts are ordinary rows; unseen
words share the unknown word's probability; a model of no texts gives every token probability one; repeated
rows count each; an empty table gives an empty result; other columns pass through unless named like the
results.
"""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.llm.chunk_table import blocks
from boreal.llm.storage import input_bytes, shuffle_partitions
from boreal.llm.words import block_words, pair
from boreal.llm.worker import claim, keep
from boreal.session import checkpoint_root

BEGIN, END = 1, 2
BLOCK_CHARS = 4_000_000
HELD_TOKENS = 2_500_000
#: Estimated input per bucket (columns weigh by their declared types), so that a task that merges one stays small whatever the input.
BUCKET_BYTES = 6 << 20
#: Columns of the tables of shorter n-grams, after the hash.
COLUMNS = ("count", "continuations", "total", "once", "twice", "more")


def ngrams(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The tokens of all n-grams of the texts, first to last, and the number of tokens of each text."""
    words, sizes = block_words(texts)
    ends = np.cumsum(sizes + 1) - 1
    token = np.empty(len(words) + len(texts), np.uint64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = words
    token[ends] = END
    out = [token]
    for _ in range(order - 1):  # the token before, a begin mark at the first of a text
        before = np.empty_like(token)
        before[1:] = out[0][:-1]
        before[ends - sizes] = BEGIN
        out.insert(0, before)
    return out, sizes + 1


def key_of(grams: list[np.ndarray]) -> np.ndarray:
    """One hash of the tokens in order; a single token is its own."""
    key = grams[0]
    for g in grams[1:]:
        key = pair(key, g)
    return key


def combined(keys: np.ndarray, columns: list[np.ndarray], added: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows by distinct sorted key; the last ``added`` columns are added up, of the others one is kept."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    kept = len(columns) - added
    out = [c[order][first] for c in columns[:kept]]
    out += [np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns[kept:]]
    return keys[first], out


def small(a: np.ndarray) -> np.ndarray:
    most = int(a.max(initial=0))
    return a.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def written_numbers(a: np.ndarray) -> bytes:
    """The numbers in as few bytes each as the greatest needs, after that number of bytes."""
    a = small(a)
    return bytes([a.itemsize]) + a.tobytes()


def read_numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def written_grams(grams: list[np.ndarray]) -> tuple[bytes, bytes]:
    """The distinct words of the n-grams, and the n-grams as numbers of words, column by column."""
    words, numbers = np.unique(np.concatenate(grams), return_inverse=True)
    return words.astype("<u8").tobytes(), written_numbers(numbers)


def read_grams(words: bytes, numbers: bytes, length: int) -> np.ndarray:
    """Rows of tokens, ``length`` of them."""
    return np.frombuffer(words, "<u8")[read_numbers(numbers)].reshape(length, -1)


def dealt(number: np.ndarray, columns: list[bytes | np.ndarray], buckets: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(number, kind="stable")
    cut = np.searchsorted(number[order], np.arange(buckets + 1))
    for b in range(buckets):
        if cut[b] < cut[b + 1]:
            at = order[cut[b]:cut[b + 1]]
            yield b, [c[at] for c in columns]


def store(folder: str, name: str, a: np.ndarray) -> None:
    files, path = fs.FileSystem.from_uri(folder)
    buffer = io.BytesIO()
    np.save(buffer, a)
    part = f"{path}/{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(buffer.getvalue())
    files.move(part, f"{path}/{name}.npy")


class Tables:
    """Memory-mapped files of one model, opened when first met."""

    known: dict[str, "Tables"] = {}

    def __init__(self, folder: str):
        self.files, self.path = fs.FileSystem.from_uri(folder)
        self.open: dict[str, np.ndarray | None] = {}
        self.copies = None

    @classmethod
    def of(cls, folder: str) -> "Tables":
        if folder not in cls.known:
            cls.known.clear()
            keep(cls.known.clear)
            cls.known[folder] = cls(folder)
        return cls.known[folder]

    def array(self, name: str) -> np.ndarray:
        if name not in self.open:
            path = f"{self.path}/{name}.npy"
            if self.files.get_file_info(path).type == fs.FileType.NotFound:
                self.open[name] = np.empty(0, np.uint64)
            else:
                if not isinstance(self.files, fs.LocalFileSystem):
                    if self.copies is None:
                        self.copies = tempfile.mkdtemp(prefix="boreal-model-")
                        atexit.register(shutil.rmtree, self.copies, True)
                    local = os.path.join(self.copies, f"{name}.npy")
                    fs.copy_files(path, local, source_filesystem=self.files)
                    path = local
                self.open[name] = np.load(path, mmap_mode="r")
        return self.open[name]

    def rows(self, table: str, columns: tuple[str, ...], keys: np.ndarray, number: np.ndarray, buckets: int) -> list[np.ndarray]:
        """Columns of the sorted distinct ``keys``; zero where a key is missing."""
        out = [np.zeros(len(keys), np.float64) for _ in columns]
        for b, (at,) in dealt(number, [np.arange(len(keys))], buckets):
            known = self.array(f"{table}-{b}-key")
            if len(known):
                where = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
                hit = known[where] == keys[at]
                for o, c in zip(out, columns):
                    o[at[hit]] = self.array(f"{table}-{b}-{c}")[where[hit]]
        return out


@dataclass
class Model:
    folder: str
    buckets: int
    order: int
    tokens: int = 0
    vocabulary: int = 0
    continuations: int = 0
    #: Of each level from the words up: discounts of n-grams seen 0, 1, 2, 3+ times.
    discounts: list[list[float]] = field(default_factory=list)
    word_rest: float = 1.0  # what the discounts take from the continuation unigram

    def log_probabilities(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 of the model's probability of the n-grams' last tokens, log10 of the add-one unigram, and whether the token is
        known."""
        tables = Tables.of(self.folder)
        _, first, back = np.unique(key_of(grams), return_index=True, return_inverse=True)
        grams = [g[first] for g in grams]
        d = self.discounts or [[0.0] * 4] * self.order
        words, v = np.unique(grams[-1], return_inverse=True)
        count, cont = self.rows(tables, 1, COLUMNS[:2], words)
        unigram = np.full(len(words), self.word_rest / (self.vocabulary + 1))
        if self.continuations:
            unigram += self.less(cont, d[0]) / self.continuations
        p = unigram[v]
        for level in range(2, self.order + 1):
            gram = grams[-level:]
            contexts, u = np.unique(key_of(gram[:-1]), return_inverse=True)
            total, once, twice, more = self.rows(tables, level - 1, COLUMNS[2:], contexts)
            keys, k = np.unique(key_of(gram), return_inverse=True)
            seen, = self.rows(tables, level, ("count" if level == self.order else "continuations",), keys)
            of = np.maximum(total, 1)
            rest = np.where(total > 0, (d[level - 1][1] * once + d[level - 1][2] * twice + d[level - 1][3] * more) / of, 1.0)
            p = self.less(seen, d[level - 1])[k] / of[u] + rest[u] * p
        base = np.log10((count[v] + 1) / (self.tokens + self.vocabulary + 1))
        return np.log10(p)[back], base[back], (count[v] > 0)[back]

    @staticmethod
    def less(seen: np.ndarray, discount: list[float]) -> np.ndarray:
        return np.maximum(seen - np.array(discount)[np.minimum(seen, 3).astype(int)], 0)

    def rows(self, tables: "Tables", level: int, columns: tuple[str, ...], keys: np.ndarray) -> list[np.ndarray]:
        return tables.rows(f"grams{level}", columns, keys, self.bucket(keys), self.buckets)

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % self.buckets


def discounts(counts: list[float]) -> list[float]:
    """Modified Kneser-Ney discounts from the numbers of things seen once, twice, three and four times."""
    n = [0.0, *map(float, counts)]
    if not (n[1] and n[2]):
        return [0.0, 0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    return [0.0] + [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5, 0.1), k - 0.05) for k in (1, 2, 3)]


def times(a: np.ndarray) -> list[int]:
    return [int((a == k).sum()) for k in (1, 2, 3, 4)]


def by_bucket(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Groups rows, sorted by bucket, of consecutive batches."""
    held, number = [], None
    for batch in rows:
        for row in batch.to_pylist():
            if row["bucket"] != number and held:
                yield number, held
                held = []
            number = row["bucket"]
            held.append(row)
    if held:
        yield number, held


def train(docs: DataFrame, order: int = 3, text: str = "text") -> Model:
    """Counts all rows of ``docs`` and writes the files of a model of n-grams of ``order`` tokens to the shared folder."""
    if order < 2:
        raise ValueError("a model needs n-grams of two tokens at least")
    spark = docs.sparkSession
    folder = f"{checkpoint_root(spark).rstrip('/')}/boreal/ngrams-{uuid.uuid4().hex}"
    buckets = max(shuffle_partitions(spark), min(input_bytes(docs) // BUCKET_BYTES, 1 << 16))
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    model = Model(folder, buckets, order)
    schema = "bucket int, words binary, grams binary, columns array<binary>, stats array<long>"
    names = ["bucket", "words", "grams", "columns", "stats"]

    def rows(grams: list[np.ndarray], columns: list[np.ndarray], stats: list[int]) -> Iterator[pa.RecordBatch]:
        """Distinct n-grams with their columns, a row per bucket; ``stats`` travel with the first."""
        side = np.argsort(grams[0], kind="stable")  # equal first tokens side by side compress in the shuffle
        grams, columns = [g[side] for g in grams], [c[side] for c in columns]
        for b, part in dealt(model.bucket(key_of(grams)), [*grams, *columns], buckets):
            words, numbers = written_grams(part[:len(grams)])
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([b], pa.int32()), "words": [words], "grams": [numbers],
                "columns": pa.array([[written_numbers(c) for c in part[len(grams):]]], pa.list_(pa.binary())),
                "stats": pa.array([stats], pa.list_(pa.int64()))})
            stats = [0] * len(stats)

    def packed(held: list[list[np.ndarray]], level: int) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*held)]
        held.clear()
        _, out = combined(key_of(columns[:level]), columns, len(columns) - level)
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("kneser_ney")
        held: list[list[np.ndarray]] = []
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            out = packed(held, order)
            yield from rows(out[:order], out[order:], [])

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                grams, _ = ngrams(texts[a:b], order)
                held.append([*grams, np.ones(len(grams[0]), np.int32)])
                size += len(grams[0])
                if size > HELD_TOKENS * 2 // order:
                    yield from emit()
                    size = 0
        if held:
            yield from emit()

    def merge(level: int):
        """Stores the n-grams of ``level`` tokens and gives those of one token less: their suffixes, and their contexts."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, found in by_bucket(batches):
                grams = np.concatenate([read_grams(r["words"], r["grams"], level) for r in found], axis=1)
                columns = [np.concatenate([read_numbers(r["columns"][k]) for r in found]) for k in range(len(found[0]["columns"]))]
                stats = np.sum([r["stats"] for r in found], axis=0, dtype=np.int64).tolist()
                del found
                keys, out = combined(key_of(list(grams)), [*grams, *columns], len(columns))
                grams, columns = out[:level], out[level:]
                store(folder, f"grams{level}-{b}-key", keys)
                for name, c in zip(COLUMNS, columns):
                    if name != "count" or level in (1, order):  # of the levels between only continuations are asked for
                        store(folder, f"grams{level}-{b}-{name}", small(c))
                value = columns[0] if level == order else columns[1]
                stats = times(value) + stats
                if level == 1:
                    stats += [int((value > 2).sum()), int(columns[0].sum()), int((value > 0).sum()), int(value.sum())]
                    yield pa.RecordBatch.from_pydict({"stats": pa.array([stats], pa.list_(pa.int64()))})
                    continue
                seen = value > 0  # others are contexts only
                value, raw = value[seen], columns[0][seen]
                one, none = np.ones_like(value), np.zeros_like(value)
                tokens = [g[seen] for g in grams]
                shorter = [np.concatenate([s, c]) for s, c in zip(tokens[1:], tokens[:-1])]
                more = [np.concatenate(c) for c in (
                    (raw, none), (one, none), (none, value), (none, (value == 1).astype(np.int64)),
                    (none, (value == 2).astype(np.int64)), (none, (value > 2).astype(np.int64)))]
                out = packed([[*shorter, *more]], level - 1)
                yield from rows(out[:level - 1], out[level - 1:], stats)

        return run

    def in_buckets(df: DataFrame) -> DataFrame:
        return df.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")

    source = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    counted = source.mapInArrow(count, schema)
    for level in range(order, 0, -1):
        counted = in_buckets(counted).mapInArrow(merge(level), schema if level > 1 else "stats array<long>")
    found = counted.select(F.posexplode("stats").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    n = {r["k"]: r["n"] for r in found}
    if n:
        model.discounts = [discounts([n[4 * level + k] for k in range(4)]) for level in range(order)]
        e, (more, model.tokens, model.vocabulary, model.continuations) = model.discounts[0], [n[4 * order + k] for k in range(4)]
        model.word_rest = (e[1] * n[0] + e[2] * n[1] + e[3] * more) / model.continuations
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but ``text``, with n_tokens, n_known, base_score and score (log10)."""
    results = ["n_tokens", "n_known", "base_score", "score"]
    columns = [c for c in docs.columns if c not in (*results, text)]
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = T.StructType(source.schema.fields[:-1] + [
        T.StructField(r, t) for r, t in zip(results, (T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("kneser_ney")
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                grams, sizes = ngrams(texts[a:b], model.order)
                p, base, known = model.log_probabilities(grams)
                first = np.cumsum(sizes) - sizes
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(columns))] + [
                        pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), first)),
                        pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(p, first))],
                    names=[*columns, *results])

    return source.mapInArrow(run, schema)
