"""Repeated passages, exact or fuzzy, by collinear chaining of shared k-mer seeds.

Method: of every ``window`` k-mers (``k`` words in a row) of a text the one with the least hash is a seed, so
any ``window + k - 1`` equal words in a row share one. Each seed is joined with its first document in id
order. So is, under one hash, every run of ``min_words`` words whose seeds all stand in several documents: an exact
repeat is met whatever earlier documents hold parts of it. The matches of a pair of documents become segments
(matches on one diagonal), and segments are chained: a chain ascends in both documents and maximises matched words minus ``gap_cost`` per word skipped in
either, found with a Fenwick tree of prefix maxima. A chain that was found is chained anew through all runs of ``FINE`` words that the
two documents share there and ``MARGIN`` words around. Chains are aligned on the words of both documents:
gaps between segments by longest common subsequence, both ends by extension while the score of matches
against mismatches grows. An aligned chain of at least ``min_words`` words, of which ``identity`` are
equal, is a passage; a chain that is none is split where it skips most words, and its parts are tried.

Every exact repeat of ``min_words`` words is found: each of its runs of that length meets the run's first document.
Passages with edits are found by two seeds between the edits: of 100 words or more, with the defaults, nearly all that are
equal at 85 % of their words and about eight in ten at 80 %; of 60 words nearly all at 90 %, half at 85 % (``tests/llm`` measures it).
The earliest document that holds a passage never loses it.

Scale: seeds are about a seventh of the words; runs are a row per word that is repeated, none elsewhere. Each
task matches the seeds of a batch, and the runs of a block, among themselves first and sends on only those of the batch's first document for each seed, so a passage that a third of all
documents share is a few rows per batch in the shuffle, and a document has as many followers as a
batch has rows and batches there are, never all pairs. Texts travel twice: to their repeated seeds and to their chains.
One task holds the matches of one pair of documents, or one text, at a time.

Edge cases: null, empty and short texts have no passages; copies are one passage from end to end; equal
hashes of different words are ignored (64 bits); repeats within one document are not passages; rows of
one id are one document; a null id takes no part; an empty table gives an empty result; other columns are not
read (``passages``) or pass through (``without_passages``).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.llm.chunk_table import blocks
from boreal.llm.storage import shuffle_partitions, written
from boreal.llm.words import block_words, pair, word_hashes, word_spans
from boreal.llm.worker import claim

BLOCK_CHARS = 4_000_000
MARGIN = 64
#: Words of the matches between the selected seeds of a pair that has met.
FINE = 4
#: Share of equal words from which a chain needs no refining.
SURE = 0.95
#: Chains that one row asks of a document's text.
WISHES = 1000
Segment = tuple[int, int, int]  # first word, first word in the source, length


def grams_of(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` words in a row."""
    n = max(0, len(words) - k + 1)
    grams = words[:n]
    for j in range(1, k):
        grams = pair(grams, words[j:n + j])
    return grams


def chosen(grams: np.ndarray, window: int) -> np.ndarray:
    """Position of the least of every ``window`` hashes in a row."""
    if len(grams) <= window:
        return np.array([int(grams.argmin())])
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    return views.argmin(axis=1) + np.arange(len(views))


def seeds(words: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the selected k-mers."""
    grams = grams_of(words, k)
    if not len(grams):
        return words[:0], np.empty(0, np.int64)
    at = np.unique(chosen(grams, window))
    return grams[at], at


def repeatable(words: np.ndarray, shared: np.ndarray, k: int, window: int, size: int) -> np.ndarray:
    """Where ``size`` words in a row may stand elsewhere too: every seed chosen inside them is among ``shared``."""
    n = len(words) - size + 1
    inside = size - k - window + 2  # choices that see no word outside
    if n < 1:
        return np.empty(0, np.int64)
    if inside < 1:
        return np.arange(n)
    known = np.zeros(len(words), bool)
    known[shared[shared < len(words)]] = True
    unknown = np.concatenate([[0], np.cumsum(~known[chosen(grams_of(words, k), window)])])
    return np.flatnonzero(unknown[inside:inside + n] == unknown[:n])


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` words in a row, put together from runs of powers of two."""
    n, out, at, power, runs = len(words) - size + 1, None, 0, 1, words
    while True:
        if size & power:
            part = runs[at:at + n]
            out = part if out is None else pair(out, part)
            at += power
        if 2 * power > size:
            return out
        runs = pair(runs[:-power], runs[power:])
        power *= 2


def segments(x: np.ndarray, y: np.ndarray, k: int, window: int) -> list[Segment]:
    """Matches (positions in the document and its source) merged along diagonals, by position."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    new = np.concatenate([[True], (np.diff(x - y) != 0) | (np.diff(x) > window)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(x)) - 1
    return sorted(zip(x[first].tolist(), y[first].tolist(), (x[last] + k - x[first]).tolist()))


def distinct_points(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(x << 32 | y)
    return both >> 32, both & 0xFFFFFFFF


def run_points(x: np.ndarray, y: np.ndarray, k: int, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Matches of k words, at least every ``window`` words, that stand for matches of ``size`` words (x, y): those that
    overlap on a diagonal are one run of equal words."""
    order = np.lexsort((x, x - y))
    x, shift = x[order], (x - y)[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(shift) != 0) | (np.diff(x) > size)]))
    last = np.append(first[1:], len(x)) - 1
    begin, shift = x[first], shift[first]
    length = x[last] + size - k - begin  # to the last match
    count = length // window + 1
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    points = np.concatenate([np.repeat(begin, count) + window * at, begin + length])
    return points, points - np.concatenate([np.repeat(shift, count), shift])


class PrefixMaxima:
    """Fenwick tree: greatest (score, index) among the first ranks."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(0.0, -1)] * (n + 1)

    def put(self, rank: int, value: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.best):
            if value > self.best[rank]:
                self.best[rank] = value
            rank += rank & -rank

    def upto(self, rank: int) -> tuple[float, int]:
        out = (0.0, -1)
        while rank > 0:
            out = max(out, self.best[rank])
            rank -= rank & -rank
        return out


def chains(parts: list[Segment], gap_cost: float) -> list[list[Segment]]:
    """Chains of segments that ascend in both documents, best first, each segment in one chain."""
    if len(parts) == 1:
        return [parts]
    ends = sorted({y + n for _, y, n in parts})
    rank = {e: r for r, e in enumerate(ends)}
    events = sorted([(x, 1, i) for i, (x, _, _) in enumerate(parts)] + [(x + n, 0, i) for i, (x, _, n) in enumerate(parts)])
    tree, score, before = PrefixMaxima(len(ends)), [0.0] * len(parts), [-1] * len(parts)
    for _, opens, i in events:
        x, y, n = parts[i]
        if opens:  # predecessors end before it in both documents
            low = bisect_right(ends, y)
            best, j = tree.upto(low)
            best -= gap_cost * (x + y)
            score[i], before[i] = (n + best, j) if j >= 0 and best > 0 else (float(n), -1)
        else:
            tree.put(rank[y + n], (score[i] + gap_cost * (x + n + y + n), i))
    used, out = [False] * len(parts), []
    for i in sorted(range(len(parts)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(parts[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def equal_start(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence; equal words at both ends belong to one."""
    if not len(a) or not len(b):
        return 0
    if ends := equal_start(a, b):
        a, b = a[ends:], b[ends:]
    if last := equal_start(a[::-1], b[::-1]):
        a, b, ends = a[:len(a) - last], b[:len(b) - last], ends + last
    if not len(a) or not len(b):
        return ends
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return ends + int((b == a[0]).any())
    row = np.zeros(len(b) + 1, np.int32)
    for w in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == w)))
    return ends + int(row[-1])


def reach(equal: np.ndarray) -> int:
    """How far to extend: where matches (+1) against mismatches (-2) score highest."""
    hits = equal.nonzero()[0]  # the highest score is at a match
    if not len(hits) or len(hits) == len(equal):
        return len(hits)
    score = 3 * np.arange(1, len(hits) + 1) - 2 * (hits + 1)
    best = int(score.argmax())
    return int(hits[best]) + 1 if score[best] > 0 else 0


def align(chain: list[Segment], a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, float]:
    """(begin, end, source begin, source end, share of equal words) of the extended chain in word lists."""
    x, y, _ = chain[0]
    n = min(x, y)
    left = reach(a[x - n:x][::-1] == b[y - n:y][::-1])
    equal = left
    for (x, y, n), after in zip(chain, chain[1:] + [None]):
        equal += int((a[x:x + n] == b[y:y + n]).sum())
        if after:
            equal += common(a[x + n:after[0]], b[y + n:after[1]])
    x, y = x + n, y + n
    n = max(0, min(len(a) - x, len(b) - y))
    right = reach(a[x:x + n] == b[y:y + n])
    begin, source = chain[0][0] - left, chain[0][1] - left
    end, source_end = x + right, y + right
    return begin, end, source, source_end, (equal + right) / max(end - begin, source_end - source, 1)


def refined(chain: list[Segment], a: np.ndarray, b: np.ndarray, gap_cost: float) -> list[Segment]:
    """The best chain through the given one's segments and all runs of ``FINE`` words that both word lists hold: seeds that were
    not selected, or that met another document, come back here."""
    own, other = grams_of(a, FINE), grams_of(b, FINE)
    if not len(own) or not len(other):
        return chain
    known, at = np.unique(other, return_index=True)
    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
    x = np.flatnonzero(known[place] == own)
    found = [(x, at[place[x]])]
    for u, v, n in chain:
        if n >= FINE:
            steps = np.arange(n - FINE + 1)
            same = own[u:u + len(steps)] == other[v:v + len(steps)]
            found.append((u + steps[:len(same)][same], v + steps[:len(same)][same]))
    x, y = (np.concatenate(c) for c in zip(*found))
    if not len(x):
        return chain
    x, y = distinct_points(x, y)
    return chains(segments(x, y, FINE, 1), gap_cost)[0]


def firsts(seed: np.ndarray, doc: np.ndarray, x: np.ndarray, held: tuple | None):
    """First document and position of every row's seed; rows are sorted; ``held`` is the last run's."""
    new = np.concatenate([[True], seed[1:] != seed[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
    src, y = doc[first], x[first]
    if held is not None and held[0] == seed[0]:
        run = first == 0
        src, y = np.where(run, held[1], src), np.where(run, held[2], y)
    return src, y, (seed[-1], src[-1], y[-1])


def of_run(seed: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """Whether any row of every row's run of equal seeds has the flag."""
    first = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
    return np.repeat(np.logical_or.reduceat(flag, first), np.diff(np.append(first, len(seed))))


def packed(x: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The positions from each start to the next as one binary value of 32-bit numbers."""
    offsets = 4 * np.append(starts, len(x)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(x.astype("<i4").tobytes())])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All positions of a column of ``packed`` values, and how many each value has."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] // 4
    values = np.frombuffer(data, "<i4") if data is not None and data.size else np.empty(0, np.int32)
    return values[at[0]:at[-1]].astype(np.int64), np.diff(at)


def rows_of(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """(seed, doc, src, x, y, shared) of places (seed, doc, x), one row per seed and document with all its places; src
    and y where these rows hold an earlier document."""
    seed, doc, x = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((x, doc, seed))
    seed, doc, x = seed[order], doc[order], x[order]
    starts = np.flatnonzero(np.concatenate([[True], (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])])) if len(seed) else order
    places = packed(x, starts)
    if not len(seed):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int64()), places,
                                           pa.array([], pa.int64()), pa.array([], pa.bool_())], names=NAMES)
    seed, doc = seed[starts], doc[starts]
    src, y, _ = firsts(seed, doc, x[starts], None)
    local = src != doc
    return pa.RecordBatch.from_arrays(
        [pa.array(seed.view(np.int64)), pa.array(doc), pa.array(src, mask=~local), places, pa.array(y),
         pa.array(of_run(seed, local))], names=NAMES)


NAMES = ["seed", "doc", "src", "x", "y", "shared"]
ROWS = "seed long, doc long, src long, x binary, y long, shared boolean"


def first_places(rows: DataFrame) -> DataFrame:
    """(doc, src, x, y): the first place (src, y) of the seed at every place (doc, x), for seeds of several documents.
    Places of other seeds may be among the rows, with ``src`` their own document."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            seed, doc, y, shared = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "doc", "y", "shared"))
            x, count = unpacked(batch.column("x"))
            first_x = x[np.cumsum(count) - count]
            src = batch.column("src")
            local = src.is_valid().to_numpy(zero_copy_only=False)
            src, y, shared = src.fill_null(0).to_numpy().copy(), y.copy(), shared.copy()
            if not local.all():
                f = ~local
                own = seed[f]
                before = held
                src[f], y[f], held = firsts(own, doc[f], first_x[f], held)
                # a run may go on in the next batch, or have begun in the last
                cut = (own == own[-1]) | (before is not None and own == before[0])
                shared[f] = of_run(own, shared[f] | (src[f] != doc[f]) | cut)
            every = np.repeat(shared, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (np.repeat(doc, count)[every], np.repeat(src, count)[every], x[every], np.repeat(y, count)[every])],
                names=["doc", "src", "x", "y"])

    dealt = F.when(F.col("src").isNull(), F.col("seed")).otherwise(F.xxhash64("doc", "x"))
    return (rows.repartition(shuffle_partitions(rows.sparkSession), dealt).sortWithinPartitions("seed", "doc")
            .mapInArrow(join, "doc long, src long, x long, y long"))


def seed_places(docs: DataFrame, k: int, window: int, min_words: int) -> DataFrame:
    """(doc, src, x, y): a seed of ``doc`` at word ``x`` stands first in ``src`` at word ``y``."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            found: list[tuple[np.ndarray, ...]] = []
            for a, b in blocks(texts, BLOCK_CHARS):
                words, sizes = block_words(texts[a:b])
                for i, w in zip(ids[a:b], np.split(words, np.cumsum(sizes)[:-1])):
                    if len(w) >= min_words // 2:
                        seed, at = seeds(w, k, window)
                        found.append((seed, np.full(len(at), i), at))
            if found:
                yield rows_of(found)

    return first_places(docs.mapInArrow(collect, ROWS))


def window_places(docs: DataFrame, places: DataFrame, k: int, window: int, min_words: int) -> DataFrame:
    """(doc, src, x, y): the ``min_words`` words of ``doc`` from ``x`` stand first in ``src`` from ``y``."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            shared = batch.column("places")
            for a, b in blocks(texts, BLOCK_CHARS):
                found = []
                words, sizes = block_words(texts[a:b])
                for j, w in zip(range(a, b), np.split(words, np.cumsum(sizes)[:-1])):
                    at = repeatable(w, shared[j].values.to_numpy(), k, window, min_words)
                    if len(at):
                        found.append((run_hashes(w, min_words)[at], np.full(len(at), ids[j]), at))
                if found:
                    yield rows_of(found)

    held = places.groupBy("doc").agg(F.collect_set("x").alias("places"))
    return first_places(docs.join(held, docs["doc_id"] == held["doc"]).select("doc_id", "text", "places").mapInArrow(collect, ROWS))


def chained(found: DataFrame, k: int, window: int, min_words: int, gap_cost: float) -> DataFrame:
    """(doc, src, begin, end, source_begin, source_end, segments) of every chain of two seeds' words at least; rows of
    ``found`` are k words, or ``min_words`` where ``whole``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "src", "x", "y", "whole")]
            if held is not None:
                now = [np.concatenate(c) for c in zip(held, now)]
            if not len(now[0]):
                continue
            new = np.flatnonzero(np.concatenate([[True], (np.diff(now[0]) != 0) | (np.diff(now[1]) != 0)]))
            held = [c[new[-1]:] for c in now]
            yield rows([[c[a:b] for c in now] for a, b in zip(new[:-1], new[1:])])
        if held is not None:
            yield rows([held])

    def rows(groups: list[list[np.ndarray]]) -> pa.RecordBatch:
        out = []
        for doc, src, x, y, whole in groups:
            if whole.any():
                x, y = (np.concatenate([c[~whole], more]) for c, more in zip((x, y), run_points(x[whole], y[whole], k, window, min_words)))
                x, y = distinct_points(x, y)
            for chain in chains(segments(x, y, k, window), gap_cost):
                (begin, source, _), (x1, y1, n) = chain[0], chain[-1]
                if x1 + n - begin < 2 * k:  # a common phrase
                    continue
                out.append((int(doc[0]), int(src[0]), begin, x1 + n, source, y1 + n, np.array(chain, np.int64).tobytes()))
        columns = list(zip(*out)) if out else [()] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
            names=["doc", "src", "begin", "end", "source_begin", "source_end", "segments"])

    return (found.repartition(shuffle_partitions(found.sparkSession), "doc", "src").sortWithinPartitions("doc", "src")
            .mapInArrow(run, "doc long, src long, begin long, end long, source_begin long, source_end long, segments binary"))


def aligned(chain_rows: DataFrame, docs: DataFrame, min_words: int, identity: float, gap_cost: float) -> DataFrame:
    """(doc_id, begin, end, source_id, source_begin, source_end, identity) of every passage, in words."""
    key = ["doc", "src", "begin", "source_begin"]

    def request(own: str, side: int, first: str, last: str) -> DataFrame:
        return chain_rows.select(F.col(own).alias("doc_id"), F.struct(
            *key, F.lit(side).alias("side"), F.col(first).alias("from"), F.col(last).alias("to"),
            (F.col("segments") if side == 0 else F.lit(None).cast("binary")).alias("segments")).alias("wish"))

    wishes = request("doc", 0, "begin", "end").union(request("src", 1, "source_begin", "source_end"))
    # a source of many chains is asked for in several rows of about WISHES each, every one with its text
    many = written(wishes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > WISHES).select(
        "doc_id", F.ceil(F.col("n") / WISHES).alias("parts")), "many-chains")  # written, so that its size is known
    part = F.pmod(F.xxhash64("wish.doc", "wish.begin", "wish.source_begin"), F.coalesce("parts", F.lit(1)))
    wishes = (wishes.join(many, "doc_id", "left").groupBy("doc_id", part.alias("part"))
              .agg(F.collect_list("wish").alias("wishes")))
    spans_schema = "doc long, src long, begin long, source_begin long, side int, shift long, segments binary, words binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for batch in batches:
            wanted = batch.column("wishes")
            wish = dict(zip((f.name for f in wanted.type.value_type), wanted.flatten().flatten()))
            shift = np.maximum(0, wish["from"].to_numpy() - MARGIN)
            spans = list(zip(shift.tolist(), (wish["to"].to_numpy() + MARGIN).tolist()))
            parts, at = [], 0
            for text, n in zip(batch.column("text"), wanted.value_lengths().to_pylist()):
                words = word_hashes(text.as_py())
                parts += [words[a:b].tobytes() for a, b in spans[at:at + n]]
                at += n
            yield pa.RecordBatch.from_arrays(
                [*(wish[c] for c in key), wish["side"], pa.array(shift), wish["segments"], pa.array(parts, pa.binary())],
                names=[*key, "side", "shift", "segments", "words"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in (*key, "side", "shift", "segments", "words"))):
                if row[4] == 0:
                    held = row
                elif held and held[:4] == row[:4]:
                    out += passages_of(held, row)
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.float64())],
                names=["doc_id", "begin", "end", "source_id", "source_begin", "source_end", "identity"])

    def passages_of(one: tuple, other: tuple) -> list[tuple]:
        doc, src, _, _, _, dx, chain, words = one
        dy = other[5]
        a, b = np.frombuffer(words, np.uint64), np.frombuffer(other[7], np.uint64)
        whole = [(x - dx, y - dy, n) for x, y, n in np.frombuffer(chain, np.int64).reshape(-1, 3).tolist()]
        good = alike(whole, a, b)
        if not good or min(p[4] for p in good) < SURE:
            good = alike(refined(whole, a, b, gap_cost), a, b) or good
        return [(doc, p[0] + dx, p[1] + dx, src, p[2] + dy, p[3] + dy, p[4]) for p in good]

    def alike(chain: list[Segment], a: np.ndarray, b: np.ndarray) -> list[tuple]:
        """The passages of a chain: itself, or those of its parts."""
        good, parts = [], [chain]
        while parts:
            chain = parts.pop()
            p = align(chain, a, b)
            if p[1] - p[0] >= min_words and p[4] >= identity:
                good.append(p)
            elif len(chain) > 1:
                skipped = [t[0] - s[0] + t[1] - s[1] - 2 * s[2] for s, t in zip(chain, chain[1:])]
                cut = skipped.index(max(skipped)) + 1
                parts += [chain[:cut], chain[cut:]]
        return good

    spans = wishes.join(docs, "doc_id").select("text", "wishes").mapInArrow(cut, spans_schema)
    return (spans.repartition(shuffle_partitions(docs.sparkSession), *key).sortWithinPartitions(*key, "side")
            .mapInArrow(meet, "doc_id long, begin long, end long, source_id long, source_begin long, source_end long, identity double"))


def passages(docs: DataFrame, k: int = 6, window: int = 12, min_words: int = 50, identity: float = 0.8,
             gap_cost: float = 0.03, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages [begin, end) of a document, in words, that stand in a source with a smaller id:
    (doc_id, begin, end, source_id, source_begin, source_end, identity)."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    places = written(seed_places(source, k, window, min_words), "seeds")
    found = places.withColumn("whole", F.lit(False)).union(
        window_places(source, places, k, window, min_words).withColumn("whole", F.lit(True))).filter("src != doc")
    return aligned(written(chained(found, k, window, min_words, gap_cost), "chains"), source, min_words, identity, gap_cost)


def without_passages(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words of the passages ``found`` (doc_id, begin, end) cut out of ``text``."""
    cuts = found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("__cuts"))
    joined = docs.join(cuts, F.col(f"`{doc_id}`").cast("long") == F.col("__id"), "left").drop("__id")
    names = docs.columns
    at = names.index(text)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cleaned = [t if c is None or t is None else without(t, [(p["begin"], p["end"]) for p in c])
                       for t, c in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(cleaned, pa.string()) if i == at else batch.column(i)
                                              for i in range(len(names))], names=names)

    return joined.mapInArrow(run, schema)


def without(text: str, cuts: list[tuple[int, int]]) -> str:
    """The text without the words of sorted ranges, and the white space after each."""
    data = text.encode()
    begin, _ = word_spans(np.frombuffer(data, np.uint8))
    edge = np.append(begin, len(data))
    out, at = [], 0
    for a, b in cuts:
        a, b = int(edge[min(a, len(begin))]), int(edge[min(b, len(begin))])
        if a > at:
            out.append(data[at:a])
        at = max(at, b)
    out.append(data[at:])
    return b"".join(out).decode()
