"""Join of all documents whose shingle sets overlap, by a token-group matrix.

Method: every distinct set belongs to one group of similar sets: same size band, same least hash among its
tokens, or among its popular tokens where those are at least half of it (near copies of one text share
them, whatever was edited). The matrix has, for every token, the groups whose token union holds it.
A set linked to a member of a group shares at least ``s`` tokens of its prefix with the union of
that group's prefixes, if prefixes are ``s`` tokens longer than linked sets may differ. So the matrix keeps
prefix tokens only: the number of prefix tokens that a set shares with a group's union bounds their overlap,
and only groups that reach ``s``, in a size band next to the set's own, are opened. ``s`` is a ``SHARE``-th of the
band's smallest sets, 3 at least where they must share so many: a passage that two texts share gives its part of the prefix only. In an opened group overlaps are counted exactly on whole sets, from
the texts. The result is the same as comparing all pairs.

Order of the prefixes: tokens are ordered by how often their hash bucket occurs in the corpus, counted over
all documents, then by hash. Any order gives the same result; rare first keeps the matrix selective. There is a
bucket per ``SKETCH_BYTES`` of estimated input, 2^20 at least and 2^23 (32 MB) at most.

Scale: equal sets are one set before anything is joined, and postings are combined in each task before the
shuffle. The postings of a token that occurs in very many documents are cut into parts by set, and every part gets the list of
the token's groups, so no task holds all of them. A group with more tokens than ``OPEN_TOKENS`` is cut into blocks that are compared block by
block, so no task holds an unbounded group; inside, a set already linked to another through others is not
compared with it again, so groups of near copies cost about one pass instead of all pairs. Links are
those needed for the components, not all pairs.

Edge cases: null or empty texts and texts without words have an empty set, linked with nothing; repeated
rows and copies are linked; rows of one id are one node; a null id has no links and no component; ties
in the order cannot occur between distinct tokens; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.chunk_table import blocks
from boreal.llm.components import components
from boreal.llm.storage import input_bytes, shuffle_partitions, written
from boreal.llm.words import GOLDEN, block_words, mix, shingles
from boreal.llm.worker import claim

SHARE, LEAST_SHARED = 16, 3
SKETCH_BYTES, LEAST_BITS, MOST_BITS = 1024, 20, 23
SLICES = 16
#: Bits of a group's number that hold the size band, and the size that bands are prepared for (in tokens).
BAND, MOST_TOKENS = (1 << 16) - 1, 1 << 40
OPEN_TOKENS = 2_000_000
#: Documents of a token's bucket from which its postings are cut into parts, and the kinds of rows of a token.
PART_POSTINGS = 100_000
POSTING, OWN, MARK = 0, 1, 2
BLOCK_CHARS = 4_000_000


def bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """The sketch bucket of every token; ``buckets`` is a power of two."""
    return (tokens >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def text_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every text."""
    words, counts = block_words(texts)
    return [shingles(w, size) for w in np.split(words, np.cumsum(counts)[:-1])]


def set_key(tokens: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        return np.array([mix(tokens).sum(), np.bitwise_xor.reduce(mix(tokens + GOLDEN)) + np.uint64(len(tokens))],
                        np.uint64).tobytes()


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` tokens with any set that it links to."""
    return -(-n * percent // 100)


def band(n: int, percent: int) -> int:
    """Linked sets' sizes lie in the same or adjacent bands."""
    return int(np.log(n) / -np.log(percent / 100) + 1e-9)


def shared(bands: int, percent: int) -> int:
    """How many prefix tokens linked sets share at least, if the smaller is of this band: no more than the
    least overlap that the smallest sets of the band may link with."""
    smallest = int((100 / percent) ** bands)
    return min(needed(max(1, smallest), percent), max(LEAST_SHARED, smallest // SHARE))


def prefix(tokens: np.ndarray, weight: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens in the global order: enough for linked sets to share ``shared`` of them."""
    n = len(tokens)
    length = min(n, n - needed(n, percent) + shared(band(n, percent), percent))
    order = np.lexsort((tokens, weight[bucket(tokens, len(weight))]))
    return tokens[order[:length]]


def group_of(tokens: np.ndarray, weight: np.ndarray, popular: float, percent: int) -> np.uint64:
    """The group's number: its least hash, with the size band in the lowest bits."""
    hashes = mix(tokens + GOLDEN)
    common = weight[bucket(tokens, len(weight))] >= popular
    least = hashes[common].min() if 2 * common.sum() >= len(tokens) else hashes.min()
    return least & ~np.uint64(BAND) | np.uint64(band(len(tokens), percent))


def parts_of(tokens: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """Into how many parts of about ``most`` the postings of every token are cut: by the documents that its bucket occurs in."""
    return (weight[bucket(tokens, len(weight))] // most + 1).astype(np.uint64)


def part_name(tokens: np.ndarray, part: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A token of its own for every part; a token of one part is its own name."""
    return np.where(parts > 1, mix(tokens + part * GOLDEN), tokens)


def document_sets(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Rows (doc_id, n, set) of all documents, and how often each hash bucket occurs in their sets."""
    bits = min(MOST_BITS, max(LEAST_BITS, (input_bytes(docs) // SKETCH_BYTES).bit_length()))
    buckets = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in blocks(texts, BLOCK_CHARS):
                sets = text_sets(texts[a:b], size)
                total += np.bincount(bucket(np.concatenate(sets), buckets), minlength=buckets)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(a, b - a), "n": pa.array(map(len, sets), pa.int64()),
                    "set": pa.array(map(set_key, sets), pa.binary()), "slice": pa.nulls(b - a, pa.int32()),
                    "counts": pa.nulls(b - a, pa.binary())})
        if total.any():
            for k, part in enumerate(np.split(total, SLICES)):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()), "set": pa.nulls(1, pa.binary()),
                    "slice": pa.array([k], pa.int32()), "counts": pa.array([part.astype("<i8").tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, "<i8")
        for k, total in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "counts": [total.tobytes()]})

    rows = written(docs.mapInArrow(run, "doc_id long, n long, set binary, slice int, counts binary"), "shingle-sets")
    slices = (rows.filter("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice")
              .mapInArrow(add, "slice int, counts binary").collect())
    weight = np.zeros(buckets, np.int64)
    for r in slices:
        weight[r["slice"] * (buckets // SLICES):][:buckets // SLICES] = np.frombuffer(r["counts"], "<i8")
    return rows.filter("slice IS NULL").select("doc_id", "n", "set"), weight


def opened(docs: DataFrame, weight: np.ndarray, size: int, percent: int) -> DataFrame:
    """(group, key) of the sets to compare in every group: its members and the sets that may link to one.

    ``key`` is the first half of a set's 128 bits."""
    weight = weight.astype(np.uint32 if weight.max(initial=0) < 1 << 32 else np.int64)
    # smaller sets link to equal ones only: one token more is too much
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    partitions = shuffle_partitions(docs.sparkSession)
    part_postings = PART_POSTINGS
    popular = 2 * float(weight.mean()) + 8  # well above what a bucket of rare tokens holds
    least_shared = np.array([shared(b, percent) for b in range(band(MOST_TOKENS, percent) + 1 if percent < 100 else 1)])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            seen: set[bytes] = set()  # copies in this batch are posted once
            for a, b in blocks(texts, BLOCK_CHARS):
                token, key, group, kind = [], [], [], []
                for tokens in text_sets(texts[a:b], size):
                    if len(tokens) >= least and (k := set_key(tokens)) not in seen:
                        seen.add(k)
                        first = prefix(tokens, weight, percent)
                        g = group_of(tokens, weight, popular, percent)
                        half = np.frombuffer(k, np.uint64)[0]
                        parts = parts_of(first, weight, part_postings)
                        token.append(part_name(first, half % parts, parts))
                        kind.append(np.where(np.arange(len(first)) == 0, OWN, POSTING).astype(np.int8))
                        hot = np.flatnonzero(parts > 1)
                        if len(hot):  # every part of a frequent token knows the group
                            every = np.repeat(hot, parts[hot].astype(np.int64))
                            number = np.arange(len(every)) - np.repeat(np.cumsum(parts[hot]) - parts[hot], parts[hot].astype(np.int64))
                            token.append(part_name(first[every], number.astype(np.uint64), parts[every]))
                            kind.append(np.full(len(every), MARK, np.int8))
                        n = len(token[-1]) + (len(first) if len(hot) else 0)
                        key.append(np.concatenate([np.full(len(first), half), np.zeros(n - len(first), np.uint64)]))
                        group.append(np.full(n, g))
                if token:
                    rows = [np.concatenate(c) for c in (token, group, key, kind)]
                    extra = rows[3] == MARK
                    if extra.any():  # once per part and group
                        marks = np.unique(np.stack([c[extra] for c in rows[:2]]), axis=1)
                        none = np.zeros(marks.shape[1], np.uint64)
                        rows = [np.concatenate([c[~extra], m]) for c, m in zip(rows, (*marks, none, np.full(len(none), MARK, np.int8)))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.view(np.int64)) for c in rows[:3]] + [pa.array(rows[3])], names=["token", "group", "key", "kind"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by token, group and key: the matrix row of a token (or of a part of one) is its run of groups."""
        claim("jaccard_join")
        held: list[list[np.ndarray]] = []  # of the last token, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("token", "group", "key", "kind")]
            if held and held[-1][0][-1] != now[0][-1] or not held and now[0][0] != now[0][-1]:
                cut = np.searchsorted(now[0], now[0][-1])
                yield from visits(*[np.concatenate(c) for c in zip(*held, [c[:cut] for c in now])])
                held, now = [], [c[cut:] for c in now]
            held.append(now)
        if held:
            yield from visits(*[np.concatenate(c) for c in zip(*held)])

    def visits(token: np.ndarray, group: np.ndarray, key: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (key[1:] != key[:-1]) | (group[1:] != group[:-1]) | (
            (kind[1:] == MARK) != (kind[:-1] == MARK))])
        token, group, key, kind = token[fresh], group[fresh], key[fresh], kind[fresh]
        own, posting = kind == OWN, kind != MARK
        yield batch_of(group[own], key[own], 1, np.ones(int(own.sum()), np.int64))  # members
        new_token = np.concatenate([[True], token[1:] != token[:-1]])
        new_group = new_token | np.concatenate([[True], group[1:] != group[:-1]])
        starts = np.flatnonzero(new_token)
        ends = np.append(starts[1:], len(token))
        several = np.add.reduceat(new_group.astype(np.int64), starts) > 1
        for a, b in zip(starts[several].tolist(), ends[several].tolist()):
            groups = group[a:b][new_group[a:b]]
            bands = groups & BAND
            for g, w in zip(groups.tolist(), bands.tolist()):  # sets of a lower group visit a higher one
                near = (group[a:b] < g) & posting[a:b] & (np.abs((group[a:b] & BAND) - w) <= 1)
                if near.any():
                    k = key[a:b][near]
                    yield batch_of(np.full(len(k), g), k, 1, least_shared[np.minimum(group[a:b][near] & BAND, w)])

    def batch_of(group: np.ndarray, key: np.ndarray, found: int, least: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (group, key, np.full(len(key), found), least)],
                                          names=["group", "key", "shared", "least"])

    postings = docs.select("text").mapInArrow(post, "token long, group long, key long, kind byte")
    met = (postings.repartition(partitions, "token").sortWithinPartitions("token", "group", "key")
           .mapInArrow(meet, "group long, key long, shared long, least long"))
    return (met.groupBy("group", "key").agg(F.sum("shared").alias("shared"), F.max("least").alias("least"))
            .filter("shared >= least").select("group", "key"))


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets that join all sets that links connect: exact overlaps, no pair twice."""
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    starts = np.cumsum(sizes) - sizes
    root = np.arange(len(sets))
    mark = np.zeros(int(flat.max()) + 1, bool)
    links = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        others = (root != root[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        if not others.any():
            continue
        own = flat[starts[i]:starts[i] + sizes[i]]
        mark[own] = True
        if others.sum() * 4 > len(sets):
            overlap = np.bincount(owner, mark[flat], len(sets))
        else:
            overlap = np.zeros(len(sets))
            for j in np.flatnonzero(others).tolist():
                overlap[j] = mark[flat[starts[j]:starts[j] + sizes[j]]].sum()
        mark[own] = False
        found = np.flatnonzero(others & (100 * overlap >= percent * (sizes + sizes[i] - overlap)))
        for j in found.tolist():
            if root[j] != root[i]:
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def compare(open_sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) inside every group of ``open_sets`` (group, doc_id, n)."""
    groups = open_sets.groupBy("group").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens")).filter("sets > 1")
    parts = F.ceil(F.col("tokens") / OPEN_TOKENS).cast("int")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    tasks = (open_sets.join(groups, "group").withColumn("parts", parts).withColumn("part", part)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("doc_id", F.xxhash64("group", F.least("part", "other"), F.greatest("part", "other")).alias("task")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("jaccard_join")
        task, ids, texts = None, [], []
        for batch in batches:
            out = []
            for t, i, text in zip(*(batch.column(k).to_pylist() for k in ("task", "doc_id", "text"))):
                if t != task:
                    out += close(ids, texts)
                    task, ids, texts = t, [], []
                ids.append(i)
                texts.append(text)
            yield pairs(out)
        yield pairs(close(ids, texts))

    def close(ids: list[int], texts: list[str]) -> list[tuple[int, int]]:
        if len(ids) < 2:
            return []
        sets = [s for a, b in blocks(texts, BLOCK_CHARS) for s in text_sets(texts[a:b], size)]
        return [(ids[i], ids[j]) for i, j in linked(sets, percent)]

    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (tasks.join(docs, "doc_id").repartition(shuffle_partitions(docs.sparkSession), "task")
            .sortWithinPartitions("task").mapInArrow(run, "a long, b long"))


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links).

    Documents link when ``100 * intersection >= percent * union`` of their sets of ``size``-word shingles.
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sets, weight = document_sets(source, size)
    classes = sets.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    # the key of a posting: the first eight bytes, as a little-endian long
    reverse = F.concat(*[F.substring("set", k, 1) for k in range(8, 0, -1)])
    half = F.conv(F.hex(reverse), 16, -10).cast("long")
    open_sets = opened(source, weight, size, percent).join(
        classes.filter("first IS NOT NULL").select(half.alias("key"), F.col("first").alias("doc_id"), "n"), "key")
    open_sets = written(open_sets.select("group", "doc_id", "n"), "open-groups")
    links = compare(open_sets, source, size, percent)
    labels = components(links)
    named = sets.join(classes.select("set", "first"), "set", "left")
    return (named.join(labels.withColumnRenamed("node", "first"), "first", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "first", "doc_id")).alias("component_id")))
