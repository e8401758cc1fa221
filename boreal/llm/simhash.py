"""SimHash fingerprints of documents and the search of all fingerprints within a Hamming radius.

Method: the terms of a text are its overlapping pairs of words, A-Z lower-cased (a single word alone),
weighted by ``1 + ln(occurrences)``. Each term's 256-bit hash votes on signed bits; a fingerprint's bit
is set where the weighted votes are above zero. Two fingerprints' likeness is the share of equal bits.

Search: fingerprints are cut into blocks of hexadecimal digits, a table each. Two fingerprints within ``radius`` bits differ in at
most ``radius // blocks`` bits of some block, so a query looks its blocks up with up to that many bits flipped, and everything
within the radius is among what it meets in some table; whole fingerprints are compared then. There are enough blocks for two
flips at most: 11 for 32 bits, a radius within which nearly all texts lie that differ in 2 % of their words (``tests/llm``). The
tables hold numbers only; fingerprints are joined to the pairs that met.

Scale: fingerprinting is a map over rows. For the edited texts of a document and its successor, rows are
range-partitioned by id on quantiles of the ids (a bounded list); each range also receives the first row
of the next range. Block tables hold distinct fingerprints with their number of documents, so a group of
copies is one row. Fingerprints of unlike texts meet about once in a thousand.

Edge cases: null and empty texts have no terms and the fingerprint of zeros; ties of votes leave a bit
unset; repeated rows follow one another in the order of their text; a null id comes before all others; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.llm.storage import shuffle_partitions
from boreal.llm.words import GOLDEN, mix, pair, word_hashes
from boreal.llm.worker import claim

BITS = 256
SIGNS = (2.0 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) - 1)  # of each byte value
STEPS = np.arange(BITS // 64, dtype=np.uint64) * GOLDEN  # one 64-bit hash of a term each
POSITIONS = np.arange(BITS // 8) * 256
FIRST_ID = -(1 << 63)


def fingerprint(text: str) -> np.ndarray:
    """The fingerprint as bytes."""
    words = word_hashes(text)
    terms = words if len(words) < 2 else pair(words[:-1], words[1:])
    terms, count = np.unique(terms, return_counts=True)
    weight = 1.0 + np.log(count)
    votes = np.zeros(256 * BITS // 8)
    for a in range(0, len(terms), 1 << 15):
        part = terms[a:a + (1 << 15)]
        bits = mix(part[:, None] + STEPS).view(np.uint8)
        votes += np.bincount((bits + POSITIONS).ravel(), np.repeat(weight[a:a + (1 << 15)], BITS // 8), len(votes))
    return np.packbits(votes.reshape(-1, 256) @ SIGNS > 1e-9)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - int(np.bitwise_count(a ^ b).sum()) / BITS


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint (hexadecimal) of every row."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()).tobytes().hex() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    return source.mapInArrow(run, "doc_id long, fingerprint string")


def _ranges(ids: DataFrame, ranges: int) -> list[int]:
    """First ids of at most ``ranges`` ranges of about equally many rows; the first is the smallest id."""
    found = ids.agg(F.min("id").alias("least"), F.percentile_approx(
        "id", [k / ranges for k in range(1, ranges)], 10 * ranges).alias("cuts")).first()
    return [] if found.least is None else sorted({found.least, *(found.cuts or [])})


def with_successors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (range, tail, id, text) in ascending id within each range of a partition; the last row of a
    range (tail = 1) is a copy of the first row of the next range, or of the first row of all."""
    source = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(FIRST_ID)).alias("id"),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    partitions = shuffle_partitions(docs.sparkSession)
    cuts = _ranges(source.select("id"), 4 * partitions)
    known, last = np.array(cuts or [0], np.int64), max(len(cuts) - 1, 0)

    @F.pandas_udf("int")
    def place_of(ids: pd.Series) -> pd.Series:
        """Twice the range's number, one more for its first id."""
        at = np.maximum(np.searchsorted(known, ids.to_numpy(), "right") - 1, 0)
        return pd.Series(2 * at + (known[at] == ids.to_numpy()))

    def target(number: Column, tail: int) -> Column:
        return F.struct(number.cast("int").alias("range"), F.lit(tail).alias("tail"))

    own = F.shiftright("place", 1)
    before = F.when(own == 0, F.lit(last)).otherwise(own - 1)
    return (source.withColumn("place", place_of("id"))
            .withColumn("to", F.explode(F.when(F.col("place") % 2 == 1, F.array(target(own, 0), target(before, 1)))
                                        .otherwise(F.array(target(own, 0)))))
            .select("to.range", "to.tail", "id", "text")
            .repartition(partitions, "range").sortWithinPartitions("range", "tail", "id", "text"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, and that to the next document.

    The edited text: the last ``floor(n_chars / 2)`` code points replaced by the first as many (or all)
    of the next document in ascending id; after the last comes the first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("simhash")
        held = None
        for batch in batches:
            out = []
            for where, tail, i, t in zip(*(batch.column(k).to_pylist() for k in ("range", "tail", "id", "text"))):
                own = fingerprint(t) if held or not tail else None
                if held and held[0] == where:
                    _, before, body, print_ = held
                    half = len(body) // 2
                    edited = body[:len(body) - half] + t[:half]
                    edited_print = fingerprint(edited)
                    out.append((None if before == FIRST_ID else before, len(body),
                                hashlib.sha256(edited.encode()).hexdigest(), print_.tobytes().hex(),
                                edited_print.tobytes().hex(), likeness(print_, edited_print), likeness(print_, own)))
                held = None if tail else (where, i, t, own)
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                           "near_edited", "near_next"])

    return with_successors(docs, doc_id, text).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


DIGITS, WORDS = BITS // 4, BITS // 64
MOST_FLIPS = 2
#: Bits of a key below the number of its table.
KEY_BITS = 56


def block_widths(radius: int) -> list[int]:
    """Hexadecimal digits of every block: as few blocks as find the radius with MOST_FLIPS bits flipped."""
    count = max(5, radius // (MOST_FLIPS + 1) + 1)  # a block is a number of at most 52 bits
    if DIGITS // count < 4:
        raise ValueError(f"a radius of {radius} needs blocks of under 16 bits")
    return [DIGITS // count + (k < DIGITS % count) for k in range(count)]


def block_keys(fingerprint: Column, widths: list[int]) -> list[Column]:
    """The number of the table and the block in one long, for every table."""
    starts = [1 + sum(widths[:k]) for k in range(len(widths))]
    return [F.conv(F.substring(fingerprint, a, w), 16, 10).cast("long") + (k << KEY_BITS) for k, (a, w) in enumerate(zip(starts, widths))]


def block_distance(differ: list[Column], widths: list[int], k: int) -> Column:
    """Differing bits inside block ``k``, given the exclusive or of two fingerprints as words of 64 bits."""
    low = 4 * sum(widths[k + 1:])  # bits behind the block, counted from the last
    mask = ((1 << 4 * widths[k]) - 1) << low
    parts = [mask >> 64 * (WORDS - 1 - i) & (1 << 64) - 1 for i in range(WORDS)]
    signed = [p - (1 << 64) if p >> 63 else p for p in parts]
    return sum((F.bit_count(x.bitwiseAND(F.lit(m).cast("long"))) for x, m in zip(differ, signed) if m), F.lit(0))


def flips(bits: int, most: int) -> list[int]:
    """All numbers of ``bits`` bits with at most ``most`` of them set."""
    return [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(range(bits), n)]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 32) -> DataFrame:
    """For every distinct ``fingerprint`` of ``queries``: the number of documents of ``prints`` (rows with
    a fingerprint) at most ``radius`` bits away, as (fingerprint, documents); itself included where it is among them."""
    widths = block_widths(radius)
    most = radius // len(widths)
    words = [F.conv(F.substring("fingerprint", 1 + 16 * i, 16), 16, -10).cast("long") for i in range(WORDS)]

    def named(prefix: str) -> list[Column]:
        return [w.alias(f"{prefix}{i}") for i, w in enumerate(words)]

    keys = block_keys(F.col("fingerprint"), widths)
    filed = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("documents"))
    tables = filed.select(F.explode(F.array(*keys)).alias("key"), "documents", *named("p"))

    def near(key: Column, width: int) -> Column:
        masks = F.array(*[F.lit(m).cast("long") for m in flips(4 * width, most)])
        return F.transform(masks, lambda m: key.bitwiseXOR(m))

    probes = queries.select("fingerprint").distinct().select(
        F.explode(F.concat(*[near(k, w) for k, w in zip(keys, widths)])).alias("key"), *named("q"))
    differ = [F.col(f"q{i}").bitwiseXOR(F.col(f"p{i}")) for i in range(WORDS)]
    distance = sum((F.bit_count(x) for x in differ), F.lit(0))
    # a pair counts in the first table in which it meets
    first = F.coalesce(*[F.when(block_distance(differ, widths, k) <= most, F.lit(k)) for k in range(len(widths))])
    # Catalyst's estimate does not see the explosion: neither side may be broadcast
    met = probes.hint("merge").join(tables.hint("merge"), (probes["key"] == tables["key"]) & (distance <= radius) & (
        first == F.shiftright(tables["key"], KEY_BITS)))
    text = F.lower(F.concat(*[F.lpad(F.hex(f"q{i}"), 16, "0") for i in range(WORDS)]))
    return met.groupBy(*[f"q{i}" for i in range(WORDS)]).agg(F.sum("documents").alias("documents")).select(
        text.alias("fingerprint"), "documents")
