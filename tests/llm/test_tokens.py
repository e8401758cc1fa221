"""SentencePiece coding and packing against the tokenizer libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import SF_SMALL, corpus, docs, empty  # noqa: F401
from pyspark.sql import functions as F

from boreal.llm import packing, queries
from boreal.llm.chunk_table import ChunkTable
from boreal.llm.sentencepieces import encode_decode

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_pieces_equal_the_library(docs, pieces):
    out = encode_decode(docs.select("doc_id", F.col("text"), F.lit("q").alias("ids"), F.col("text").alias("same")), PIECES)
    rows = out.collect()
    assert out.columns == ["doc_id", "same", "ids", "decoded"] and len(rows) == docs.count()
    for r in rows:
        ids = pieces.encode(r["same"] or "")
        assert list(r["ids"]) == ids and r["decoded"] == pieces.decode(ids)


def test_pieces_query(spark, corpus, pieces):
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    rows = queries.op2_sentencepieces(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = pieces.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()


def test_pieces_of_nothing(empty):
    assert encode_decode(empty, PIECES).count() == 0


def test_chunk_table_forgets_without_changing_results():
    table = ChunkTable(lambda chunks: [[len(c), ord(c[0])] for c in chunks], lambda ids: [str(i) for i in ids], limit=4)
    for text in ("a bb a ccc", "dd e ff g hh ii", "a ii jj k", "bb bb"):
        chunks = text.split()
        flat, length, rows = table.joined([chunks])
        assert flat.tolist() == [v for c in chunks for v in (len(c), ord(c[0]))] and length.tolist() == [2 * len(chunks)]
        assert [table.texts[i] for i in rows] == [str([len(c), ord(c[0])]) for c in chunks]


def check_packing(pieces, texts, tokenizer, capacity=4096):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        ids = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = total = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(total, 1)


def test_packing_query(spark, corpus, words):
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    assert check_packing(queries.op10_packing(spark, SF_SMALL).collect(), texts, words) == 0


def test_packing_edges(docs, empty, words):
    one = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] or "" for r in one.collect()}
    packed = packing.pack(one, WORDS, shard_tokens=5000).withColumn("ids_crc32", F.crc32("ids"))
    assert check_packing(packed.collect(), texts, words) == 0
    assert packing.pack(empty, WORDS).count() == 0
    repeated = packing.pack(docs, WORDS).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    counts = {r["doc_id"]: (r["n"], r["d"]) for r in repeated.collect()}
    assert counts[20][0] == 2 * counts[20][1] and counts[None][0] == counts[None][1] and counts[2] == (1, 1)


@pytest.mark.parametrize("text", ["it's. don't, x.y <|endoftext|> a<|endoftext|>b", "É ΣΑΣ. Σ İx", "a\x1cb\x85c　d",
                                  "a ́b", "!!. ?., a,, b.", "A.B. c.​d,  e."])
def test_chunks_give_the_same_ids(text, words):
    got = packing.WordCodec(WORDS).encode([text, text + " " + text])
    assert got[0].tolist() == words.encode(text, add_special_tokens=False).ids
    assert got[1].tolist() == words.encode(text + " " + text, add_special_tokens=False).ids


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 900, 2000).tolist() + [9000, 4096, 4097]
    sequences = packing.assign(lengths, 4096, 1.0, 1 / 4096)
    sizes = [sum(p[2] for p in s) for s in sequences]
    assert sum(sizes) == sum(lengths) and sizes.count(4096) >= len(sizes) - 12
    costs = [sum(n + n * n / 4096 for _, _, n in s) for s, size in zip(sequences, sizes) if size == 4096 and len(s) > 1]
    in_order = [sum(n + n * n / 4096 for n in lengths[k:k + 9]) for k in range(0, 1800, 9)]
    assert np.std(costs) < np.std(in_order) / 3


def test_worker_releases_what_another_operator_kept():
    from boreal.llm import worker

    released = []
    worker.claim("one")
    worker.keep(lambda: released.append("one"))
    worker.claim("one")
    assert released == []
    worker.claim("two")
    worker.claim("one")
    assert released == ["one"]


def test_ids_of_random_strings_equal_the_library(words):
    """Letters whose lower case ends in a mark, combining marks, stops and all kinds of spaces."""
    import random

    rnd = random.Random(3)
    some = list("İIıiSsßΣσςǰŉÅé漢가ﬁ٣७2 .,;:!?'\"-\u0307\u0301\u0345\u0308\u030a\u030c\u0331\u0344HJTWYhjtwy\u200d\u00a0\u2003\u0085\n\t")
    plain = ["GAZİ", "word", "Straße", "don't", "İ", "J\u030c", "e\u0301"]
    texts = ["GAZİ. b", "İ.", "aİ, b"]
    for _ in range(10_000):
        pick = lambda: rnd.choice(plain) if rnd.random() < 0.2 else rnd.choice(some) if rnd.random() < 0.9 else chr(
            rnd.choice([rnd.randrange(0x20, 0x250), rnd.randrange(0x250, 0xD800), rnd.randrange(0x1F300, 0x1F700)]))
        texts.append("".join(pick() for _ in range(rnd.randrange(12))) + rnd.choice(["", ".", "!", ", x"]))
    coded = packing.WordCodec(WORDS).encode(texts)
    for text, ids in zip(texts, coded):
        assert ids.tolist() == words.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_worker_keeps_few_chunks(words, monkeypatch):
    """The table stays within its limit however many distinct chunks pass, and ids stay the library's."""
    monkeypatch.setattr(packing, "KNOWN_CHUNKS", 100)
    c = packing.WordCodec(WORDS)
    for k in range(0, 900, 30):
        texts = [f"new{i} word, and{i * i}. word" for i in range(k, k + 30)]
        assert [g.tolist() for g in c.encode(texts)] == [words.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(c.table.row) <= 100 + 4 * 30
