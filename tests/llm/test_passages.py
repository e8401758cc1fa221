"""Repeated passages and the pipeline."""

import random

import numpy as np
from llm_fixtures import SF_SMALL, corpus, docs, empty  # noqa: F401

import corpus_pipeline
from boreal.llm import substring_dedup as sd
from boreal.llm.storage import written


def test_chains_score_like_all_chains():
    rng = random.Random(5)
    for _ in range(60):
        parts = sorted({(rng.randrange(60), rng.randrange(60), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 9))})
        cost = 0.1

        def value(chain):
            skipped = sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(chain, chain[1:]))
            return sum(s[2] for s in chain) - cost * skipped

        def best(chain):
            more = [best(chain + [p]) for p in parts if not chain or (
                p[0] >= chain[-1][0] + chain[-1][2] and p[1] >= chain[-1][1] + chain[-1][2])]
            return max([value(chain) if chain else 0, *more])

        found = sd.chains(parts, cost)
        assert abs(value(found[0]) - best([])) < 1e-9
        assert sorted(s for c in found for s in c) == parts


def test_seeds_are_guaranteed():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**63, 400).astype(np.uint64)
    whole = set(sd.seeds(words, 8, 16)[0].tolist())
    for a in range(0, 370, 7):
        part = sd.seeds(words[a:a + 23], 8, 16)[0]
        assert whole & set(part.tolist())


def test_positions_pass_through_one_value():
    x, starts = np.array([4, 9, 70_000, 1, 2, 3, 0]), np.array([0, 3, 6])
    column = sd.packed(x, starts)
    for cut in (column, column.slice(1), column.slice(0, 2), column.slice(3)):
        values, count = sd.unpacked(cut)
        assert values.tolist() == [v for b in cut for v in np.frombuffer(b.as_py(), "<i4").tolist()]
        assert count.tolist() == [len(b.as_py()) // 4 for b in cut]
    assert len(sd.rows_of([(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))])) == 0


def test_runs_become_points():
    rng = np.random.default_rng(4)
    for _ in range(50):
        starts = [(int(a), int(b), int(n)) for a, b, n in zip(rng.integers(0, 500, 4), rng.integers(0, 500, 4), rng.integers(1, 200, 4))]
        pairs = sorted({(a + i, b + i) for a, b, n in starts for i in range(n) if rng.random() < 0.9})
        x, y = (np.array(c) for c in zip(*pairs))
        covered = {(int(a) + i, int(b) + i) for a, b in pairs for i in range(50)}
        px, py = sd.run_points(x, y, 6, 12, 50)
        assert {(int(a) + i, int(b) + i) for a, b in zip(px, py) for i in range(6)} <= covered
        whole = {(s[0] + i, s[1] + i) for s in sd.segments(*sd.distinct_points(px, py), 6, 12) for i in range(s[2])}
        assert whole == covered


def planted():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    own = lambda n: [word() for _ in range(n)]
    passage = own(70)
    fuzzy = [w if k % 20 != 10 else word() for k, w in enumerate(passage)]
    shorter = passage[:30]
    texts = {
        10: own(100) + passage + own(50), 20: own(30) + passage + own(80), 30: passage, 40: own(200), 50: own(20) + fuzzy + own(20),
        60: own(50) + shorter + own(50), 70: own(40) + passage[:35] + own(3) + passage[35:] + own(10), 80: own(60), 90: own(5)}
    texts |= {100 + k: own(8) + passage + own(9) for k in range(40)}
    return {i: " ".join(w) for i, w in texts.items()}, passage


def test_planted_passages(spark):
    texts, passage = planted()
    docs = spark.createDataFrame(list(texts.items()) + [(5, None), (6, ""), (None, " ".join(passage))],
                                 "doc_id long, text string").repartition(4)
    found = sd.passages(docs)
    rows = found.collect()
    hit = {r["doc_id"]: r for r in rows}
    assert set(hit) == {20, 30, 50, 70, *range(100, 140)}
    for r in rows:
        assert r["source_id"] < r["doc_id"] and r["identity"] >= 0.8 and r["end"] - r["begin"] >= 50
    assert (hit[20]["begin"], hit[20]["end"], hit[30]["begin"], hit[30]["end"]) == (30, 100, 0, 70)
    assert hit[50]["begin"] == 20 and hit[50]["end"] == 90
    assert (hit[70]["begin"], hit[70]["end"]) == (40, 113)
    cut = {r["doc_id"]: r["text"] for r in sd.without_passages(docs, found).collect()}
    assert len(cut) == len(texts) + 3 and cut[5] is None and cut[6] == "" and cut[30] == ""
    for i in (10, 40, 60, 80, 90):
        assert cut[i] == texts[i]
    words = texts[20].split()
    assert cut[20] == " ".join(words[:30] + words[100:])
    assert len(cut[120].split()) == 17


def test_recall_by_identity_and_length(spark):
    """Passages with words replaced at random places, found over at least 80 % of their length."""
    rnd = random.Random(1)
    vocabulary = [f"w{k}" for k in range(3000)]
    own = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    least = {(0.8, 100): 0.6, (0.8, 200): 0.7, (0.85, 60): 0.4, (0.85, 100): 0.9, (0.85, 200): 0.9, (0.9, 60): 0.95, (0.95, 60): 0.95}
    rows, asked = [], {}
    for identity, length in least:
        for _ in range(40):
            passage = own(length)
            edited = list(passage)
            for k in rnd.sample(range(length), round((1 - identity) * length)):
                edited[k] = rnd.choice(vocabulary)
            before, at = own(rnd.randrange(20, 200)), rnd.randrange(9, 20)
            rows.append((len(rows), own(30) + passage + own(40)))
            asked[len(rows)] = (identity, length, at, at + length)
            rows.append((len(rows), before[:at] + edited + before[at:]))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(6)
    covered = {}
    for r in sd.passages(docs).collect():
        _, _, a, b = asked[r["doc_id"]]
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + max(0, min(b, r["end"]) - max(a, r["begin"]))
    found = {}
    for i, (identity, length, _, _) in asked.items():
        found.setdefault((identity, length), []).append(covered.get(i, 0) >= 0.8 * length)
    recall = {c: sum(v) / len(v) for c, v in found.items()}
    assert all(recall[c] >= least[c] for c in least), recall


def test_a_source_of_very_many_passages(spark, monkeypatch):
    """The chains of a text that all others repeat are asked for in several rows; its line stands many times in a document."""
    monkeypatch.setattr(sd, "WISHES", 10)
    rnd = random.Random(9)
    own = lambda n: [f"v{rnd.randrange(10**6)}" for _ in range(n)]
    licence = own(70)
    rows = [(0, licence)] + [(i, own(5) + licence + own(3) + (licence if i % 7 == 0 else [])) for i in range(1, 120)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(5)
    cut = {r["doc_id"]: r["text"].split() for r in sd.without_passages(docs, sd.passages(docs)).collect()}
    # a copy of the whole double passage may take the words between along
    assert cut[0] == licence and all(len(cut[i]) == 8 or i % 7 == 0 and len(cut[i]) == 5 for i in range(1, 120))


def test_passages_whose_parts_stand_earlier_elsewhere(spark):
    rng = random.Random(23)
    own = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    rows, want = [], {}
    for i in range(0, 400, 10):
        n = rng.choice([50, 60, 75])
        passage, cut = own(n), rng.randrange(20, 31)
        for j, part in enumerate((passage[:cut], passage[cut:cut + 30], passage[cut + 20:], passage[5:45], passage)):
            rows.append((i + j, own(rng.randrange(9, 40)) + part + own(rng.randrange(9, 40))))
        before = rng.randrange(9, 40)
        rows.append((i + 5, own(before) + passage + own(20)))
        want[i + 5] = (before, before + n, i + 4)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    for parts in (1, 7):
        got = {r["doc_id"]: (r["begin"], r["end"], r["source_id"]) for r in sd.passages(docs.repartition(parts)).collect()}
        assert {i: got.get(i) for i in want} == want


def test_every_passage_of_a_chain_that_is_not_alike(spark):
    rng = random.Random(31)
    own = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
    one, two = own(60), own(60)
    rows = [(1, one + own(100) + two + own(9)), (2, one + own(100) + two[:30] + own(1) + two[30:] + own(9))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert sorted((r["begin"], r["end"]) for r in sd.passages(docs).collect()) == [(0, 60), (160, 221)]


def test_run_hashes_tell_runs_apart():
    words = np.tile(np.random.default_rng(3).integers(0, 2**63, 90).astype(np.uint64), 2)
    for size in (1, 2, 31, 50):
        hashes = sd.run_hashes(words, size)
        assert len(hashes) == 181 - size and len(set(hashes.tolist())) == 90
        assert (hashes[90:] == hashes[:91 - size]).all()


def test_copies_and_edges(docs, empty):
    found = {r["doc_id"]: r for r in sd.passages(docs).collect()}
    assert {5, 9, 8} <= set(found) and 1 not in found and 7 not in found and None not in found
    assert found[5]["begin"] == 0 and found[5]["end"] == 120 and found[8]["end"] >= 60_000
    assert sd.passages(empty).count() == 0
    kept = sd.without_passages(docs, sd.passages(docs))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_every_repeat_of_the_corpus_is_found(corpus):
    """Brute force: whatever 60 words in a row stand in an earlier document lie mostly in found passages."""
    texts = {r["doc_id"]: (r["text"] or "").split() for r in corpus.collect()}
    found = {}
    for r in sd.passages(corpus).collect():
        found.setdefault(r["doc_id"], []).append((r["begin"], r["end"]))
    seen = set()
    for i in sorted(texts):
        w = [x.lower() for x in texts[i]]
        grams = [tuple(w[k:k + 60]) for k in range(max(0, len(w) - 59))]
        for k, g in enumerate(grams):
            if g in seen:
                inside = sum(max(0, min(b, k + 60) - max(a, k)) for a, b in found.get(i, []))
                assert inside >= 50, (i, k)
        seen |= set(grams)


def test_pipeline_stages(spark, corpus):
    docs = corpus
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF_SMALL), "test")
        kept[name] = out.collect()
        if name != "packing":
            assert out.columns == corpus.columns
        docs = out
    ids = {k: {r["doc_id"] for r in v} for k, v in kept.items()}
    assert len(ids["language_id"]) >= 198  # clean documents stay
    texts = {r["doc_id"]: r["text"].lower() for r in kept["language_id"]}
    assert len(ids["exact_dedup"]) == len(set(texts.values())) == len({texts[i] for i in ids["exact_dedup"]})
    assert ids["packing"] == ids["substring_dedup"] <= ids["jaccard_join"] <= ids["exact_dedup"]
    assert all(r["n_chars"] == len(r["text"]) for r in kept["substring_dedup"])
    whole = corpus_pipeline.run(spark, SF_SMALL)
    tokens = sum(r["length"] for r in kept["packing"])
    assert sum(r["length"] for r in whole.collect()) == tokens


def test_pipeline_on_edges(spark, docs, empty):
    for rows, least in ((docs, 5), (empty, 0)):
        extra = {r["doc_id"]: (r["score"], r["n_tokens"], r["row"], r["fingerprint"]) for r in rows.collect()}
        for name, stage in corpus_pipeline.STAGES:
            rows = written(stage(spark, rows, SF_SMALL), "test")
            if name != "packing":
                assert rows.columns == docs.columns
                for r in rows.collect():
                    assert extra[r["doc_id"]] == (r["score"], r["n_tokens"], r["row"], r["fingerprint"])
        assert rows.count() >= least


def test_stages_on_nulls_in_every_column(spark, docs):
    holes = docs.select(*[docs[c].alias(c) for c in docs.columns]).union(
        spark.createDataFrame([(None,) * len(docs.columns)] * 2, docs.schema)).union(
        spark.createDataFrame([(77, "some words of a text", None, None, None, None, None, None, None)], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        rows = written(stage(spark, holes, SF_SMALL), "test")
        assert {r["doc_id"] for r in rows.collect()} >= {77}


def test_gaps_cost_what_differs():
    """The longest common subsequence of gaps that are equal at their ends is that of their middles."""
    import time

    import numpy as np

    from boreal.llm.substring_dedup import common, reach

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for w in a:
            before = row[:]
            for j, v in enumerate(b):
                row[j + 1] = before[j] + 1 if w == v else max(row[j], before[j + 1])
        return row[-1]

    rng = np.random.default_rng(1)
    for _ in range(1500):
        a, b = (rng.integers(0, rng.integers(2, 6), rng.integers(0, 11)).astype(np.uint64) for _ in range(2))
        assert common(a, b) == plain(a.tolist(), b.tolist())
        equal = rng.random(rng.integers(0, 12)) < rng.random()
        scores = np.cumsum(np.where(equal, 1, -2)).tolist()
        assert reach(equal) == (scores.index(max(scores)) + 1 if scores and max(scores) > 0 else 0)
    long = np.arange(30_000).astype(np.uint64)
    other = long.copy()
    other[15_000] = 1 << 40
    begun = time.process_time()
    assert common(long, other) == 29_999
    assert time.process_time() - begun < 0.3
