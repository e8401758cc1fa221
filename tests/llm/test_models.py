"""Fingerprints, language identification, HTML extraction and language-model scoring."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SF_SMALL, corpus, docs, empty  # noqa: F401
from pyspark.sql import functions as F

from boreal.llm import kneser_ney, language_id, queries, simhash
from boreal.llm.html_text import extract, main_text
from boreal.llm.words import block_words, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    from boreal.llm import words

    texts = ["", "  ", "One two  THREE\tone\x0bé", "x" * 50 + " y", "one"]
    whole = [word_hashes(t) for t in texts]
    assert [len(w) for w in whole] == [0, 0, 5, 2, 1] and whole[2][0] == whole[2][3] == whole[4][0]
    flat, sizes = block_words(texts)
    assert sizes.tolist() == [0, 0, 5, 2, 1] and flat.tolist() == np.concatenate(whole).tolist()
    monkeypatch.setattr(words, "PART", 7)
    assert [word_hashes(t).tolist() for t in texts] == [w.tolist() for w in whole]


def test_edited_texts_and_likeness(spark, corpus):
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    rows = {r["doc_id"]: r for r in queries.op1_simhash(spark, SF_SMALL).collect()}
    ids = sorted(texts)
    assert sorted(rows) == ids
    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, r = texts[i], rows[i]
        edited = t[:len(t) - len(t) // 2] + texts[after][:len(t) // 2]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        bits = lambda x: int(x, 16)
        for name, other in (("near_edited", r["edited_fingerprint"]), ("near_next", rows[after]["fingerprint"])):
            assert r[name] == 1 - (bits(r["fingerprint"]) ^ bits(other)).bit_count() / 256
        assert r["fingerprint"] == simhash.fingerprint(t).tobytes().hex()
        if i % 100 == 0:
            assert r["within_32_bits"] == sum(
                (bits(r["fingerprint"]) ^ bits(x["fingerprint"])).bit_count() <= 32 for x in rows.values())
        else:
            assert r["within_32_bits"] is None
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows.values()]) > 0.95


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (4, 32), np.uint8)
    rows = []
    for b in base:
        for flips in (0, 0, 1, 5, 7, 8, 12, 20, 21, 31, 32, 33, 47, 48):
            bits = np.unpackbits(b)
            bits[rng.choice(256, flips, replace=False)] ^= 1
            rows.append((np.packbits(bits).tobytes().hex(),))
    prints = spark.createDataFrame(rows, "fingerprint string")
    for radius in (0, 3, 7, 20, 32, 47):
        got = {r["fingerprint"]: r["documents"] for r in simhash.within_radius(prints, prints, radius).collect()}
        assert got == {a: sum((int(a, 16) ^ int(b, 16)).bit_count() <= radius for b, in rows) for a, in rows}


def test_near_copies_lie_within_the_radius(corpus):
    """Texts of 100 words or more with 2 % of their words replaced."""
    import random

    rnd, near = random.Random(3), []
    for text in (r["text"] for r in corpus.collect()):
        words = (text or "").split(" ")
        if len(words) >= 100:
            edited = list(words)
            for k in rnd.sample(range(len(words)), round(0.02 * len(words))):
                edited[k] = f"zq{rnd.randrange(10**6)}"
            near.append(np.bitwise_count(simhash.fingerprint(text) ^ simhash.fingerprint(" ".join(edited))).sum() <= 32)
    assert len(near) > 50 and np.mean(near) >= 0.9


def test_fingerprint_edges(docs, empty):
    rows = [(r["doc_id"], r["fingerprint"]) for r in simhash.fingerprints(docs).collect()]
    prints = dict(rows)
    assert prints[5] == prints[1] == prints[20] and prints[2] == prints[3] == "0" * 64
    assert simhash.fingerprints(empty).count() == 0 and simhash.edited_fingerprints(empty).count() == 0
    assert simhash.edited_fingerprints(docs).count() == docs.count()
    alone = simhash.edited_fingerprints(docs.filter("doc_id = 9")).collect()[0]
    assert alone["near_next"] == 1.0


def test_held_out_language_accuracy(spark, corpus):
    rows = queries.op6_language_id(spark, SF_SMALL).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 200 and 40 < len(held) < 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_sample_is_bounded_and_edges(spark, docs, empty):
    many = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 2 == 0, "die der und ist das ").otherwise(
        "the and of this that "), "id").alias("text"), F.when(F.col("id") % 2 == 0, "de").otherwise("en").alias("lang"))
    usable = many.withColumnRenamed("doc_id", "id")
    drawn = language_id.sample(usable, 20, 10)
    assert Counter(r[0] for r in drawn).keys() == {"de", "en"} and max(Counter(r[0] for r in drawn).values()) <= 20
    model = language_id.train(many, per_language=50)
    assert model.languages == ["de", "en"] and model.predict("das ist die")[0] == "de"
    out = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert out[2]["lang_pred"] == out[3]["lang_pred"] == out[16]["lang_pred"] == "und" and not out[16]["accepted"]
    assert out[11]["lang_pred"] in model.languages and out[5]["score"] == out[20]["score"]
    assert language_id.predict(docs, model).columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score", "accepted"]
    # rows of one id, copies of one text, and more labels than are learned
    one = many.withColumn("doc_id", F.lit(7).cast("long"))
    drawn = Counter(r[0] for r in language_id.sample(one.withColumnRenamed("doc_id", "id"), 20, 10))
    assert drawn.keys() == {"de", "en"} and min(drawn.values()) >= 10 and max(drawn.values()) <= 20
    copies = many.withColumn("text", F.when(F.col("lang") == "de", "die der und").otherwise(F.col("text")))
    assert Counter(r[0] for r in language_id.sample(copies.withColumnRenamed("doc_id", "id"), 20, 10))["de"] <= 1
    dirty = many.withColumn("lang", F.when(F.col("doc_id") < 300, F.col("lang")).otherwise(F.concat(F.lit("x"), "doc_id")))
    assert language_id.train(dirty, per_language=50, most_languages=2).languages == ["de", "en"]
    nothing = language_id.train(empty)
    assert language_id.predict(docs, nothing).filter("lang_pred != 'und'").count() == 0
    assert language_id.predict(empty, model).count() == 0


def test_rejection_of_doubtful_texts():
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        at = np.sort(rng.choice(200, 60, replace=False)) + 200 * (k % 2)
        rows.append(("ab"[k % 2], at.astype(np.int32), np.full(60, 1 / 60, np.float32)))
    model = language_id.fit(rows, 200, 4.0, 0.02, 7)
    assert 0 < model.threshold <= 0.6 + 1e-9 and 0.25 <= model.temperature <= 20


def test_unknown_languages_and_random_texts_go(spark, corpus):
    model = language_id.train(corpus)
    rng = np.random.default_rng(4)
    strange = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.", "人人生而自由,在尊严和权利上一律平等。"]
    strange += ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), 600)) for _ in range(50)]
    strange += [base64.b64encode(rng.bytes(450)).decode() for _ in range(50)]
    assert not any(model.predict(t)[2] for t in strange)
    by = defaultdict(list)
    for r in corpus.filter("text IS NOT NULL AND lang IS NOT NULL").orderBy("doc_id").collect():
        by[r["lang"]].append(r["text"])
    clean = [t for texts in by.values() for t in texts]
    assert np.mean([model.predict(t)[2] for t in clean]) >= 0.99
    mixed = [a[:n] + " " + b[:n] for k in by for j in by if k < j for a, b in zip(by[k], by[j]) for n in [min(len(a), len(b)) // 2]]
    assert np.mean([model.predict(t)[2] for t in mixed]) >= 0.99


def test_languages_left_out_of_training_go(spark):
    corpus = spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet")
    by = defaultdict(list)
    for r in corpus.filter("text IS NOT NULL AND lang IS NOT NULL").orderBy("doc_id").collect():
        by[r["lang"]].append(r["text"])
    for left in ("de", "fr"):
        model = language_id.train(corpus.filter(F.col("lang") != left))
        assert np.mean([model.predict(t)[2] for t in by[left]]) < 0.5  # related languages are the hardest


PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><a href="/">Site name</a></header><nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, more than you would ever like to know about.</div>
{article}
<aside><p>Side bar with rather many words that read like a text of its own, really.</p></aside>
<section id="comments"><p>First! A reader comment of quite some length stands here, as they do.</p></section>
<form><label>Name</label><input name="q"><button>Send</button></form>
<footer>&copy; nobody</footer></body></html>"""
TEXT = ["A headline", "The first paragraph is long enough to be content &amp; has   a\nbreak.", "Short.",
        "Another <b>long</b> paragraph with in<i>line</i> markup &mdash; and an &eacute; in it, for good measure."]
WANT = ("A headline The first paragraph is long enough to be content & has a break. Short. "
        "Another long paragraph with inline markup — and an é in it, for good measure.")


@pytest.mark.parametrize("article", [
    "<article><h1>{}</h1><p>{}</p><p>{}<p>{}</article>",
    "<main><h2>{}</h2><div class=ad>Buy things that you do not need</div><p>{}<br><p>{}</p><!-- x --><p><b>{}</main>",
    "<div><h1>{}</h1><p>{}</p><p>{}</p><p>{}</p></div>",
])
def test_main_text(article):
    assert main_text(PAGE.format(article=article.format(*TEXT))) == WANT


def test_short_blocks_of_a_marked_article_stay():
    long = [f"Paragraph {k} " + "goes on with words " * 25 for k in range(5)]
    cells = [f"c{k}" for k in range(15)]
    table = "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in cells[r:r + 3]) + "</tr>" for r in range(0, 15, 3)) + "</table>"
    short = ["Told shortly.", "So they say.", "The end."]
    page = ("<p>Outside the article.</p><article>" + "".join(f"<p>{t}</p>" for t in long) + table + f"<div>{short[0]}</div>"
            f"<section><blockquote>{short[1]}</blockquote></section><nav>Menu</nav><p><a href=x>{short[2]}</a></p></article>")
    assert main_text(page) == " ".join(" ".join([*long, *cells, *short]).split())


STORY = "<h1>A headline of some length</h1>" + "".join(f"<p>Paragraph {k} {'goes on with words ' * 20}</p>" for k in range(6))
STORY_TEXT = " ".join(re.sub("<[^>]*>", " ", STORY).split())


@pytest.mark.parametrize("inside, text", [
    ('<p>The close: <span class="share-price">12 kr</span></p>', "The close: 12 kr"),
    ('<table class="search-results"><tr><td>one</td><td>two</td></tr></table>', "one two"),
    ('<blockquote class="related">Quoted</blockquote>', "Quoted"),
    ('<div class="ad">Buy this now</div>', ""), ('<div class="newsletter-signup">Your address here</div>', ""),
    ('<aside>Beside it</aside>', ""), ('<div hidden>Not seen</div>', "")])
def test_names_inside_an_article(inside, text):
    page = f"<body><nav>Menu</nav><article>{STORY}{inside}{STORY}</article><footer>Foot</footer></body>"
    assert main_text(page) == " ".join(f"{STORY_TEXT} {text} {STORY_TEXT}".split())


def test_a_story_beside_a_teaser():
    teaser = "<article><h3><a href=x>Another story</a></h3><p>Read more</p></article>"
    text = main_text(f"<body><nav>Menu</nav>{teaser}<div class=story>{STORY}</div><div class=comments><p>I say so</p></div></body>")
    assert STORY_TEXT in text and "I say so" not in text
    two = main_text(f"<article>{STORY}</article><div><a href=y>Link</a></div><article>{STORY}</article>")
    assert two == f"{STORY_TEXT} {STORY_TEXT}"


def test_the_ratio_decides_on_pages_that_mark_no_article(spark):
    """The pages of the table, their article's tags replaced by a plain block."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    alike = sum(main_text(re.sub(r"(</?)article\b", r"\1div", h)) == main_text(h) for h in pages)
    assert alike >= 0.95 * len(pages)


@pytest.mark.parametrize("unit", ["<b>x</i>", "<i><div><b>x</i>", "<p>", "<li>x", "<div class=ad>", "<td>x", "</p>", "<a href=x>y"])
def test_long_broken_pages_take_linear_time(unit):
    import time

    begin = time.time()
    main_text("<div><i>" + unit * (1_000_000 // len(unit)))
    assert time.time() - begin < 20


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = queries.op7_html_text(spark, SF_SMALL).collect()
    assert len(rows) == len(html)
    for r in rows:  # these pages mark their article: tags off, references decoded
        import html as references

        body = re.search(r"<article>(.*?)(</article>|$)", html[r["page_id"]], re.S)[1]
        blocks = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", re.sub(r"<!--.*?-->", "", body))
        want = " ".join(references.unescape(re.sub(r"</?[a-z][^>]*>", "", blocks)).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_page_edges(spark, empty):
    rows = [(1, None), (2, ""), (3, "no markup &lt;b&gt;"), (4, "<p>open <b>tags"), (5, "<nav>only a menu</nav>"), (6, "<article"),
            (7, "<p>" + "word " * 100_000), (7, "<p>" + "word " * 100_000), (8, "</div></p>stray<script>x")]
    pages = spark.createDataFrame([(*r, "u", "old") for r in rows], "page_id long, html string, url string, text string")
    out = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert extract(pages).columns == ["page_id", "url", "text"] and extract(pages).count() == 9
    assert out[1] == out[2] == out[5] == out[6] == "" and out[3] == "no markup <b>" and out[4] == "open tags"
    assert len(out[7]) == 499_999 and out[8] == "stray"
    assert extract(pages.filter("false")).count() == 0


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["</s>"]


def brute_model(texts, order):
    """(probability of a word after a context, token counts): tables of every level by plain counting."""
    top = Counter()
    for text in texts:
        w = ["<s>"] * (order - 1) + tokens(text)
        top.update(tuple(w[k:k + order]) for k in range(len(w) - order + 1))
    levels, count = [top], Counter()
    for gram, c in top.items():
        count[gram[-1]] += c
    while len(next(iter(levels[0]))) > 1:
        levels.insert(0, Counter(gram[1:] for gram in levels[0]))  # distinct longer n-grams
    d = [kneser_ney.discounts([sum(c == k for c in level.values()) for k in (1, 2, 3, 4)]) for level in levels]
    followers = [defaultdict(list) for _ in levels]
    for level, found in zip(levels, followers):
        for gram, c in level.items():
            found[gram[:-1]].append(c)

    sums = [{u: (sum(c), sum(e[min(x, 3)] for x in c)) for u, c in found.items()} for e, found in zip(d, followers)]

    def p(context, w, level=order):
        if level == 0:
            return 1 / (len(count) + 1)
        context = tuple(context[len(context) - level + 1:])
        lower = p(context, w, level - 1)
        if context not in sums[level - 1]:
            return lower
        total, rest = sums[level - 1][context]
        c = levels[level - 1][(*context, w)]
        return max(c - d[level - 1][min(c, 3)], 0) / total + rest / total * lower

    return p, count


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_against_brute_force(spark, corpus, order):
    texts = {r["doc_id"]: r["text"] for r in corpus.collect() if order == 2 or len(r["text"] or "") < 3000}
    if order == 2:
        rows = queries.op8_kneser_ney(spark, SF_SMALL).collect()
        held = {r["doc_id"]: r["held_out"] for r in rows}
    else:
        held = {i: i % 7 == 2 for i in texts}
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
        rows = kneser_ney.score(docs, kneser_ney.train(docs.filter("doc_id % 7 != 2"), order)).collect()
    p, count = brute_model([t for i, t in texts.items() if not held[i]], order)
    n, v = sum(count.values()), len(count)
    for u in ["<s>", "the", "never seen"]:  # a distribution over the vocabulary and the unknown word
        assert abs(sum(p(["<s>"] * (order - 2) + [u], w) for w in [*count, "never seen either"]) - 1) < 1e-9
    for r in rows:
        w = tokens(texts[r["doc_id"]])
        assert r["n_tokens"] == len(w) and r["n_known"] == sum(count[x] > 0 for x in w)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        marked = ["<s>"] * (order - 1) + w
        want = sum(math.log10(p(marked[k:k + order - 1], x)) for k, x in enumerate(w))
        assert math.isclose(r["score"], want, rel_tol=1e-9)
    if order == 2:
        assert all(r["train_tokens"] == n for r in rows)
        assert sum(r["score"] for r in rows if r["held_out"]) > 0.98 * sum(r["base_score"] for r in rows if r["held_out"])


def test_scores_edges(spark, docs, empty):
    model = kneser_ney.train(docs)
    out = kneser_ney.score(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("text", "n_tokens", "score")] + ["n_tokens", "n_known", "base_score", "score"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[2]["n_tokens"] == rows[3]["n_tokens"] == rows[4]["n_tokens"] == 1 and rows[8]["n_tokens"] == 60_002
    assert rows[12]["score"] == rows[13]["score"]
    assert kneser_ney.score(empty, model).count() == 0
    nothing = kneser_ney.train(empty)
    assert kneser_ney.score(docs, nothing).filter("abs(score) > 1e-9").count() == 0


def test_scores_do_not_depend_on_the_buckets(spark, docs, tmp_path, monkeypatch):
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    few = {r["doc_id"]: r["score"] for r in kneser_ney.score(docs, kneser_ney.train(docs)).collect()}
    monkeypatch.setattr(kneser_ney, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(kneser_ney, "HELD_TOKENS", 1000)
    model = kneser_ney.train(docs)
    assert model.buckets > 8
    many = {r["doc_id"]: r["score"] for r in kneser_ney.score(docs, model).collect()}
    assert many == pytest.approx(few)
