"""Language identification: averaged hashed subword embeddings with a linear softmax.

Method: a text's features are its overlapping 3- and 4-byte windows (lower case, UTF-8), hashed into
``BUCKETS`` buckets. The embedding of a text is the average of its buckets' vectors; a linear softmax
over it gives one probability per language. Vectors and weights are trained together by stochastic
gradient descent in numpy. On a part of the sample kept out of training the softmax is calibrated by one
temperature (least log loss). Two rules reject, both calibrated on that part. Confidence: below the ``reject_rate`` quantile of the
calibrated confidence there, but never above 1.2 times the confidence of a blind guess; the quantile alone would throw out clean
texts in two learned languages, which are rightly in doubt. So confidence removes only texts that say nothing, and the calibrated
rejection of texts in no learned language, of which a softmax is often sure, is by familiarity: the
average over a text's windows of the log of their bucket's share in the language that has most of it, against an
equal share. The least familiarity lies halfway between the ``reject_rate`` quantile of the kept-out part and the
median there with each text's own language left out.

Scale: the classifier is fitted on at most ``per_language`` labelled texts of each of the ``most_languages`` commonest languages
(documented bounds: values of a dirty label column beyond are not learned), drawn by
a hash of the text, copies counted once (their features have bounded size, whatever the texts' length).
Prediction maps over all rows and whole texts; the folded model (buckets x languages) travels with the
task. Nothing is shuffled but hashes of the labelled texts, for their number, and the sample.

Edge cases: a null text or one without a letter is ``und`` with score 0 and rejected; null languages
are not learned; with nothing to learn every text is ``und``; with under ``LEAST_TUNING`` kept-out texts no text is
too unfamiliar; ties between languages go to the one first
in alphabetical order; a null id is never learned from; repeated rows are predicted alike; an empty
table gives an empty result; other columns pass through unless named like the results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.llm.worker import claim

BUCKETS = 1 << 15
DIMENSIONS = 16
PART = 1 << 22
LEAST_TUNING = 20
LETTER = re.compile(r"[^\W\d_]")


def buckets(text: str) -> Iterator[np.ndarray]:
    """The bucket of every window, in parts of a long text."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    for a in range(0, len(data), PART):
        d = data[a:a + PART + 3].astype(np.uint32)
        three = d[:-2] | d[1:-1] << 8 | d[2:] << 16
        four = three[:-1] | d[3:] << 24
        for n, grams in ((1, three[:PART]), (2, four[:PART])):
            yield ((grams * np.uint32(0x9E3779B1) + np.uint32(n << 20 | 0x5EB)) >> np.uint32(17)).astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    folded: np.ndarray  # buckets x languages and one: embedding times weights, and familiarity
    bias: np.ndarray
    temperature: float
    threshold: float
    least_familiar: float

    def measured(self, text: str) -> tuple[np.ndarray, float]:
        """Logits and familiarity."""
        total, count = np.zeros(len(self.languages) + 1), 0
        for b in buckets(text):
            total += self.folded[b].sum(axis=0, dtype=np.float64)
            count += len(b)
        return total[:-1] / count + self.bias, float(total[-1] / count)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not LETTER.search(text):
            return "und", 0.0, False
        logits, familiar = self.measured(text)
        p = softmax(logits[None] / self.temperature)[0]
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] >= self.threshold and familiar >= self.least_familiar)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(labelled: DataFrame, per_language: int, most_languages: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, shares) of at most ``per_language`` distinct texts of each of the ``most_languages`` languages that
    have most of them."""
    labelled = labelled.withColumn("hash", F.xxhash64("text"))
    counts = {r["lang"]: r["texts"] for r in labelled.select("lang", "hash").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts")).orderBy(F.desc("texts"), "lang").limit(most_languages).collect()}
    # texts are drawn by their hash; a tenth more than needed, so that the bound is nearly met
    share = F.create_map(*[F.lit(x) for kv in counts.items() for x in (kv[0], min(1.0, 1.1 * per_language / kv[1]))]) \
        if counts else F.create_map(F.lit(""), F.lit(0.0))
    draw = F.pmod(F.xxhash64("hash", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language_id")
        for batch in batches:
            found, shares = [], []
            batch = batch.filter(pa.array([bool(LETTER.search(t.as_py())) for t in batch.column("text")], pa.bool_()))
            for text in batch.column("text"):
                count = np.zeros(BUCKETS, np.int64)
                for b in buckets(text.as_py()):
                    count += np.bincount(b, minlength=BUCKETS)
                at = np.flatnonzero(count)
                found.append(at.astype(np.int32).tobytes())
                shares.append((count[at] / count.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("order"),
                                              pa.array(found, pa.binary()), pa.array(shares, pa.binary())],
                                             names=["lang", "order", "buckets", "shares"])

    drawn = (labelled.withColumn("order", draw).filter(F.col("order") < share[F.col("lang")])
             .groupBy("lang", "hash").agg(F.first("order").alias("order"), F.min("text").alias("text"))  # copies count once
             .select("lang", "order", "text").mapInArrow(features, "lang string, order double, buckets binary, shares binary"))
    taken: dict[str, list] = {}
    for lang, order, b, s in sorted(map(tuple, drawn.collect()), key=lambda r: (r[0], r[1], r[2])):
        taken.setdefault(lang, []).append((lang, np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)))
    return [r for rows in taken.values() for r in rows[:per_language]]


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], steps: int, rate: float, reject_rate: float, seed: int) -> Model:
    languages = sorted({r[0] for r in rows})
    n = len(languages)
    if not rows:
        return Model([], np.zeros((BUCKETS, 1), np.float32), np.zeros(0), 1.0, 1.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    kept = max(1, len(rows) // 5) if len(rows) >= 10 else 0
    tuning, learning = order[:kept], order[kept:]
    label = np.array([languages.index(r[0]) for r in rows])
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (DIMENSIONS, n)).astype(np.float32), np.zeros(n, np.float32)

    def hidden(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at = np.concatenate([rows[i][1] for i in part])
        share = np.concatenate([rows[i][2] for i in part])
        sizes = np.array([len(rows[i][1]) for i in part])
        return np.add.reduceat(vectors[at] * share[:, None], np.cumsum(sizes) - sizes), at, share, sizes

    step = 0
    while step < steps:
        shuffled = rng.permutation(learning)
        for a in range(0, len(shuffled), 32)[:steps - step]:
            part = shuffled[a:a + 32]
            h, at, share, sizes = hidden(part)
            g = softmax(h @ weights + bias)
            g[np.arange(len(part)), label[part]] -= 1
            lr = rate * (1 - step / steps)
            step += 1
            back = np.repeat(g @ weights.T, sizes, axis=0) * share[:, None]
            weights -= lr / len(part) * (h.T @ g)
            bias -= lr / len(part) * g.sum(axis=0)
            for k in range(DIMENSIONS):  # each bucket's vector, averaged features: a larger step
                vectors[:, k] -= lr * np.bincount(at, back[:, k], BUCKETS).astype(np.float32)
    z = hidden(tuning)[0] @ weights + bias if kept else np.zeros((0, n))
    temperature, threshold = 1.0, 0.0
    if kept:
        def loss(t: float) -> float:
            return -np.log(softmax(z / t)[np.arange(kept), label[tuning]] + 1e-12).mean()

        temperature = float(min(np.geomspace(0.25, 20, 89), key=loss))
        threshold = float(min(1.2 / n, np.quantile(softmax(z / temperature).max(axis=1), reject_rate)))
    shares = np.zeros((n, BUCKETS))
    for i in learning:
        shares[label[i], rows[i][1]] += rows[i][2]
    shares /= np.maximum(np.bincount(label[learning], minlength=n), 1)[:, None]
    known, least = familiarity(shares), -np.inf
    if kept >= LEAST_TUNING:
        def familiar(table: np.ndarray, i: int) -> float:
            return float(table[rows[i][1]] @ rows[i][2])

        strange = [familiarity(np.delete(shares, k, axis=0)) for k in range(n)]
        own = np.quantile([familiar(known, i) for i in tuning], reject_rate)
        least = float(own + min(own, np.median([familiar(strange[label[i]], i) for i in tuning]))) / 2
    folded = np.concatenate([(vectors @ weights).astype(np.float32), known[:, None]], axis=1)
    return Model(languages, folded, bias.astype(np.float64), temperature, threshold, least)


def familiarity(shares: np.ndarray) -> np.ndarray:
    """Log share of every bucket in the language that has most of it, against an equal share."""
    return np.log(shares.max(axis=0, initial=0) * BUCKETS + 0.1).astype(np.float32)


def train(labelled: DataFrame, per_language: int = 500, most_languages: int = 200, steps: int = 400, rate: float = 4.0,
          reject_rate: float = 0.001, seed: int = 7, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> Model:
    """Fit on at most ``per_language`` texts of each of at most ``most_languages`` languages of ``labelled``, in ``steps``
    batches of 32."""
    source = labelled.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"),
                             F.col(f"`{lang}`").cast("string").alias("lang"))
    usable = source.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return fit(sample(usable, per_language, most_languages), steps, rate, reject_rate, seed)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred, score and accepted."""
    results = ["lang_pred", "score", "accepted"]
    keep = [c for c in docs.columns if c not in results]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType(source.schema.fields[:-1] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("accepted", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language_id")
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(len(keep))]
            columns = list(zip(*found)) if found else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [
                    pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.bool_())], names=[*keep, *results])

    return source.mapInArrow(run, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string")) % folds
