"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader (per-coordinate rates, elastic net: l1 leaves most
weights exactly 0, l2 shrinks the rest), then calibrated by one temperature on rows kept back.

The model is fitted on at most ``most`` labelled rows (the smallest hashes of doc_id), whose n-gram
counts are made on the executors; the driver gets at most ``2 ** bits`` counts for each.  Prediction
is one narrow pass without shuffle; what travels to the executors is the weight table, of fixed size.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; null langs teach
nothing; a table without labels gives ``und`` with score 0 for every row; with a single language
every text with a letter gets it with score 1; null doc_ids are kept; rows that repeat are told alike, and count once in
the sample; ties go to the first language in order; an empty table gives no rows; a text of any length is told
1.5 million characters at a time, with the characters that n-grams reach over; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.llm import chargrams
from fundlake.llm.common import held_out, plain_names, ship, slices
from fundlake.llm.sampling import by_hash

ORDERS, BITS, SCALE = (1, 2, 3), 16, 20.0
SLICE = 1_500_000
#: ``Model.least`` is this part of the lowest score among the rows kept back.
LEAST_PART = 0.7


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (2 ** BITS, languages), inverse document frequency included
    bias: np.ndarray
    temperature: float
    least: float = 0.0  # a calibrated score well under that of any row of a known language kept back


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, k) and bias after ``epochs`` passes of one row at a time."""
    size = 1 << BITS
    z, n = np.zeros((size, k)), np.zeros((size, k))
    zb, nb = np.zeros(k), np.zeros(k)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            w, b = weights(z[at], n[at]), -zb / ((beta + np.sqrt(nb)) / alpha + l2)
            s = x @ w + b
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
            zb += p + (np.sqrt(nb + p * p) - np.sqrt(nb)) / alpha * zb / ((beta + np.sqrt(nb)) / alpha + l2)
            nb += p * p
    return weights(z, n), -zb / ((beta + np.sqrt(nb)) / alpha + l2)


def _temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by golden section over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, buckets and counts of each row's n-grams, and their total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1), SLICE):
                rows = []
                for t, lang in zip(texts, b.column(0).slice(at, len(texts)).to_pylist()):
                    if chargrams.has_letter(t):
                        n = np.zeros(1 << BITS, np.int64)
                        for ((_, piece, k),) in chargrams.segments([t], max(ORDERS), SLICE):
                            c, _ = chargrams.codes([piece], max(ORDERS))
                            n += sum(np.bincount(g[:k], minlength=1 << BITS) for _, g in chargrams.grams(c, ORDERS, BITS))
                        at_ = np.flatnonzero(n)
                        rows.append({"lang": lang, "at": at_.astype("<i4").tobytes(), "n": n[at_].astype("<f4").tobytes(), "total": len(t) + 1})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("lang", pa.string()), ("at", pa.binary()), ("n", pa.binary()), ("total", pa.int64())]))

    return docs.mapInArrow(run, "lang string, at binary, n binary, total long")


def train(docs: DataFrame, most: int = 3000, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 1.0) -> Model:
    """Fits on at most ``most`` rows of ``docs`` (doc_id, text, lang) with a lang, held-out rows excluded."""
    ship(docs.sparkSession)
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = by_hash(known, most).select("lang", "text")
    found = sorted((r.lang, bytes(r.at), bytes(r.n), r.total) for r in count_grams(sample).collect())
    langs = sorted({f[0] for f in found})
    if len(langs) < 2:
        return Model(langs, np.zeros((1 << BITS, len(langs)), np.float32), np.zeros(len(langs), np.float32), 1.0)
    raw = [(np.frombuffer(a, "<i4"), np.frombuffer(n, "<f4") / total) for _, a, n, total in found]
    y = np.array([langs.index(f[0]) for f in found])
    df = np.zeros(1 << BITS)
    for at, _ in raw:
        df[at] += 1
    idf = (np.log((1 + len(raw)) / (1 + df)) + 1) * SCALE
    rows = [(at, tf * idf[at]) for at, tf in raw]
    back = np.random.default_rng(11).random(len(rows)) < 0.2
    w, b = _ftrl([r for r, x in zip(rows, back) if not x], y[~back], len(langs), epochs, alpha, beta, l1, l2)
    scores = np.array([x @ w[at] + b for (at, x), z in zip(rows, back) if z]).reshape(-1, len(langs))
    t = _temperature(scores, y[back])
    sure = 1 / np.exp(scores / t - (scores / t).max(axis=1, keepdims=True)).sum(axis=1)
    least = max(1 / len(langs), LEAST_PART * float(sure.min())) if len(sure) else 0.0
    return Model(langs, (w * idf[:, None]).astype(np.float32), b.astype(np.float32), t, least)


def score_texts(texts: list[str], model: Model, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of each text's most likely language, and its calibrated probability."""
    weights = model.weights if weights is None else weights
    summed, lens = np.zeros((len(texts), len(model.langs))), np.array([len(t) + 1 for t in texts])
    for run in chargrams.segments(texts, max(ORDERS), SLICE):
        c, starts = chargrams.codes([piece for _, piece, _ in run], max(ORDERS))
        total = np.zeros((len(c), len(model.langs)), np.float32)
        for _, g in chargrams.grams(c, ORDERS, BITS):
            total += weights[g]
        for (_, _, k), at, end in zip(run, starts, np.append(starts[1:], len(c))):
            total[at + k : end] = 0  # n-grams that the next piece counts, or that reach into the next text
        np.add.at(summed, [i for i, _, _ in run], np.add.reduceat(total, starts, axis=0, dtype=np.float64))
    s = (summed / lens[:, None] + model.bias) / model.temperature
    p = np.exp(s - s.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p.argmax(axis=1), p.max(axis=1)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with lang_pred and score; columns of those names are replaced."""
    ship(docs.sparkSession)
    rows, own = plain_names(docs, "lang_pred", "score")
    kept, where = rows.columns, own.index("text")
    schema = T.StructType([*rows.schema.fields]).add("lang_pred", "string").add("score", "double")
    light = Model(model.langs, np.zeros(0), model.bias, model.temperature, model.least)
    table = docs.sparkSession.sparkContext.broadcast(model.weights)  # 256 KB for each language, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(where).cast(pa.string()), SLICE):
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                which = [i for i, t in enumerate(texts) if chargrams.has_letter(t)] if light.langs else []
                if which:
                    best, p = score_texts([texts[i] for i in which], light, table.value)
                    score[which] = p
                    for i, k in zip(which, best):
                        lang[i] = light.langs[k]
                yield pa.RecordBatch.from_arrays([*b.slice(at, len(texts)).columns, pa.array(lang, pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])

    return rows.mapInArrow(run, schema).toDF(*own, "lang_pred", "score")
