"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on the presence of hashed character n-grams (4 to 6 characters with word starts
and ends), trained with numpy on confirmed toxic texts and unlabelled text.  With class prior p the
risk is ``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])``: what the toxic texts among the unlabelled
add to the negative risk is taken off, and a negative estimate is walked back up instead of down.

The prior is the share of label 1 among all labelled rows that may be learnt from: labels are taken to be given to
documents regardless of what they say (a test holds it against the share found in all documents).  At most ``most``
positive and ``2 * most`` unlabelled rows (smallest hashes of doc_id) are used; their n-gram counts
are summed on the executors and only n-grams that tell the two sets apart reach the driver: those whose
share among positives is higher by ``LEAST_Z`` standard errors and which, by the prior, are toxic in
``LEAST_SHARE`` of the texts that have them (2^20 buckets bound their number).  Scoring is one narrow pass without shuffle.

Defined cases: a null or empty text is scored like any other (no n-gram present); null doc_ids are
kept; null labels teach nothing, of repeated labels the largest counts; without a confirmed toxic row
every score is the prior (0 where nothing is labelled); rows that repeat score alike, and texts that repeat count once
in the sample; a score of exactly 0.5 is predicted 1; an empty table gives no rows; a text of any length is read
1.5 million characters at a time, with the characters that n-grams reach over; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm import chargrams
from fundlake.llm.common import discard, held_out, materialise, ship, slices
from fundlake.llm.sampling import by_hash, labelled, with_texts

ORDERS, BITS = (4, 5, 6), 20
SLICE = 1_500_000
LEAST_Z, LEAST_SHARE = 4, 0.3


@dataclass
class Model:
    ids: np.ndarray  # selected buckets, ascending
    weights: np.ndarray
    bias: float


def present(texts: list[str], chosen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs without repeats; with ``chosen`` (feature number or -1 by bucket) only of those."""
    pairs = [np.zeros(0, np.int64)]
    for run in chargrams.segments(texts, max(ORDERS), SLICE):
        c, starts = chargrams.codes([piece for _, piece, _ in run], max(ORDERS))
        ends = np.append(starts[1:], len(c))
        doc = np.repeat(np.array([i for i, _, _ in run], np.int64), ends - starts)
        for (_, _, k), at, end in zip(run, starts, ends):
            doc[at + k : end] = len(texts)  # n-grams that the next piece counts, or that reach into the next text
        found = []
        for _, g in chargrams.grams(c, ORDERS, BITS):
            if chosen is None:
                found.append(doc << BITS | g.astype(np.int64))
            else:
                f = chosen[g]
                at = np.flatnonzero(f >= 0)
                found.append(doc[at] << BITS | f[at])
        pairs.append(np.unique(np.concatenate(found)))
    pairs = np.unique(np.concatenate(pairs)) if len(pairs) > 2 else pairs[-1]
    pairs = pairs[: np.searchsorted(pairs, len(texts) << BITS)]
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def select(sample: DataFrame, prior: float) -> np.ndarray:
    """Buckets in which label 1 is surely commoner and, by the prior, not rare: however many they are.

    There is no ranking and no cap: words of small groups would lose their places to those of large ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << BITS), np.int32)
        rows = np.zeros(2, np.int64)
        for b in batches:
            for at, texts in slices(b.column(1), SLICE):
                label = b.column(0).slice(at, len(texts)).to_numpy()
                doc, g = present(texts, None)
                for k in (0, 1):
                    n[k] += np.bincount(g[label[doc] == k], minlength=1 << BITS).astype(np.int32)
                    rows[k] += (label == k).sum()
        if rows.sum():
            at = np.flatnonzero(n.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), *(pa.array(np.append(n[k][at], rows[k]), pa.int64()) for k in (1, 0))], ["id", "p", "u"])

    counts = sample.select("label", "text").repartition(1 + sample.sparkSession.sparkContext.defaultParallelism // 2).mapInArrow(run, "id long, p long, u long").groupBy("id").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    found = counts.where(F.col("p") >= 3)
    size = found.where("id = -1").first()
    if size is None or not size.p:
        return np.zeros(0, np.int64)
    rate_p, rate_u = (F.col("p") + 0.5) / (size.p + 1), (F.col("u") + 0.5) / (size.u + 1)
    pool = (F.col("p") + F.col("u")) / (size.p + size.u)
    surely = rate_p - rate_u > LEAST_Z * F.sqrt(pool * (1 - pool) * (1 / size.p + 1 / max(size.u, 1)))
    telling = found.where("id >= 0").where(surely & (prior * rate_p > LEAST_SHARE * rate_u))
    return np.sort(np.array([r.id for r in telling.select("id").collect()], np.int64))


def nnpu(x_p: list[np.ndarray], x_u: list[np.ndarray], size: int, prior: float, steps: int = 400, rate: float = 0.05, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model, by Adam on the logistic loss of all rows."""
    w, m, v = (np.zeros(size + 1) for _ in range(3))  # the last is the bias
    w[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    (doc_p, f_p), (doc_u, f_u) = ((np.repeat(np.arange(len(x)), [len(r) for r in x]), np.concatenate(x).astype(np.int64)) for x in (x_p, x_u))

    def gradient(doc, f, by):
        return np.append(np.bincount(f, by[doc], size), by.sum())

    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -35, 35)))
    for t in range(1, steps + 1):
        s_p, s_u = (np.bincount(doc, w[f], len(x)) + w[-1] for doc, f, x in ((doc_p, f_p, x_p), (doc_u, f_u, x_u)))
        negative = np.logaddexp(0, s_u).mean() - prior * np.logaddexp(0, s_p).mean()
        down = gradient(doc_u, f_u, sigmoid(s_u) / len(x_u)) - prior * gradient(doc_p, f_p, sigmoid(s_p) / len(x_p))
        g = prior * gradient(doc_p, f_p, -sigmoid(-s_p) / len(x_p)) + down if negative >= 0 else -down
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, most: int = 3000) -> Model:
    """Fits on ``labels.toxic`` = 1 rows and on rows drawn from all documents, held-out rows excluded."""
    ship(docs.sparkSession)
    free = ~held_out()
    prior = labels.where(free & F.col("toxic").isNotNull()).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    positive = labelled(labels, "toxic", free & (F.col("toxic") == 1), most)
    unlabelled = by_hash(docs.select("doc_id").where(F.col("doc_id").isNotNull() & free), 2 * most).distinct().withColumn("label", F.lit(0))
    # copies of one text would make all its n-grams look telling
    sample, made = materialise(with_texts(docs, positive).unionByName(with_texts(docs, unlabelled)).select("label", "text").dropDuplicates(), "sample")
    ids = select(sample, prior) if prior else np.zeros(0, np.int64)
    if not len(ids):
        discard(docs.sparkSession, made)
        return Model(ids, np.zeros(0, np.float32), float(np.log(prior / (1 - prior))) if prior and prior < 1 else -35.0)
    chosen = np.full(1 << BITS, -1, np.int32)
    chosen[ids] = np.arange(len(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1), SLICE):
                doc, f = present(texts, chosen)
                cuts = np.searchsorted(doc, np.arange(1, len(texts)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array([x.tobytes() for x in np.split(f.astype(np.int32), cuts)], pa.binary())], ["label", "f"])

    rows = sorted((r.label, bytes(r.f)) for r in sample.mapInArrow(run, "label int, f binary").collect())
    discard(docs.sparkSession, made)
    x = [[np.frombuffer(f, np.int32) for label, f in rows if label == k] for k in (0, 1)]
    if not x[1]:
        return Model(ids[:0], np.zeros(0, np.float32), float(np.log(prior / (1 - prior))) if prior < 1 else -35.0)
    w, b = nnpu(x[1], x[0] or [np.zeros(0, np.int64)], len(ids), min(prior, 0.99))
    return Model(ids, w.astype(np.float32), b)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row's whole text."""
    ship(docs.sparkSession)
    chosen = np.full(1 << BITS, -1, np.int32)
    chosen[model.ids] = np.arange(len(model.ids))
    table = docs.sparkSession.sparkContext.broadcast(chosen)  # 4 MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1), SLICE):
                doc, f = present(texts, table.value)
                s = np.bincount(doc, model.weights[f], minlength=len(texts)) + model.bias if len(f) else np.full(len(texts), model.bias)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(1 / (1 + np.exp(-np.clip(s, -500, 500))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
