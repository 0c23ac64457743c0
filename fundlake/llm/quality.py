"""Quality rules: exact document statistics, two base rules, and gradient-boosted trees over the statistics.

Words are runs without ASCII white space.  The trees are grown on histograms with numpy, flattened
into node arrays, and score a whole batch level by level; a feature's sign in ``MONOTONE`` makes the
model never rise (-1) or never fall (1) with it: a split that would break this is not taken, and the
values below it are held on their side of the split's middle.

The model is fitted on at most ``most`` labelled rows (the smallest hashes of doc_id).  Statistics and
scores are made in one narrow pass without shuffle; the node arrays are a few KB.

Defined cases: a null or empty text has no words and fails the base rules; null doc_ids are kept;
null labels teach nothing, of repeated labels the largest counts; without both labels the verdict
is that of the base rules; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import held_out, ship, slices
from fundlake.llm.sampling import labelled, with_texts

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The features in order, and how the score may move with each.
MONOTONE = {"log_words": 0, "word_length": 0, "symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "distinct_rate": 0, "digit_rate": 0, "upper_rate": 0, "stop_rate": 0, "line_words": 0, "mark_rate": 0, "long_word_rate": 0}
WINDOW = 5


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more, by exact ranks of 2, 4 and 5 words."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    if len(seen) == len(words):
        return 0

    def pairs(a, b):
        return np.unique(a * (b.max() + 1) + b, return_inverse=True)[1].astype(np.int64)

    two = pairs(ids[:-1], ids[1:])
    four = pairs(two[:-2], two[2:])
    five = pairs(four[:n], ids[WINDOW - 1 :])
    again = np.bincount(five)[five] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The STATS of a text, and its features in the order of MONOTONE."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(raw.count, (BLANKS[i : i + 1] for i in range(len(BLANKS)))))
    symbols = sum(map(raw.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS)))))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    if not n:
        return [0, 0, symbols, 0, 0], [0.0] * len(MONOTONE)
    b = np.frombuffer(raw, np.uint8)
    digits = int(((b >= 48) & (b <= 57)).sum())
    upper = int(((b >= 65) & (b <= 90)).sum())
    marks = sum(map(raw.count, (b".", b",", b"!", b"?", b";", b":")))
    short = sum(1 for w in words if len(w) <= 3)
    long = sum(1 for w in words if len(w) > 12)
    features = [np.log1p(n), chars / n, symbols / chars, dup / len(lines), repeat / n, len(set(words)) / n, digits / chars, upper / chars, short / n, np.log1p(n / len(lines)), marks / n, long / n]
    return [n, chars, symbols, dup, repeat], [float(x) for x in features]


def base_failed(n_words, n_repeat_words):
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


# ---------------------------------------------------------------- trees

@dataclass
class Forest:
    """Nodes of all trees: feature (-1 at leaves), threshold, children and value; roots; depth."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                low = x[rows, np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(f < 0, at, np.where(low, self.left[at], self.right[at]))
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: int = 8) -> Forest:
    """Gradient-boosted trees of the logistic loss."""
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    total = np.full(len(y), bias)

    def node():
        for a, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    def grow(rows, g, h, level, low, high):
        at = node()
        best = float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high))
        value[at] = best * rate
        if level < depth and len(rows) >= 2 * least:
            found, gs, hs = None, g[rows].sum(), h[rows].sum()
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                vl, vr = -gl / (hl + l2), -(gs - gl) / (hs - hl + l2)
                gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                ok = (nl >= least) & (len(rows) - nl >= least) & (signs[f] * (vr - vl) >= 0)
                gain = np.where(ok, gain, 0)
                k = int(gain.argmax())
                if gain[k] > 1e-6 and (found is None or gain[k] > found[0]):
                    found = gain[k], f, k, vl[k], vr[k]
            if found:
                _, f, k, vl, vr = found
                mid = float(np.clip((vl + vr) / 2, low, high))
                a = (low, mid) if signs[f] > 0 else (mid, high) if signs[f] < 0 else (low, high)
                z = (mid, high) if signs[f] > 0 else (low, mid) if signs[f] < 0 else (low, high)
                goes = binned[rows, f] <= k
                feature[at], threshold[at] = f, float(cuts[f][k])
                left[at] = grow(rows[goes], g, h, level + 1, *a)
                right[at] = grow(rows[~goes], g, h, level + 1, *z)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        first = len(feature)
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        tree = Forest(*(np.array(a) for a in (feature, threshold, left, right, value)), np.array([first]), depth, 0.0)
        s = tree.score(x)
        total += np.log(s / (1 - s))
    return Forest(*(np.array(a) for a in (feature, threshold, left, right, value)), np.array(roots), depth, bias)


# ---------------------------------------------------------------- over DataFrames

def train(docs: DataFrame, labels: DataFrame, most: int = 4000) -> Forest | None:
    """Fits on at most ``most`` labelled rows that are not held out; None without both labels."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array([statistics(t)[1] for t in texts], pa.list_(pa.float64()))], ["label", "x"])

    picked = labelled(labels, "quality", ~held_out(), most)
    rows = sorted((tuple(r.x), r.label) for r in with_texts(docs, picked).select("label", "text").mapInArrow(run, "label int, x array<double>").collect())
    y = np.array([label for _, label in rows], float)
    if len(np.unique(y)) < 2:
        return None
    return boost(np.array([x for x, _ in rows]), y, list(MONOTONE.values()))


def judge(docs: DataFrame, model: Forest | None, least: float = 0.5) -> DataFrame:
    """doc_id, the STATS, base_failed, score and kept of every row."""
    ship(docs.sparkSession)
    names = ["doc_id", *STATS, "base_failed", "kept", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1)):
                got = [statistics(t) for t in texts]
                stats = np.array([s for s, _ in got], np.int64)
                failed = base_failed(stats[:, 0], stats[:, 4])
                score = model.score(np.array([f for _, f in got])) if model else np.ones(len(texts))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), *(pa.array(stats[:, k]) for k in range(len(STATS))), pa.array(failed), pa.array(~failed & (score >= least)), pa.array(score)], names)

    kinds = ", ".join(f"{c} long" for c in ("doc_id", *STATS))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"{kinds}, base_failed boolean, kept boolean, score double")
