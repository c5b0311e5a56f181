"""Quality classifier: naive Bayes support vectors.

A document is the set of its n-gram indicators. On a bounded sample of labelled rows, each indicator's log-count
ratio between the two classes is taken; indicators scaled by it are the inputs of a linear hinge-loss model,
fitted by dual coordinate descent. A logistic curve, fitted on a part of the sample that the model has not seen,
makes the margin a probability. Scoring is one narrow pass: a sum of table entries per document.

n-grams: words (one), word shapes (one to three: runs of upper case, lower case, digits and each punctuation
mark, and whether a word repeats the one before), and three shares in octaves: of each shape among a document's
words, of distinct words, and of distinct word pairs. Indicators are hashed to ``2 ** BITS`` slots.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, fold, one_text
from .textio import SPACE_TABLE, U, Texts, Words, _powers, byte_table, chunks, mix, words

BITS = 18
FOLDS = 5
#: Labelled rows that the model is fitted on, at most (those of smallest id hash).
MAX_TRAIN = 8000
ACCEPT = 0.3

_CASED = byte_table({0x20, *range(0x09, 0x0E)}, fold_case=False)
#: Byte -> class: one for upper case, lower case (and all non-ASCII bytes), digits; each other mark its own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 2
_CLASS[0] = 4


def _shapes(t: Texts, w: Words) -> np.ndarray:
    """A hash for each word of its runs of character classes."""
    if not len(w.begin):
        return np.zeros(0, U)
    cls = _CLASS[t.data]
    start = np.ones(len(cls), bool)
    start[1:] = cls[1:] != cls[:-1]
    start[w.begin] = True
    at = np.flatnonzero(start)
    p, i = _powers(len(at) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(at) + 1, U)
        np.cumsum((cls[at].astype(U) + U(7)) * p[:len(at)], out=run[1:])
        b, e = np.searchsorted(at, w.begin), np.searchsorted(at, w.end)
        return mix((run[e] - run[b]) * i[b] + U(0x51ED270B))


def _octave(share: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(-2 * np.log2(np.maximum(share, 1e-6))), 15).astype(np.int64)


def indicators(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(slots, borders): the distinct slots of each text's n-grams."""
    w = words(t, SPACE_TABLE)
    n = len(w.hashes)
    count = np.diff(w.first)
    doc = np.repeat(np.arange(len(t), dtype=np.int64), count)
    with np.errstate(over="ignore"):
        new = np.ones(n, bool)
        new[1:] = doc[1:] != doc[:-1]
        same = np.zeros(n, bool)
        same[1:] = (w.hashes[1:] == w.hashes[:-1]) & ~new[1:]
        shape = mix(_shapes(t, w) + same.astype(U) * U(0x2545F4914F6CDD1D))
        two = mix(shape[:-1] * U(3) + shape[1:])
        three = mix(two[:-1] * U(5) + shape[2:])
        ok2 = doc[:-1] == doc[1:]
        ok3 = doc[:-2] == doc[2:]
        pair = mix(w.hashes[:-1] * U(3) + w.hashes[1:])[ok2]

        def shares(values, owner):
            """Distinct (value, document) pairs, and how often each occurs."""
            order = np.lexsort((values, owner))
            v, o = values[order], owner[order]
            first = np.ones(len(v), bool)
            first[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
            at = np.flatnonzero(first)
            c = np.diff(np.append(at, len(v)))
            return v[at], o[at], c

        sv, so, sc = shares(shape, doc)
        share = mix(sv * U(9) + _octave(sc / np.maximum(count[so], 1)).astype(U))
        distinct = []
        for tag, (values, owner) in enumerate(((w.hashes, doc), (pair, doc[:-1][ok2]))):
            _, o, _ = shares(values, owner)
            total = np.bincount(owner, minlength=len(t))
            have = np.flatnonzero(total)
            part = np.bincount(o, minlength=len(t))[have] / total[have]
            size = np.minimum(np.log2(total[have]).astype(np.int64), 8)
            distinct.append((have, mix(U(1000 + tag) + (_octave(part) * 16 + size).astype(U) * U(0x9E3779B97F4A7C15))))
        parts = [(doc, mix(w.hashes + U(11))), (so, mix(sv + U(12))), (doc[:-1][ok2], mix(two[ok2] + U(13))),
                 (doc[:-2][ok3], mix(three[ok3] + U(14))), (so, mix(share + U(15))), *distinct]
    key = np.concatenate([(o.astype(np.int64) << BITS) | (h >> U(64 - BITS)).astype(np.int64) for o, h in parts])
    key = np.unique(key)
    return (key & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(key >> BITS, np.arange(len(t) + 1))


@dataclass
class Model:
    """Slot weights (log-count ratio times coefficient), bias, and the logistic curve's slope and offset."""
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        run = np.zeros(len(slots) + 1)
        np.cumsum(self.weights[slots], out=run[1:], dtype=np.float64)
        scale = np.sqrt(np.maximum(np.diff(first), 1))
        return (run[first[1:]] - run[first[:-1]]) / scale + self.bias

    def probabilities(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.scores(slots, first) + self.offset, -40, 40)))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, c: np.ndarray,
                            epochs: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) of min |w|^2 / 2 + sum c_i max(0, 1 - y_i w x_i) by its dual."""
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    q = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            s, v = rows[i], values[i]
            grad = y[i] * (w[s] @ v + w[size]) - 1
            a = min(max(alpha[i] - grad / q[i], 0.0), c[i])
            d = (a - alpha[i]) * y[i]
            if d:
                w[s] += d * v
                w[size] += d
                alpha[i] = a
                moved = max(moved, abs(d))
        if moved < 1e-4:
            break
    return w


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1) over margins, by Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
        g = np.array([((p - t) * m).sum() + 1e-3 * (a - 1), (p - t).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * m * m).sum() + 1e-3, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step /= max(1.0, np.abs(step).max())
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def fit(rows: list[np.ndarray], y: np.ndarray, cost: float = 1.0, alpha: float = 1.0) -> Model:
    """Fit on slot sets and labels (1 or 0). Without rows of both classes the score is the smoothed prior."""
    size = 1 << BITS
    prior = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    flat = Model(np.zeros(size, np.float32), 0.0, 1.0, float(np.log(prior / (1 - prior))))
    if len(set(y.tolist())) < 2:
        return flat
    sign = np.where(y > 0, 1.0, -1.0)
    train = np.arange(len(y)) % 4 != 3
    if len(set(sign[train])) < 2 or len(set(sign[~train])) < 2:
        train = np.ones(len(y), bool)
    f = np.full((2, size), alpha)
    for k, cls in enumerate((1.0, -1.0)):
        at = np.flatnonzero(train & (sign == cls))
        f[k] += np.bincount(np.concatenate([rows[i] for i in at]), minlength=size)
        f[k] /= (len(at) + 2 * alpha)
    ratio = np.log(f[0]) - np.log(f[1])
    used = np.flatnonzero(train)
    xs = [rows[i] for i in used]
    vs = [ratio[s] / np.sqrt(max(len(s), 1)) for s in xs]
    share = {k: (sign[used] == k).mean() for k in (1.0, -1.0)}
    c = np.array([cost * 0.5 / share[k] for k in sign[used]])
    w = dual_coordinate_descent(xs, vs, sign[used], size, c)
    m = Model((ratio * w[:size]).astype(np.float32), float(w[size]), 1.0, 0.0)
    held = np.flatnonzero(~train) if not train.all() else used
    first = np.concatenate([[0], np.cumsum([len(rows[i]) for i in held])])
    m.slope, m.offset = _logistic(m.scores(np.concatenate([rows[i] for i in held]), first), sign[held])
    return m


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, label, slots of at most ``max_train`` labelled documents outside the held-out fold, a row each however often an
    id stands among the documents."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", FOLDS) != 0))
             .groupBy("doc_id").agg(F.min("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))  # the documented bound

    def work(batches):
        for b in batches:
            for lo, hi, t in chunks(b.column(2)):
                s, first = indicators(t)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(s))], names=["doc_id", "label", "slots"])

    picked = one_text(doc_text(docs).join(F.broadcast(known), "doc_id"), ["doc_id", "label"])
    return picked.select("doc_id", "label", "text").mapInArrow(work, "doc_id long, label int, slots array<int>")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    got = training_rows(docs, labels, max_train).toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    slots = got.column("slots").combine_chunks()
    rows = [np.asarray(x.values if hasattr(x, "values") else x, np.int32) for x in slots] if len(got) else []
    y = np.asarray(got.column("label"), np.int64) if len(got) else np.zeros(0, np.int64)
    return fit(rows, y)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score: one row per input row (narrow). Null and empty texts have the score of no indicators."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        m = shared.value
        for b in batches:
            for lo, hi, t in chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(m.probabilities(*indicators(t)))],
                                                 names=["doc_id", "score"])

    return doc_text(docs).mapInArrow(work, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= 0.3), per input row.

    Labels of rows in the held-out fold are not learned from; an id labelled both 0 and 1 counts as 0; other label
    values and null ids don't count. Without labels of both classes, all rows have the smoothed prior. Repeated
    rows are scored each; a null id falls in the held-out fold. An empty table gives no rows.
    """
    s = scored(docs, train(docs, labels, max_train))
    return s.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), "score",
                    F.when(F.col("score") >= ACCEPT, 1).otherwise(0).cast("int").alias("predicted"))


def accept(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` (all its columns) without the rows whose score is under 0.3."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_train))

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        out = [shared.value.probabilities(*indicators(t)) for _, _, t in chunks(column)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.filter(score(F.col("text").cast("string")) >= ACCEPT)
