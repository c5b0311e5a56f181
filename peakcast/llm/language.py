"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three bytes of folded letters; a run of letters is
padded by one space on each side) of a language in order of frequency. A document's own ordered list is
compared to each profile by the out-of-place distance: for each of its n-grams the difference of ranks, or
the profile's length if the profile lacks it. The nearest profile names the language.

Which scores are too low for any learned language depends on the number of a document's n-grams: the training
documents' own scores give a mean and a deviation as smooth functions of it (``Floor``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bounded_groups, doc_text, fold, one_text, smallest_by_hash, stored
from .textio import Texts, chunks

FOLDS, HELD_OUT = 3, 1
#: Length of profiles and of documents' lists.
TOP = 300
UNKNOWN = "und"
#: Bytes of text whose n-grams a worker holds at a time while learning (12 bytes for each).
LEARN_BYTES = 1 << 18
#: Bins in which the median of scores is looked for.
BINS = 4096
#: The pipeline rejects documents scored more than this many deviations under the training documents' mean at their
#: number of n-grams.
DEVIATIONS = 4.5

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def letters(t: Texts) -> np.ndarray:
    """Bytes with letters folded and every other ASCII byte a space. Upper case of the two-byte Latin letters
    (U+00C0 to U+00DE, lead byte C3) is folded too."""
    b = _FOLD[t.data]
    lead = np.flatnonzero(t.data[:-1] == 0xC3)
    nxt = t.data[lead + 1]
    up = lead[(nxt >= 0x80) & (nxt <= 0x9E) & (nxt != 0x97)] + 1
    b[up] += 32
    return b


def ranked(t: Texts, top: int | None = TOP):
    """For each text, its n-gram codes in order of count (ties by code), ``top`` at most, and their counts."""
    b = letters(t)
    for i, j in zip(t.starts[:-1].tolist(), t.starts[1:].tolist()):
        x = b[i:j]
        space = x == 32
        keep = ~space
        keep[1:] |= ~space[:-1]  # of a run of spaces only the first, which pads the word before it and the one after
        x = np.concatenate([[32], x[keep], [32]]).astype(np.int32)
        if len(x) > 1 and x[1] == 32:
            x = x[1:]
        if len(x) > 1 and x[-2] == 32:
            x = x[:-1]
        two = (x[:-1] << 8) | x[1:]
        three = (two[:-1] << 8) | x[2:]
        codes = np.concatenate([x[x != 32], two + (1 << 24), three + (2 << 24)])
        if len(x) < 3:
            codes = codes[:0]
        codes.sort()
        at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(codes)))
        codes = codes[at]
        if top is not None:
            if len(n) > top:  # all at or above the count of the top-th, then in order
                cut = np.partition(n, len(n) - top)[len(n) - top]
                sel = n >= cut
                codes, n = codes[sel], n[sel]
            order = np.argsort(-n, kind="stable")[:top]
            codes, n = codes[order], n[order]
        yield codes, n


@dataclass
class Profiles:
    """Ranks of the n-grams that any profile has, by language (missing: the profile's length)."""
    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray

    def nearest(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the nearest language, score, number of n-grams compared) of each text. The score is one minus the
        distance as a share of the largest possible one; a text without n-grams has score 0."""
        best, score, size = np.zeros(len(t), np.int64), np.zeros(len(t)), np.zeros(len(t), np.int64)
        own = np.arange(TOP)
        for d, (codes, _) in enumerate(ranked(t)):
            if not len(codes):
                continue
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            r = self.ranks[:, at]
            known = (self.codes[at] == codes) & (r < TOP)
            dist = np.where(known, np.abs(r - own[:len(codes)]), TOP).sum(axis=1)
            best[d] = dist.argmin()
            score[d] = 1 - dist[best[d]] / (TOP * len(codes))
            size[d] = len(codes)
        return best, score, size


@dataclass
class Floor:
    """Scores by number of n-grams: their mean, a polynomial in its logarithm, and the variance below it, a + b / size."""
    low: float
    high: float
    mean: np.ndarray
    variance: tuple[float, float]

    def at(self, size: np.ndarray, deviations: float) -> np.ndarray:
        """Least score that is accepted at a number of n-grams; beyond the training documents' range, that of its end."""
        x = np.clip(np.log(np.maximum(size, 1)), self.low, self.high)
        return np.polyval(self.mean, x) - deviations * np.sqrt(self.variance[0] + self.variance[1] * np.exp(-x))


def _middle(counts: DataFrame, value: Column) -> float:
    """The median of ``value`` (0 to 1) over rows that each stand for ``n``: first the bins that hold the middle ranks, then
    the values in these."""
    d = counts.select(value.alias("v"), "n").withColumn("bin", F.floor(F.col("v") * BINS))
    bins = sorted((r["bin"], r["n"]) for r in d.groupBy("bin").agg(F.sum("n").alias("n")).collect())  # BINS + 1 rows at most
    upto = np.cumsum([n for _, n in bins])
    ranks = np.array([(upto[-1] - 1) // 2, upto[-1] // 2])
    first, last = np.searchsorted(upto, ranks, "right")
    before = int(upto[first - 1]) if first else 0
    rows = sorted((r["v"], r["n"]) for r in d.filter(F.col("bin").between(bins[first][0], bins[last][0])).groupBy("v").agg(F.sum("n").alias("n")).collect())
    at = np.searchsorted(np.cumsum([n for _, n in rows]) + before, ranks, "right")
    return float(np.mean([rows[i][0] for i in at]))


def fit_floor(counts: DataFrame) -> Floor:
    """Least squares over ``counts`` (size, score, n: how many texts have them); a number of n-grams weighs the root of its
    documents, most of which have TOP. Scores far under the median, and then those far under the fit, are left out of the
    next one: a few junk documents among the training ones neither lower the mean nor widen the variance, which has a
    least value for tables of few or equal texts. The driver sees sums by number of n-grams, TOP + 1 rows of a task."""
    if not counts.head(1):
        return Floor(0.0, 0.0, np.zeros(1), (0.0, 0.0))
    sizes = np.arange(TOP + 1)
    logs = np.log(np.maximum(sizes, 1))

    def sums(low: np.ndarray, high: np.ndarray | None = None) -> np.ndarray:
        """Rows n, sum and sum of squares by number of n-grams, of the scores from ``low`` to ``high`` at that number."""
        def work(batches):
            out = np.zeros((3, TOP + 1))
            for b in batches:
                size, score, rows = (np.asarray(b.column(i)) for i in range(3))
                kept = (score >= low[size]) & (True if high is None else score <= high[size])
                off = (score if high is None else score - high[size])[kept]
                for total, x in zip(out, (1, off, off * off)):
                    total += np.bincount(size[kept], rows[kept] * x, TOP + 1)
            yield pa.RecordBatch.from_arrays([pa.array(sizes), *map(pa.array, out)], names=["size", "n", "s", "q"])

        # TOP + 1 rows of a task, added up here: a shuffle for each of up to 17 sums costs the driver more than it saves.
        got = counts.select("size", "score", "n").mapInArrow(work, "size long, n double, s double, q double").toArrow()
        out = np.zeros((3, TOP + 1))
        for total, name in zip(out, ("n", "s", "q")):
            total += np.bincount(np.asarray(got.column("size")), np.asarray(got.column(name)), TOP + 1)
        return out

    middle = _middle(counts, F.col("score"))
    low = np.full(TOP + 1, middle - max(0.25, 5 * _middle(counts, F.abs(F.col("score") - middle))))
    n, total, _ = sums(low)
    for _ in range(8):
        has = n > 0
        x, weight = logs[has], 1 / np.sqrt(n[has])
        mean = np.polyfit(x, total[has] / n[has], min(2, int(has.sum()) - 1, int(n.sum()) // 20), w=np.sqrt(n[has] * weight))
        below, _, square = (v[has] for v in sums(low, np.polyval(mean, logs)))
        some = below > 0
        inverse, square, weight = np.exp(-x[some]), square[some] / below[some], (below * weight)[some]
        slope = max(0.0, float(np.polyfit(inverse, square, 1, w=np.sqrt(weight))[0])) if some.sum() > 20 else 0.0
        level = float((weight * (square - slope * inverse)).sum() / max(weight.sum(), 1e-12))
        fit = Floor(float(x.min()), float(x.max()), mean, (max(0.04 ** 2, level), slope))
        low = np.maximum(low, fit.at(sizes, DEVIATIONS))
        fewer, total, _ = sums(low)
        if fewer.sum() == n.sum():
            break
        n = fewer
    return fit


def training_ids(docs: DataFrame, max_train: int) -> DataFrame:
    """doc_id, lang of at most ``max_train`` documents for each language, outside the held-out fold."""
    d = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
         .filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)))
    return smallest_by_hash(d, "lang", "doc_id", max_train)


def training_texts(docs: DataFrame, max_train: int | None = None) -> DataFrame:
    """lang, text of the training documents, a row each however often an id stands there: all documents outside the held-out
    fold that have a language, or with ``max_train`` that many of each language. More than MAX_GROUPS languages are an error."""
    if max_train is None:
        rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
        rows = bounded_groups(rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)), "lang")
        # Only the texts of ids that stand there several times are grouped; few as these are, the others are not shuffled.
        keys = ["lang", "doc_id"]
        repeated = stored(rows.groupBy(*keys).count().filter("count > 1").select(*keys), "repeated-ids")
        return (rows.join(repeated, keys, "left_anti").select("lang", "text")
                .unionByName(one_text(rows.join(repeated, keys, "left_semi"), keys).select("lang", "text")))
    ids = bounded_groups(stored(training_ids(docs, max_train), "training-ids"), "lang")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    return one_text(text.join(F.broadcast(ids), ["doc_id", "lang"]), ["lang", "doc_id"]).select("lang", "text")


def learn(texts: DataFrame, top: int = TOP) -> Profiles:
    """Profiles of the languages of ``texts`` (lang, text): at most ``top`` entries each. N-grams are counted in the tasks and
    summed by Spark; only the profiles reach the driver."""
    def work(batches):
        for b in batches:
            langs = np.asarray(b.column(0).to_pylist(), object)
            for lo, hi, t in chunks(b.column(1), LEARN_BYTES):
                found = list(ranked(t, None))
                for lang in sorted(set(langs[lo:hi])):
                    mine = [x for x, who in zip(found, langs[lo:hi]) if who == lang]
                    codes, inv = np.unique(np.concatenate([c for c, _ in mine]), return_inverse=True)
                    n = np.bincount(inv, np.concatenate([n for _, n in mine]), len(codes)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int32)), pa.array(n)],
                                                     names=["lang", "code", "n"])

    counts = (texts.select("lang", "text").mapInArrow(work, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")))
    by = W.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = counts.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= top).select("lang", "code", "r").toPandas()
    languages = sorted(rows["lang"].unique())
    codes = np.unique(rows["code"].to_numpy(np.int32))
    ranks = np.full((len(languages), len(codes)), top, np.int32)
    ranks[np.searchsorted(languages, rows["lang"]) if len(rows) else [], np.searchsorted(codes, rows["code"])] = rows["r"] - 1
    return Profiles(languages, codes, ranks)


def _predictor(docs: DataFrame, profiles: Profiles):
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.arrow_udf("struct<best: int, score: double, size: long>")
    def predict(column: pa.Array) -> pa.Array:
        parts = [shared.value.nearest(t) for _, _, t in chunks(column)]
        best = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        score = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
        size = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(score), pa.array(size)], names=["best", "score", "size"])

    return predict


def identify(docs: DataFrame, max_train: int | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred (a learned language, or ``und``), score (0 to 1), per input row.

    Texts that are null or have no letter are ``und`` with score 0; texts with letters that no profile has get the
    first of the nearest languages. Ties go to the first language in order. If nothing can be learned (no row with a
    language outside the held-out fold), all rows are ``und``. A null id falls in fold 0. Empty table: no rows.
    """
    profiles = learn(training_texts(docs, max_train))
    d = doc_text(docs)
    held = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    if not profiles.languages:
        return d.select("doc_id", held, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    names = F.array(*map(F.lit, profiles.languages))
    p = d.select("doc_id", held, has_letter.alias("has_letter"), _predictor(docs, profiles)(F.col("text")).alias("p"))
    return p.select("doc_id", "held_out", F.when(F.col("has_letter"), F.get(names, F.col("p.best"))).otherwise(UNKNOWN).alias("lang_pred"),
                    F.when(F.col("has_letter"), F.col("p.score")).otherwise(0.0).alias("score"))


def floor(texts: DataFrame, profiles: Profiles) -> Floor:
    """The floor of the scores of ``texts`` (the training texts), all of which are scored."""
    p = texts.select(_predictor(texts, profiles)(F.col("text")).alias("p")).select("p.size", "p.score").filter(F.col("size") > 0)
    return fit_floor(stored(p.groupBy("size", "score").agg(F.count(F.lit(1)).alias("n")), "training-scores"))


def accept(docs: DataFrame, max_train: int | None = None, deviations: float = DEVIATIONS) -> DataFrame:
    """``docs`` (all its columns) without the rows that no learned language fits: null texts, texts without letters, and
    scores under the training documents' floor at the text's number of n-grams, whatever its length."""
    texts = training_texts(docs, max_train)
    if max_train is not None:
        texts = stored(texts, "training-texts")
    profiles = learn(texts)
    if not profiles.languages:
        return docs.limit(0)
    least = floor(texts, profiles)
    predict = _predictor(docs, profiles)

    @F.arrow_udf("boolean")
    def fits(p: pa.Array) -> pa.Array:
        return pa.array(np.asarray(p.field("score"), float) >= least.at(np.asarray(p.field("size"), np.int64), deviations))

    text = F.col("text").cast("string")
    return docs.filter(text.rlike(r"\p{L}")).filter(fits(predict(text)))
