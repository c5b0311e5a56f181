"""Language profiles and the floor of scores come from all training rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakcast.llm import language

MANY = 4000


def brute_floor(size, score):
    """Row by row, in numpy: (low, high, mean, variance)."""
    x = np.log(np.maximum(size, 1))
    middle = np.median(score)
    keep = score >= middle - max(0.25, 5 * np.median(np.abs(score - middle)))
    for _ in range(8):
        _, at, n = np.unique(size[keep], return_inverse=True, return_counts=True)
        weight = 1 / np.sqrt(n[at])
        mean = np.polyfit(x[keep], score[keep], min(2, len(n) - 1, int(keep.sum()) // 20), w=np.sqrt(weight))
        off = score - np.polyval(mean, x)
        below = keep & (off <= 0)
        inverse, square, weight = np.exp(-x[below]), off[below] ** 2, weight[below[keep]]
        slope = max(0.0, float(np.polyfit(inverse, square, 1, w=np.sqrt(weight))[0])) if len(np.unique(inverse)) > 20 else 0.0
        level = float((weight * (square - slope * inverse)).sum() / weight.sum())
        fit = language.Floor(float(x[keep].min()), float(x[keep].max()), mean, (max(0.04 ** 2, level), slope))
        fewer = keep & (score >= fit.at(size, language.DEVIATIONS))
        if (fewer == keep).all():
            break
        keep = fewer
    return fit


@pytest.mark.parametrize("n, sizes", [(5000, 300), (5001, 90), (60, 12), (1, 1), (500, 1)])
def test_floor_from_sums_is_the_floor_from_rows(spark, n, sizes):
    rng = np.random.default_rng(n)
    size = np.where(rng.random(n) < 0.5, 300, 300 - rng.integers(0, sizes, n))
    score = np.round(np.clip(0.6 + 0.02 * np.log(size) + rng.normal(0, 1, n) * (0.03 + 1.5 / size), 0, 1), 6)
    score[rng.random(n) < 0.02] = 0.05
    rows = spark.createDataFrame(list(zip(size.tolist(), score.tolist())), "size long, score double")
    got = language.fit_floor(rows.groupBy("size", "score").agg(F.count("*").alias("n")))
    want, at = brute_floor(size, score), np.arange(1, 301)
    assert np.allclose(got.at(at, language.DEVIATIONS), want.at(at, language.DEVIATIONS), atol=1e-9)
    assert (got.low, got.high) == pytest.approx((want.low, want.high))


def test_no_scores_no_floor(spark):
    assert language.fit_floor(spark.createDataFrame([], "size long, score double, n long")).at(np.array([5]), 4.5) == [0.0]


def test_every_training_row_teaches(spark):
    docs = spark.range(MANY).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    learnable = [i for i in range(MANY) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    texts = language.training_texts(docs)
    assert len(learnable) > 2000 and sorted(r.text for r in texts.collect()) == sorted(f"word {i}" for i in learnable)
    profile = language.learn(texts)
    first = profile.codes[np.argmin(profile.ranks[0])]
    assert first in {ord("w"), ord("o"), ord("r"), ord("d")}


def test_a_repeated_row_teaches_once(spark):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    odd = spark.createDataFrame([(0, None, "en"), (None, "x", "en"), (2, "x", None)], "doc_id long, text string, lang string")
    texts = lambda d: sorted(r.text for r in language.training_texts(d).collect())
    assert texts(docs.unionByName(docs).unionByName(docs.filter("doc_id % 2 = 0")).unionByName(odd)) == texts(docs)
