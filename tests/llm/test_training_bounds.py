"""Training samples are bounded by documents, whatever rows an id has; the mixing fit against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peakcast.llm import common, language, mixing, quality, textio

LANGS = {"en": "the cat and the dog went to the house of the king", "de": "der hund und die katze gehen in das haus der stadt"}


def documents(spark, n=60):
    rows = [(i, f"{LANGS[g]} {i} " + " ".join(LANGS[g].split()[i % 7:]), g) for i in range(n) for g in [("en", "de")[i % 2]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def first_by_hash(spark, docs):
    """A learnable document that any bound picks."""
    return language.training_ids(docs, 1).filter("lang = 'en'").head()["doc_id"]


def test_ids_are_counted_once(spark):
    rows = spark.createDataFrame([("g", 1)] * 500 + [("g", i) for i in range(2, 40)], "g string, k long").repartition(7)
    got = [r["k"] for r in common.smallest_by_hash(rows, "g", "k", 20).collect()]
    want = [r["k"] for r in rows.distinct().orderBy(F.xxhash64("k"), "k").limit(20).collect()]
    assert sorted(got) == sorted(want)


def test_a_repeated_document_changes_no_profile_and_no_rate(spark):
    docs = documents(spark)
    one = first_by_hash(spark, docs)
    copies = spark.range(3000).select(F.lit(one).alias("doc_id")).join(docs, "doc_id").select(docs.columns)
    many = docs.unionByName(copies)
    for f in (lambda d: language.identify(d, 8), lambda d: mixing.mix_rates(d, mixing.languages(docs)).select("doc_id", "domain", F.round("p_domain", 9))):
        assert sorted(map(tuple, f(docs).distinct().collect())) == sorted(map(tuple, f(many).distinct().collect()))
    assert language.training_texts(many, 8).count() == 16
    labels = docs.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"))
    assert quality.training_rows(many, labels, 30).count() == quality.training_rows(docs, labels, 30).count() <= 30


def test_an_id_with_many_texts_is_one_training_row(spark):
    docs = documents(spark)
    one = first_by_hash(spark, docs)
    texts = spark.range(500).select(F.lit(one).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    many = docs.unionByName(texts).unionByName(spark.createDataFrame([(one, None, "en")], docs.schema))
    got = language.training_texts(many, 8)
    assert got.count() == 16 and got.filter("text IS NULL").count() == 0


def test_too_many_groups_are_refused(spark):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="more than 5"):
        common.bounded_groups(docs, "lang", 5)


def test_rates_match_brute_force(spark):
    """Posteriors from counted words, then projected gradient steps, in plain numpy."""
    docs = documents(spark, 40)
    weights = {"en": 0.7, "de": 0.3}
    m = mixing.fit(docs, mixing.languages(docs), weights)
    rows = docs.orderBy("doc_id").collect()

    def slots(text):
        t = next(x for _, _, x in textio.chunks(pa.array([text])))
        return [int(h >> np.uint64(64 - mixing.BITS)) for h in textio.words(t, textio.SPACE_TABLE).hashes]

    counts = {g: np.full(1 << mixing.BITS, 0.1) for g in ("de", "en")}
    for r in rows:
        for s in slots(r["text"]):
            counts[r["lang"]][s] += 1
    p, n = [], []
    for r in rows:
        at = slots(r["text"])
        s = np.array([sum(np.log(counts[g][i] / counts[g].sum()) for i in at) / np.sqrt(len(at)) + np.log(0.5) for g in ("de", "en")])
        p.append(np.exp(s - s.max()) / np.exp(s - s.max()).sum())
        n.append(len(at))
    p, n = np.array(p), np.array(n, float)
    size = n @ p
    target, rate, now, steps = np.array([0.3, 0.7]) * n.sum(), np.ones(len(n)), size, 0
    while np.abs(now - target).max() > mixing.TOLERANCE * n.sum() and steps < mixing.STEPS:
        rate, steps = np.maximum(rate - p @ ((now - target) / size), 0), steps + 1
        now = (n * rate) @ p
    got = {r["doc_id"]: r for r in mixing.mix_rates(docs, mixing.languages(docs), weights).collect()}
    assert np.allclose([got[r["doc_id"]]["rate"] for r in rows], rate, atol=1e-9)
    assert np.allclose(m.totals, now, rtol=1e-9) and len(m.steps) == steps and m.residual <= mixing.TOLERANCE * 1.01
    assert {(r["fit_steps"], round(r["fit_residual"], 12)) for r in got.values()} == {(steps, round(m.residual, 12))}
