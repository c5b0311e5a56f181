"""Quality, language and mixing: held-out accuracy and exact fits; the pipeline's stages against brute force."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from peakcast.llm import common, language, mixing, quality, textio

from ..conftest import SF001
from .test_pairs_and_chat import brute_components
from .test_text_operators import brute_contaminated, docs_of


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


# ---- 6: quality ----------------------------------------------------------------------------

def test_quality_on_the_held_out_fold(spark, docs):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [d for d in truth if rows[d].held_out]
    right = sum(rows[d].predicted == truth[d] for d in held)
    assert right >= 0.93 * len(held)
    assert all(rows[d].predicted for d in held if truth[d] == 1)


def test_quality_does_not_learn_from_the_held_out_fold(spark, docs):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    lied = labels.withColumn("quality", F.when(common.fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.quality(docs, x).collect()} for x in (labels, lied))
    assert a == b


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (None, 0, 0), (4, None, 1), (5, 7, 1), (1, 1, 1), (6, 0, 1)], "doc_id long, quality int, score int")
    rows = [(1, "fine text here"), (2, "*** ### ***"), (3, "more fine text"), (6, "### !!! ***"), (7, None), (8, ""), (None, "fine"), (1, "fine text here"), (9, "w " * 100_000)]
    got = [tuple(r) for r in quality.quality(docs_of(spark, rows), labels).collect()]
    assert len(got) == len(rows) and all(0 <= r[2] <= 1 for r in got) and got.count(got[0]) == 2
    assert quality.quality(docs_of(spark, []), labels).count() == 0
    flat = {r.score for r in quality.quality(docs_of(spark, rows), labels.limit(0)).collect()}
    assert flat == {0.5}
    assert quality.accept(docs_of(spark, rows), labels).columns == docs_of(spark, rows).columns


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against a fine search over the primal objective on two inputs."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 2))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=40) > 0, 1.0, -1.0)
    c = np.full(40, 0.7)
    w = quality.dual_coordinate_descent([np.array([0, 1])] * 40, list(x), y, 2, c, epochs=3000)
    objective = lambda u: u @ u / 2 + (c * np.maximum(0, 1 - y * (x @ u[:2] + u[2]))).sum()
    best = min(objective(w + d) for d in rng.normal(scale=0.02, size=(3000, 3)))
    assert objective(w) <= best + 1e-3


# ---- 8: language ---------------------------------------------------------------------------

def test_language_on_the_held_out_fold(docs):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def brute_ranked(text):
    b = bytearray(32 for _ in range(1))
    raw = text.encode()
    for i, x in enumerate(raw):
        if 65 <= x <= 90:
            x += 32
        elif 0x80 <= x <= 0x9E and x != 0x97 and i and raw[i - 1] == 0xC3:
            x += 32
        elif not (97 <= x <= 122 or x >= 128):
            x = 32
        if x != 32 or b[-1] != 32:
            b.append(x)
    if b[-1] != 32:
        b.append(32)
    count = {}
    for k in (1, 2, 3):
        for i in range(len(b) - k + 1):
            g = bytes(b[i:i + k])
            if g != b" ":
                code = int.from_bytes(g, "big") + ((k - 1) << 24)
                count[code] = count.get(code, 0) + 1
    return sorted(count, key=lambda c: (-count[c], c))[:language.TOP] if len(b) > 2 else []


def test_ranked_lists_match_brute_force(docs):
    texts = ["", None, "a", "...", "É à  Ça!", "×÷ß", *(r.text for r in docs.limit(60).collect())]
    got = [codes.tolist() for _, _, t in textio.chunks(pa.array(texts, pa.string())) for codes, _ in language.ranked(t)]
    assert got == [brute_ranked(t or "") for t in texts]


def test_language_edges(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(i, "le chat et le chien", "fr") for i in range(20, 40)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 ...", "fr"), (53, "привет", None), (None, "the dog", "en"), (0, "the cat and the dog", "en"), (54, "the dog " * 50_000, None)]
    d = spark.createDataFrame([(*r, 0.0, "x") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    got = {r.doc_id: r for r in language.identify(d).collect()}
    assert language.identify(d).count() == len(rows)
    assert [got[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and got[52].score == 0
    assert got[53].lang_pred in ("en", "fr") and got[54].lang_pred == "en" and got[30].lang_pred == "fr"
    assert language.identify(d.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language.accept(d)
    assert kept.columns == d.columns and not {50, 51, 52} & {r.doc_id for r in kept.collect()}


FOREIGN = [
    "Aurinko oli juuri laskenut kukkuloiden taakse kun vanha kalastaja palasi satamaan veneensä kanssa eikä kukaan odottanut häntä rannalla koska kaikki olivat jo menneet syömään illallista koteihinsa",
    "Słońce właśnie zaszło za wzgórza kiedy stary rybak wrócił do portu ze swoją łodzią pełną pustych sieci i nikt nie czekał na niego na brzegu bo wszyscy poszli już na kolację do swoich domów"]


def test_language_stage_rejects_texts_of_no_learned_language(spark, docs):
    """Random letters (those of 15 and 20 words are under 200 bytes; some are among the training documents) and foreign
    texts go, at any length; every document that is labelled clean stays."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(map(chr, rng.integers(97, 123, rng.integers(3, 9))))
    planted = [(" ".join(word() for _ in range(n)), "en" if i == 0 else None) for n in (15, 20, 40, 100, 1000) for i in range(4)]
    planted += [(t, None) for t in FOREIGN] + [(" ".join(t.split()[:22]), None) for t in FOREIGN] + [("привет мир как дела сегодня вечером", None)]
    rows = spark.createDataFrame([(10_000_000 + i, t, lang) for i, (t, lang) in enumerate(planted)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language.accept(docs.select("doc_id", "text", "lang").unionByName(rows)).collect()}
    assert [planted[i][0][:60] for i in range(len(planted)) if 10_000_000 + i in kept] == []
    clean = {r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").filter("quality = 1").collect()}
    assert clean <= kept


# ---- 3: mixing -----------------------------------------------------------------------------

def test_rates_meet_the_targets(docs):
    weights = {"en": 0.25, "fr": 0.25, "de": 0.25, "es": 0.25}
    m = mixing.fit(docs, mixing.languages(docs), weights)
    rows = docs.select(mixing._member(docs, m.model)(F.col("text")).alias("m")).select("m.n", "m.p").collect()
    n, p = np.array([r.n for r in rows], float), np.array([r.p for r in rows])
    r = mixing.rates(p, m.steps)
    assert (r >= 0).all() and p.sum(axis=1) == pytest.approx(1)
    assert (n * r) @ p == pytest.approx(m.totals, rel=1e-9)
    assert m.totals == pytest.approx(m.targets, rel=1e-3) and m.targets.sum() == pytest.approx(n.sum())
    got = mixing.mix_rates(docs, mixing.languages(docs), weights).collect()
    assert sorted(x.rate for x in got) == pytest.approx(sorted(r)) and all(int(x.rate) <= x.copies <= int(x.rate) + 1 for x in got)


def test_infeasible_targets_give_the_least_squares_fit():
    """Soft members cannot leave one domain empty: rates reach 0 where that helps, and no small change does better."""
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.5, 0.5, 0.5], 60)
    n = rng.integers(1, 50, 60).astype(float)
    size = n @ p
    target = np.array([0.9, 0.1, 0.0]) * n.sum()
    r = np.ones(60)
    for _ in range(3000):
        r = np.maximum(r - p @ (((n * r) @ p - target) / size), 0)
    objective = lambda r: ((((n * r) @ p - target) ** 2) / size).sum()
    assert (r == 0).any()
    for _ in range(2000):
        other = np.maximum(r + rng.normal(scale=0.01, size=60), 0)
        assert objective(r) <= objective(other) + 1e-6 * n.sum()


def test_mixing_edges(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(6)] + [(i, "le chat et le chien", "fr") for i in range(6, 8)]
    rows += [(20, None, "en"), (21, "", None), (None, "the dog", "en"), (0, "the cat and the dog", "en"), (22, "chien " * 50_000, None)]
    d = spark.createDataFrame([(*r, 0.0, "x") for r in rows], "doc_id long, text string, lang string, rate double, m string")
    got = mixing.mix_rates(d, mixing.languages(d)).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 and r.copies >= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (20, 21)} == {0}
    assert mixing.mix_rates(d.limit(0), mixing.languages(d)).count() == 0
    none = mixing.mix_rates(d, mixing.languages(d).limit(0), budget=2.0).collect()
    assert {(r.domain, r.rate, r.copies) for r in none} == {(None, 2.0, 2)}
    assert mixing.mixed(d, mixing.languages(d)).columns == [*d.columns, "mix_rate", "mix_copy"]


# ---- pipeline ------------------------------------------------------------------------------

def test_stages_match_brute_force(spark, docs):
    """Each stage on what its predecessor kept: classifiers against their own scores, the rest against brute force."""
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_stage", "language_stage", "near_duplicate_stage", "decontamination_stage", "mixing_stage"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, now, SF001), "test-stage")
        before, after = {r.doc_id: r.text for r in now.collect()}, [r.doc_id for r in out.collect()]
        if name != "mixing":
            assert out.columns == docs.columns and len(set(after)) == len(after)
        if name == "quality":
            want = {r.doc_id for r in quality.quality(now, common.table(spark, SF001, "labels")).collect() if r.predicted}
            clean = {r.doc_id for r in common.table(spark, SF001, "labels").filter("quality = 1").collect()}
            assert set(after) == want and clean <= want
        elif name == "language":
            assert set(after) == {d for d, t in before.items() if t and any(c.isalpha() for c in t)}
        elif name == "near_duplicates":
            assert set(after) == {d for d, (_, _, kept) in brute_components(before.items(), 80).items() if kept}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in common.table(spark, SF001, "benchmark").collect()]
            got = {r.doc_id for r in now.join(out.select("doc_id"), "doc_id", "left_anti").collect()}
            sample = [(d, t) for d, t in before.items() if d in got or d % 40 == 0]
            sample = [(d, t) for d, t in sample if len(t) < 3000]
            assert {d for d, _ in sample if d in got} == {d for d, _ in brute_contaminated(sample, items)}
            assert 0 < len(before) - len(after) < 0.1 * len(before)
        else:
            rates = {r.doc_id: r.copies for r in mixing.mix_rates(now, mixing.languages(now)).collect()}
            assert {d: after.count(d) for d in set(after)} == {d: c for d, c in rates.items() if c}
        now = out


def test_pipeline_on_an_empty_table(spark, docs):
    now = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF001)
    assert now.count() == 0


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11))
