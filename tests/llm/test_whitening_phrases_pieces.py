"""Whitening, collocations and SentencePiece encoding: brute force and the library on small fixtures, and edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from peakcast.llm import collocations, pieces, textio, whitening

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---- 11: whitening -------------------------------------------------------------------------

def matrices():
    rng = np.random.default_rng(3)
    for m in (1, 2, 3, 9, 64):
        yield np.triu(rng.standard_normal((m, m)))
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield np.eye(12)
    yield np.diag(np.r_[[5.0] * 4, [3.0] * 4, np.ones(32)]) @ q  # equal values
    yield np.diag(np.r_[5, 5 - 1e-9, 5 - 2e-9, 5 - 1e-5, [3.0] * 4, np.ones(32)]) @ q  # nearly equal ones
    yield np.triu(rng.standard_normal((40, 40))) * np.logspace(0, -12, 40)
    yield np.linalg.qr(rng.standard_normal((3, 20)).T @ rng.standard_normal((3, 20)), mode="r")  # rank 3
    a = rng.standard_normal((30, 30))
    a[:, 5], a[:, 9] = 0, a[:, 8]
    yield np.linalg.qr(a, mode="r")


@pytest.mark.parametrize("a", list(matrices()))
def test_principal_vectors_match_the_svd(a):
    values, kept, v = whitening.principal(a, 8)
    s = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(values, s, rtol=0, atol=1e-13 * s[0])
    assert len(kept) == min(8, int((s > 1e-26 * s[0]).sum()))
    assert np.abs(v.T @ v - np.eye(len(kept))).max() < 1e-12
    assert np.abs(a.T @ (a @ v) - v * kept).max() < 1e-13 * s[0]


def test_dqds_keeps_small_values_accurate():
    b, f = np.logspace(0, -60, 30), np.logspace(-1, -55, 29)  # graded: the product of all values is exactly known
    values = whitening.dqds(b, f)
    assert math.isclose(np.log(values).sum(), 2 * np.log(b).sum(), rel_tol=1e-13)
    assert np.all(whitening.dqds(np.array([3.0, 0.0, 2.0]), np.array([0.0, 0.0])) == [9, 4, 0])


def test_bidiagonal_form():
    a = np.random.default_rng(1).standard_normal((17, 17))
    b, f, v = whitening.bidiagonalise(a)
    m = np.diag(b) + np.diag(f, 1)
    assert np.allclose(v @ m.T @ m @ v.T, a.T @ a, atol=1e-12) and np.allclose(v.T @ v, np.eye(17), atol=1e-13)


def vectors(spark, rows):
    """Embeddings with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, v, 1, 2, 3.0, "r") for i, v in rows],
                                 "vec_id long, embedding array<double>, component int, n long, whitened double, x string")


def brute_whitened(rows, count=8):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept])
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    w, u = np.linalg.eigh(c.T @ c / n)
    w, u = w[::-1][:count], u[:, ::-1][:, :count]
    return n, [i for i, _ in kept], ((n * x - s) ** 2).sum(axis=1), c @ u / np.sqrt(w), w / np.trace(c.T @ c / n)


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 12)) * np.linspace(3, 1, 12) + 7)]
    rows += [rows[0], rows[0], (None, rows[1][1])]  # repeated rows, a null id
    bad = [(500, None), (501, []), (502, [1.0] * 11 + [None]), (503, [1.0] * 11 + [float("nan")]), (504, [float("inf")] + [1.0] * 11), (505, [1.0, 2.0])]
    out = whitening.whiten(vectors(spark, rows + bad).repartition(5)).toPandas()
    n, ids, far, white, explained = brute_whitened(rows)
    assert len(out) == 8 * n and set(out["n"]) == {n} and out["identity_error"].max() < 1e-10
    assert np.allclose(out.groupby("component")["explained"].first(), explained, rtol=1e-10)
    key = lambda i, d, w: (-1 if i is None or i != i else int(i), int(d), *np.round(np.abs(w), 7))
    got = [key(g["vec_id"].iloc[0], g["deviation"].iloc[0], r) for _, g in out.groupby([out["vec_id"].fillna(-1), "deviation"])
           for r in g.sort_values(["component", "whitened"])["whitened"].to_numpy().reshape(8, -1).T]
    assert Counter(got) == Counter(key(i, d, w) for i, d, w in zip(ids, far, white))
    signs = {c: set(np.sign(w[:, c - 1] * out[out["component"] == c].set_index("deviation").loc[far[:50], "whitened"].groupby(level=0).first().reindex(far[:50]).to_numpy()))
             for c in range(1, 9) for w in [white[:50]]}
    assert all(len(x - {0.0}) == 1 for x in signs.values())  # one sign for all rows


def test_whitening_edges(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).count() == 0  # no variance
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 5.0, -float(i)]) for i in range(9)])).toPandas()
    assert set(flat["component"]) == {1} and np.allclose(flat["explained"], 1)  # constant and dependent dimensions
    far = whitening.whiten(vectors(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 4.0])])).toPandas()
    assert far[far["vec_id"] == 1]["deviation"].isna().all() and np.isfinite(far["whitened"]).all()
    m = whitening.Moments(3, [10, -7])
    x = np.array([[1 << 38, 5], [4, 2]])
    assert m.deviations(x)[0] is None and m.deviations(x)[1] == (12 - 10) ** 2 + (6 + 7) ** 2


# ---- 12: collocations ----------------------------------------------------------------------

def brute_collocations(rows, least, inside, top, longest=3):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                f.update((lang, *w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang in total:
        cand = {k[1:]: a for k, a in f.items() if k[0] == lang and len(k) > 2 and a >= least}
        rows = []
        for w, a in cand.items():
            inner = lambda x: any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1))
            if any(len(x) > len(w) and inner(x) and 100 * b >= inside * a for x, b in cand.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, total[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    v = ["".join(rng.choice("abÉé\x00") for _ in range(rng.randint(1, 4))) for _ in range(25)] + ["the", "The", "of"]
    gap = lambda: rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", " ; ", " "])
    rows = [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(v[-3:] if rng.random() < 0.3 else v) + gap() for _ in range(rng.randint(0, 60)))) for _ in range(n)]
    return rows + [(None, None), ("en", ""), ("xx", " . "), ("en", "the the the the the the the the the the the the the")] + [rows[0]] * 4


def found(spark, rows, **how):
    docs = spark.createDataFrame([(i // 2 if i % 7 else None, t, g, 1, "p", 2) for i, (g, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n int, phrase string, fp int")
    out = collocations.collocations(docs.repartition(4), **how)
    return sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("bits", [64, 12, 4])
def test_collocations_match_brute_force(spark, bits):
    rows = corpus(bits)
    how = {"least": 6, "inside_percent": 50, "top": 30}
    assert found(spark, rows, fp_bits=bits, **how) == sorted(brute_collocations(rows, 6, 50, 30))


def test_collocations_of_longer_phrases(spark):
    rows = corpus(7, 200)
    assert found(spark, rows, least=4, longest=4, top=50) == sorted(brute_collocations(rows, 4, 50, 50, 4))


def test_collocations_edges(spark):
    assert found(spark, []) == [] and found(spark, [("en", None), ("en", "a b. c")]) == []
    ten = [("en", "x y. " * 10)]
    assert found(spark, ten) == [("en", 1, "x y", 10, 10, 10, 20, 1000000)] and found(spark, [("en", "x y. " * 9)]) == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice(["ab", "c", " ", ". ", "dé", "\n"]) for _ in range(4000)) + "x" * 900
    whole = Counter()
    for size in (1 << 20, 100):
        monkeypatch.setattr(collocations, "CHUNK", size)
        n = Counter()
        for _, _, t in collocations.segments(pa.array([text])):
            g = collocations.grams(t, np.zeros(1, np.uint64), (1, 2))
            n.update(g.phrase(i, k) for k in (1, 2) for i in np.flatnonzero(g.inside[k]).tolist())
        whole = whole or n
        assert n == whole and whole["x" * 900] <= 1


# ---- 13: SentencePiece ---------------------------------------------------------------------

TEXTS = ["", " ", "  two  blanks ", "plain words", "a\x00b\t\n\r", "▁ mark ▁▁x", "<s> </s> <unk> <0x41>", "é é ﬁ Ａ １ ｶﾞ ¨   x",
         "日本語テキスト", "🙂👍🏽 emoji", "​﻿ zero", "ＡＢＣ　全角", "a" * 3000, "tail   ", "क़ ẛ̣ ﬃ"]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normaliser_and_alignment_match_the_library(rule):
    """The compiled maps of the library's own rules: normalised text, and the place of every character."""
    from sentencepiece import sentencepiece_model_pb2
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = sentencepiece_model_pb2.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec
    mine = pieces.Normaliser(spec)
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("aé ﬁ́ｶﾞ１ 　日▁") for _ in range(rng.randint(0, 20))) for _ in range(200)]
    for text in texts:
        want, place = lib.normalize(text, with_offsets=True)
        got, origin = mine(text.encode())
        got = bytes(got).decode()
        assert got == want
        starts = np.cumsum([0] + [len(c.encode()) for c in got])
        to_char = {b: i for i, b in enumerate(np.cumsum([0] + [len(c.encode()) for c in text]).tolist())}
        assert [to_char[int(origin[b])] for b in starts] == list(place)


def test_spans_match_the_library():
    enc = pieces.Encoder(MODEL)
    assert enc.by_word
    for by_word, text in itertools.product([True, False], TEXTS):
        enc.by_word = by_word
        ids, start, end, n = next((enc.batch(t) for _, _, t in textio.chunks(pa.array([text]))))
        want = enc.lib.encode(text, return_type="proto")
        raw = text.encode()
        assert ids.tolist() == [p.id for p in want.pieces] and n.tolist() == [len(ids)]
        assert [raw[s:e].decode() for s, e in zip(start, end)] == [p.surface for p in want.pieces]
        assert (end - start).sum() == len(raw)
        start, end = enc.spans(raw, ids)
        assert [raw[s:e].decode() for s, e in zip(start, end)] == [p.surface for p in want.pieces]
    whole = enc.batch(next(t for _, _, t in textio.chunks(pa.array(TEXTS))))
    each = [enc.batch(next(t for _, _, t in textio.chunks(pa.array([x])))) for x in TEXTS]
    assert all(np.array_equal(whole[k], np.concatenate([e[k] for e in each])) for k in range(4))


def test_round_trip_matches_the_library(spark):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[3]), (0, TEXTS[3]), (None, "null id"), (99, None), (100, "very long " * 200_000)]
    docs = spark.createDataFrame([(i, t, 1, [2], "d") for i, t in rows], "doc_id long, text string, n_bytes int, ids array<int>, decoded string")
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t in rows:
        ids = lib.encode(t or "")
        want[i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)), len((t or "").encode())] += 1
    out = pieces.round_trip(docs.repartition(3), MODEL).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["n_bytes"]) for r in out) == want
    assert all(r["covered_bytes"] == r["n_bytes"] for r in out)
    assert pieces.round_trip(docs.limit(0), MODEL).count() == 0
    e = pieces.encode(docs.filter("doc_id = 99"), MODEL).withColumn("back", pieces.decode(F.col("ids"), MODEL)).collect()[0]
    assert (e["ids"], e["starts"], e["ends"], e["back"], e["n_bytes"]) == ([], [], [], "", 0)
