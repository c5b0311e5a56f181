"""Near duplicates, nearest neighbours and chat formatting: brute force on small fixtures, and edge cases."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakcast.llm import ann, chat, near_dup

from ..conftest import SF0001
from .test_text_operators import docs_of, vocabulary


# ---- 7: near duplicates --------------------------------------------------------------------

def brute_components(rows, percent):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                comp[q] = p
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near_rows(seed=4):
    rng = random.Random(seed)
    v = vocabulary(200, rng)
    rows = [(0, None), (1, ""), (2, " \t"), (3, "one two"), (4, "One TWO"), (5, "one  two three"), (6, "one")]
    base = [rng.choice(v) for _ in range(120)]
    for d in range(10, 70):  # one large group of near copies of a text, at about the threshold from each other
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(v)
        rows.append((d, " ".join(w)))
    chain = [rng.choice(v) for _ in range(100)]  # each like the one before, ends unlike each other
    for d in range(100, 140):
        chain[(d * 5) % 100] = f"w{d}"
        rows.append((d, " ".join(chain)))
    rows += [(d, " ".join(base)) for d in range(200, 260)]
    for d in range(300, 340):  # a common passage in otherwise different texts
        rows.append((d, " ".join(base[:60] + [rng.choice(v) for _ in range(rng.randint(5, 60))])))
    rows.append((400, " ".join(rng.choice(v) for _ in range(30_000))))
    rows.append((401, rows[-1][1] + " more"))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    rows = near_rows()
    random.Random(1).shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs_of(spark, rows).repartition(3), percent).collect()}
    assert got == brute_components(rows, percent)


def test_near_duplicates_edges(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, None), (8, "A b c d e f"), (9, None)]
    got = sorted((tuple(r) for r in near_dup.near_duplicates(docs_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(7, 2, 7, True), (8, 2, 7, False), (9, 0, 9, True), (None, 2, None, True), (None, 0, None, True)], key=repr)
    left = near_dup.deduplicate(docs_of(spark, rows))
    assert left.columns == docs_of(spark, rows).columns and sorted(str(r.doc_id) for r in left.collect()) == ["7", "7", "9", "None", "None"]
    assert near_dup.near_duplicates(docs_of(spark, [])).count() == 0


def test_near_duplicates_prefer_a_text_to_none(spark):
    rows = [(7, None), (7, "a b c d e f g"), (7, ""), (8, "a b c d e f g")]
    got = sorted(tuple(r) for r in near_dup.near_duplicates(docs_of(spark, rows)).collect())
    assert got == [(7, 3, 7, True), (8, 3, 7, False)]


def test_near_duplicates_link_all_texts_of_an_id(spark):
    """An id with several texts is linked with what any of them is linked with, and joins their components."""
    rng = random.Random(9)
    v = vocabulary(300, rng)
    texts = [" ".join(rng.choice(v) for _ in range(60)) for _ in range(6)]
    rows = [(20, texts[0]), (20, texts[1]), (20, texts[2] + " z"), (20, None), (5, texts[0]), (31, texts[1] + " more"), (9, texts[2]),
            (40, texts[3]), (41, texts[3]), (50, texts[4]), (50, texts[5]), (60, texts[5]), (61, "")]
    rows += [(70, f"only here {i} a b c") for i in range(40)]  # many texts that nothing else has
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dup.near_duplicates(docs_of(spark, rows).repartition(3)).collect()}
    assert got == {20: (5, False), 5: (5, True), 31: (5, False), 9: (5, False), 40: (40, True), 41: (40, False), 50: (50, True), 60: (50, False),
                   61: (61, True), 70: (70, True)}
    left = near_dup.deduplicate(docs_of(spark, rows))
    assert sorted(r.doc_id for r in left.collect()) == [5, 40, 50, 50, 61] + [70] * 40


def test_bands_miss_at_most_as_stated():
    for percent in (80, 85):
        assert (1 - (percent / 100) ** near_dup.ROWS) ** near_dup.n_bands(percent) <= near_dup.MISS


def test_min_max_values_agree_with_the_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = x[:3600], x[400:]
    k = 300
    agree = [(f((a * p + q)) == f((b * p + q))) for p, q in zip(*near_dup._permutations(k)) for f in (np.min, np.max)]
    assert abs(np.mean(agree) - 0.8) < 0.06


# ---- 4: nearest neighbours -----------------------------------------------------------------

def brute_nearest(rows, k=5):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q % 50:
            continue
        best = out.setdefault(q, {})
        for i, y in ok:
            if i != q:
                best[i] = max(best.get(i, -2), float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))))
    return {q: sorted(b.items(), key=lambda e: (-round(e[1], 12), e[0]))[:k] for q, b in out.items()}


def run_ann(spark, rows):
    e = spark.createDataFrame([(i, v, 1, 0.0) for i, v in rows], "vec_id long, embedding array<float>, list int, score double")
    out = {}
    for r in ann.nearest(e, lambda c: c % 50 == 0).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_on_the_fixture_reaches_the_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF0001.replace('0.001', '0.01')}/embeddings.parquet").collect()]
    got, want = run_ann(spark, rows), brute_nearest(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(v) for q, v in brute_nearest(rows, len(rows)).items()}
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q in got for i, s in got[q])


def test_nearest_edges(spark):
    rng = np.random.default_rng(1)
    f = lambda *v: [float(np.float32(x)) for x in v]
    hot = f(1, 0, 0)
    rows = [(i, hot) for i in range(0, 400)] + [(i, f(*rng.normal(size=3))) for i in range(400, 460)]
    rows += [(500, None), (550, []), (600, f(0, 0, 0)), (650, [1.0, None, 2.0]), (700, [float("nan"), 1.0, 1.0]), (750, [float("inf"), 1.0, 1.0]),
             (None, hot), (800, f(1, 2)), (0, hot), (100, f(0, 1, 0)), (850, f(2, 0, 0))]
    got = run_ann(spark, rows)
    # Ids without a valid vector ask nothing; ties go to the smaller id; the hot vector's copies are found in order.
    assert set(got) == {0, 50, 100, 150, 200, 250, 300, 350, 400, 450, 850}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert all(s == pytest.approx(1.0) for _, s in got[50]) and len(got[100]) == 5
    assert run_ann(spark, []) == {}
    assert run_ann(spark, [(50, hot)]) == {}
    assert run_ann(spark, [(50, hot), (1, f(0, 1, 0)), (2, f(1, 1, 0))])[50] == [(2, pytest.approx(math.sqrt(0.5))), (1, pytest.approx(0.0))]


def test_nearest_with_an_id_on_many_vectors(spark):
    """An id on more than k near vectors takes one place: of a block, and of the lists that a query visits."""
    rng = np.random.default_rng(4)
    f = lambda *v: [float(np.float32(x)) for x in v]
    rows = [(50, f(1, 0, 0))] + [(7, f(1, 0.001 * j, 0)) for j in range(1, 9)] + [(i, f(1, 0.1 * i, 0.1)) for i in range(1, 7)]
    assert [i for i, _ in run_ann(spark, rows)[50]] == [7, 1, 2, 3, 4] == [i for i, _ in brute_nearest(rows)[50]]
    rows = [(50, f(1, 0, 0))] + [(7, f(1, *x)) for x in rng.normal(scale=0.05, size=(3000, 2))] + [(i, f(-1, *rng.normal(size=2))) for i in range(101, 140)]
    got, want = run_ann(spark, rows), brute_nearest(rows)
    assert len(got[50]) == 5 and got[50][0] == (7, pytest.approx(want[50][0][1]))


def test_nearest_with_very_large_and_very_small_components(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(30, 4))
    x *= np.where(np.arange(30) % 3 == 0, 1e200, np.where(np.arange(30) % 3 == 1, 1e-200, 1.0))[:, None]
    x[29] = 5e-324
    e = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = [r for r in ann.nearest(e, lambda c: c == 0).orderBy("rank").collect()]
    u = [[math.ldexp(c, -math.frexp(max(map(abs, v)))[1]) for c in v.tolist()] for v in x]
    u = [np.array(v) / np.linalg.norm(v) for v in u]
    want = sorted(((float(u[0] @ u[i]), i) for i in range(1, 30)), key=lambda e: (-e[0], e[1]))[:5]
    assert [r.vec_id for r in got] == [i for _, i in want]
    assert all(r.score == pytest.approx(s, abs=1e-12) for r, (s, _) in zip(got, want))


def test_graph_search_finds_what_a_scan_finds():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16))
    index = ann.build_index(x, 64)
    u = ann._units(x[:500]).astype(np.float32)
    r, c, _ = index.near(u, 1.2)
    d = np.sqrt(np.maximum(2 - 2 * u @ index.centroids.T, 0))
    want = d <= d.min(axis=1, keepdims=True) * 1.2
    got = np.zeros_like(want)
    got[r, c] = True
    assert (got & want).sum() >= 0.98 * want.sum()


# ---- 10: chat ------------------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\<|/[]>sSYINTturnedm_ \n"), st.lists(st.one_of(st.sampled_from(chat.CONTROL), st.sampled_from(["\\", "\n", "x", "<", "<\\", "|"]))).map("".join))
def test_format_round_trip(role, text):
    for r, t in ((role, text), (text, role)):
        out, lo, hi = chat.render(r, t)
        assert chat.parse(out) == (r, t) and (lo == hi or r == "assistant")
        inner = out[len(chat.TURN):-len(chat.END) - 1]
        assert not any(c in inner for c in chat.CONTROL)
    out, lo, hi = chat.render("assistant", text)
    assert chat.unescape(out[lo:hi]) == text


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(1, 0, 0, 2, "delta", "user", "lo"), (1, 0, 0, 1, "delta", "user", "hel"), (1, 1, 0, 5, "delta", "assistant", "bad"),
           (1, 1, 0, 6, "regenerate", None, None), (1, 1, 0, 7, "delta", None, "good"), (1, 0, 0, 9, "edit", None, "hello!"),
           (2, 0, 0, 1, "regenerate", "user", None), (2, 1, 0, 1, "delta", None, None), (None, 0, 0, 1, "delta", "user", "null id")]
    e = spark.createDataFrame(log, chat.EVENTS).withColumn("messages", F.lit("x")).repartition(4)
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.reconstruct(e).collect()}
    assert got == {(1, 0): ("user", "hello!"), (1, 1): ("assistant", "good"), (2, 0): ("user", ""), (2, 1): ("", ""), (None, 0): ("user", "null id")}
    assert chat.reconstruct(e.limit(0)).count() == 0
    with pytest.raises(Exception, match="unknown event kind"):
        chat.reconstruct(spark.createDataFrame([(1, 0, 0, 1, "nope", "u", "x")], chat.EVENTS)).collect()


def test_digests_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "assistant", "a\\<|end|>"), (2, None, "assistant", "null turn"), (2, 0, None, "no role"),
            (2, 0, "user", "tie"), (2, 0, "user", "tie"), (None, 0, "assistant", "x"), (3, 0, "a\nb\\", "text\n"), (4, 0, "assistant", "é" * 50_000)]
    rows += [(5, t, "assistant" if t % 2 else "user", f"t{t}" * rng.randint(0, 20)) for t in range(400)]
    c = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, formatted string, copy int").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in chat.formatted_digests(c).collect()}
    rows += chat.ADDED
    for conv in {r[0] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        turns = "".join(f"{role}\n{text}\n" for *_, role, text in mine)
        loss = "".join(text for *_, role, text in mine if role == "assistant")
        assert got[conv][:4] == (len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv][4] == sum(len(chat.render(role, text)[0]) for *_, role, text in mine)
    assert set(got) == {r[0] for r in rows}
    assert [r.conv_id for r in chat.formatted_digests(c.limit(0)).collect()] == [-7]
