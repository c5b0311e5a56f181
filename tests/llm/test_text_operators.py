"""Decontamination, LM scores, license scan, token counts: brute force on small fixtures, and edge cases."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakcast.llm import decontaminate, licenses, lm_score, textio, token_counts

DOCS = "doc_id long, text string, seed string, words string, pos int, n_words int, score double"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "s", "w", 1, 2, 0.5) for i, t in rows], DOCS)


def vocabulary(n, rng):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(n)]


# ---- words ---------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB\t \n\x00éÉ.0\x1f", max_size=30)), max_size=12), st.integers(1, 40))
def test_words_match_the_pattern(texts, size):
    for table, pattern in ((textio.SPACE_TABLE, r"[^\x20\x09-\x0D]+"), (textio.WORD_TABLE, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        seen = {}
        for lo, hi, t in textio.chunks(pa.array(texts, pa.string()), size):
            w = textio.words(t, table)
            for d in range(hi - lo):
                want = re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), texts[lo + d] or ""))
                got = [(w.begin[j], w.end[j]) for j in range(w.first[d], w.first[d + 1])]
                assert len(got) == len(want)
                for word, h in zip(want, w.hashes[w.first[d]:w.first[d + 1]]):
                    assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


# ---- 1: decontamination --------------------------------------------------------------------

def test_masks_miss_no_placement_of_substitutions():
    w, m = decontaminate.WINDOW, decontaminate.SUBSTITUTIONS
    for changed in itertools.combinations(range(w), m):
        assert any(not {o + x for x in mask} & set(changed) for mask in decontaminate.MASKS for o in range(w - mask[-1]))


def brute_contaminated(docs, items):
    out = {}
    cut = lambda t: [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if x]
    for (d, t), (i, b) in itertools.product(set(docs), set(items)):
        x, y = cut(t), cut(b)
        if not y or (len(y) < 5 and len(x) != len(y)):
            continue
        n = min(decontaminate.WINDOW, len(y))
        need = n - (2 if len(y) >= 13 else 1 if len(y) >= 8 else 0)
        for p in range(len(x) - n + 1):
            for q in range(len(y) - n + 1):
                m = sum(a == c for a, c in zip(x[p:p + n], y[q:q + n]))
                if m >= need:
                    k = out.setdefault((d, i), [0, 0, p, 0])
                    k[0] += 1
                    k[1], k[2], k[3] = max(k[1], m), min(k[2], p), max(k[3], p + n - 1)
    return {k: tuple(v) for k, v in out.items()}


def test_contaminated_matches_brute_force(spark):
    rng = random.Random(5)
    v = vocabulary(30, rng)
    items = [(i, " ".join(rng.choice(v) for _ in range(n))) for i, n in enumerate([13, 14, 20, 60, 100, 12, 5, 4, 1])] + [(20, None), (21, ""), (0, " ".join(v[:13]))]
    items.append(items[2])
    docs = [(0, None), (1, ""), (2, "short"), (None, items[2][1])]
    for d in range(3, 60):
        words = [rng.choice(v) for _ in range(rng.randint(0, 60))]
        leak = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randint(0, 3)):
            if leak:
                leak[rng.randrange(len(leak))] = "zzz"
        docs.append((d, " ".join(words[:9]) + ", " + " ".join(leak).upper() + ". " + " ".join(words[9:])))
    docs += [docs[5], (6, " ".join(rng.choice(v) for _ in range(5000)) + " " + items[3][1])]
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, uid string, pos int")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.best_matches, r.first_word, r.last_word)
           for r in decontaminate.contaminated(docs_of(spark, docs), bench).collect()}
    assert got == brute_contaminated(docs, items) and len(got) > 20
    kept = {r.doc_id for r in decontaminate.decontaminate(docs_of(spark, docs), bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.decontaminate(docs_of(spark, docs), bench).columns == docs_of(spark, docs).columns


def test_masks_of_short_items_miss_no_replaced_word():
    for n in range(1, decontaminate.WINDOW):
        masks = decontaminate.short_masks(n)
        assert all(any(i not in m for m in masks) for i in range(n)) == (n >= decontaminate.LOOSE)
        assert all(len(m) >= min(n, 5) for m in masks)


@pytest.mark.parametrize("broadcast", [True, False])
def test_short_items_match_brute_force(spark, monkeypatch, broadcast):
    """Items of every length below the window, with no, one and two replaced words, inside texts and as whole texts."""
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    rng = random.Random(8)
    v = vocabulary(25, rng)
    items = [(n, " ".join(rng.choice(v) for _ in range(n))) for n in range(1, 16)]
    docs = [(0, None), (1, " "), (None, items[2][1])]
    for n, t in items:
        for changed in range(3):
            for place in range(3):
                words = t.split()
                for i in rng.sample(range(n), min(n, changed)):
                    words[i] = "zzz"
                around = [[rng.choice(v) for _ in range(rng.randint(1, 50))] if place == 2 else [] for _ in range(2)]
                docs.append((1000 + 10 * len(docs), " ".join([*around[0], *words, *around[1]] + (["end"] if place == 1 else []))))
    docs += [docs[7], (3, "clash " + items[9][1]), (3, items[12][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, text_id string")
    found = decontaminate.contaminated(docs_of(spark, docs), bench)
    got = {(r.doc_id, r.item_id): (r.n_windows, r.best_matches, r.first_word, r.last_word) for r in found.collect()}
    assert got == brute_contaminated(docs, items)
    assert {i for _, i in got} == set(range(1, 16)) and {m - i for (_, i), (_, m, _, _) in got.items() if 8 <= i <= 12} == {0, -1}


def test_contaminated_with_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(docs_of(spark, []), bench).count() == 0
    assert decontaminate.contaminated(docs_of(spark, [(1, "a b c d e f")]), bench.limit(0)).count() == 0


def test_contaminated_runs_no_python(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.contaminated(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")), bench)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


# ---- 2: LM scores --------------------------------------------------------------------------

def brute_lm(rows):
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = [(d, cut(t)) for d, t in rows]
    uni = Counter(w for _, t in texts for w in t)
    bi = Counter(p for _, t in texts for p in zip(t, t[1:]))
    total, out = sum(uni.values()), defaultdict(lambda: [0, 0, 0.0])
    for d, t in texts:
        o = out[d]
        o[0] += len(t)
        for i, w in enumerate(t):
            if i == 0:
                o[2] += math.log(uni[w] / total)
            elif bi[t[i - 1], w] >= lm_score.MIN_COUNT:
                o[2] += math.log(bi[t[i - 1], w] / uni[t[i - 1]])
            else:
                o[1] += 1
                o[2] += math.log(lm_score.BACKOFF * uni[w] / total)
    return out


@pytest.mark.parametrize("top,size", [(1 << 18, 2_500_000), (5, 40), (0, 7)])
def test_lm_scores_match_brute_force(spark, monkeypatch, top, size):
    """Also with few or no words in the broadcast table, and with many buckets."""
    monkeypatch.setattr(lm_score, "TOP_WORDS", top)
    monkeypatch.setattr(lm_score, "BUCKET_PAIRS", size)
    rng = random.Random(2)
    v = vocabulary(40, rng)
    rows = [(i, "  ".join(rng.choice(v) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "É Ça\x00b Ça"), rows[3], rows[3], (None, "a b a b"), (7, "b a B A")]
    rows.append((105, " ".join(rng.choice(v) for _ in range(20_000))))
    got = {r.doc_id: r for r in lm_score.lm_scores(docs_of(spark, rows).repartition(3)).collect()}
    want = brute_lm(rows)
    assert set(got) == set(want)
    for d, (n, back, s) in want.items():
        assert (got[d].n_words, got[d].n_backoff) == (n, back) and got[d].score == pytest.approx(s, abs=1e-6)
        assert got[d].mean_score is None if n == 0 else got[d].mean_score == pytest.approx(s / n, abs=1e-9)
    assert lm_score.lm_scores(docs_of(spark, [])).count() == 0


def test_lm_scores_send_no_frequent_pair_to_a_bucket(spark, monkeypatch):
    """A pair that is most of the corpus stays where it stands; before, one task got all of it."""
    dealt = []
    frame = type(spark.range(1))
    deal = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda self, *a: dealt.append(self) or deal(self, *a))
    rows = [(i, "to be or not " * 400) for i in range(10)] + [(50, "w " * 20_000), (51, "w W x"), (52, "to not or be w")]
    monkeypatch.setattr(lm_score, "BUCKET_PAIRS", 20_000)
    got = {r.doc_id: r for r in lm_score.lm_scores(docs_of(spark, rows).repartition(3)).collect()}
    sent = dealt[0].select(F.explode("sizes").alias("n")).agg(F.sum("n")).head()[0]
    assert sent == 5  # w x, and the four pairs of the last text
    for d, (n, back, s) in brute_lm(rows).items():
        assert (got[d].n_words, got[d].n_backoff) == (n, back) and got[d].score == pytest.approx(s, rel=1e-9)


# ---- 5: licenses ---------------------------------------------------------------------------

def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for p, label in licenses.BASE.items():
        p = p.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(spark):
    mit = licenses.TEMPLATES[4][1]
    loose = mit.split()
    loose.insert(8, "kindly")
    del loose[15]
    rows = [(1, None), (2, ""), (3, "CC-BY cc  by. Licensed under CC BY-NC 4.0"), (4, "x All Rights Reserved. All rights reserved!"), (5, "General Public License, cc"),
            (6, "Intro. " + " ".join(loose) + " end"), (7, "permission is hereby granted to leave"), (8, "cc"), (9, "cc by"),
            (10, "Licensed under the Apache License, Version 2.0."), (11, "K cc bу cc BY"), (12, "Released under the MIT License"),
            (13, "word " * 30_000 + "all rights reserved " * 500), (None, "cc by"), (4, "x All Rights Reserved. All rights reserved!"), (14, "all rightsKreserved K")]
    got = {r.doc_id: r for r in licenses.license_scan(docs_of(spark, rows)).collect()}
    assert len(got) == len(rows) - 1
    for d, t in rows:
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t), d
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score == 1) >= (r.n_base > 0)
    assert got[6].labels == "mit" and got[6].spans[0].first == 1 and got[6].spans[0].last == len(loose) and got[6].score > 0.8
    assert got[7].labels == "" and 0 < got[7].score < licenses.COVER
    assert got[10].labels == "apache-2.0" and got[12].labels == "mit" and got[3].labels == "cc-by,cc-by-nc-4.0"
    assert licenses.license_scan(docs_of(spark, [])).count() == 0


def brute_cover(text, template):
    """Best cover of the template: hits of 3 words by diagonal, diagonals at most SLIP apart together."""
    w, t = licenses.template_words(text or ""), licenses.template_words(template)
    hits = {}
    for i in range(len(w) - 2):
        for j in range(len(t) - 2):
            if w[i:i + 3] == t[j:j + 3]:
                hits.setdefault(i - j, set()).update((j, j + 1, j + 2))
    best, cells, last = 0, set(), None
    for d in sorted(hits):
        cells = cells | hits[d] if last is not None and d - last <= licenses.SLIP else hits[d]
        best, last = max(best, len(cells)), d
    return best / len(t)


def test_license_templates_of_any_length(spark):
    rng = random.Random(6)
    v = vocabulary(400, rng)
    long = [rng.choice(v) for _ in range(700)]
    templates = [("long", " ".join(long)), ("edge", "Three Short, words"), ("sixty", " ".join(long[:licenses.PART])),
                 ("border", " ".join(long[100:100 + licenses.PART + 1]))]
    edited = list(long)
    for i in range(0, 600, 40):
        edited[i] = "x"
    del edited[300:302]
    rows = [(1, " ".join(long)), (2, "intro " + " ".join(edited) + " end"), (3, " ".join(long[:350])), (4, "three short words"),
            (5, " ".join(long[58:200])), (6, None), (7, " ".join(long + long[:90])), (8, " ".join(long[100:150] + ["x"] + long[150:]))]
    got = {r.doc_id: r for r in licenses.license_scan(docs_of(spark, rows), templates).collect()}
    for d, text in rows:
        covers = {name: brute_cover(text, t) for name, t in templates}
        assert got[d].score == pytest.approx(max(covers.values())), d
        assert got[d].labels == ",".join(sorted(n for n, c in covers.items() if c >= licenses.COVER)), d
    assert "long" in got[2].labels and "long" not in got[3].labels and got[1].score == 1
    with pytest.raises(ValueError):
        licenses.license_scan(docs_of(spark, rows), [("short", "two words")])


def test_whole_license_text_is_found(spark):
    mit = max((t for label, t in licenses.TEMPLATES if label == "mit"), key=len)
    assert len(mit.split()) > 150
    got = licenses.license_scan(docs_of(spark, [(1, "Copyright 2020 someone. " + mit.capitalize() + ".")])).head()
    assert got.labels == "mit" and any(s.last - s.first + 1 == len(mit.split()) and s.cover == 1 for s in got.spans)


# ---- 9: token counts -----------------------------------------------------------------------

TRICKY = ["", " ", "it's we'll ''s 'S they'RE", "a<|endoftext|>b", "<|startoftext|>", "Ünïcode ÉCOLE İstanbul ΑΣ Σας", "١٢٣ 12³ ½", "é é",
          "a b\u0085c\x1cd\x00e", "日本語 テスト", "x" * 5000, "Kſ", "!!!***###", "don't'd", "a​b", "Ǆǅ ŉ ǰ", "😀 ok"]


def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_token_count_equals_the_library(text):
    counter = test_token_count_equals_the_library.__dict__.setdefault("c", token_counts.TokenCounter(public_tokenizers.path("word_bpe_49k.json"), {}))
    lib = test_token_count_equals_the_library.__dict__.setdefault("l", library())
    for t in (text, *TRICKY):
        assert counter.count(t) == len(lib.encode(t, add_special_tokens=False).ids)


def test_token_counts_table(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 3)
    lib = library()
    rows = [*enumerate(TRICKY), (None, "a b"), (90, None), (2, TRICKY[2]), (91, "the quick brown " * 3000)]
    got = Counter(tuple(r) for r in token_counts.token_counts(docs_of(spark, rows), public_tokenizers.path("word_bpe_49k.json"), table_size=4).collect())
    want = []
    for d, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    assert got == Counter(want)
    assert token_counts.token_counts(docs_of(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_frequent_pieces_come_from_all_documents(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, "alpha beta") for i in range(600)] + [(600 + i, "caf\u00e9 gamma \u2019tis" if i % 2 else None) for i in range(1200)]
    rows += [(5000 + i, f"rare{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}") for i in range(100)] + [(6000, "y" * 100 + " " + "z" * 65)]
    counter = token_counts.TokenCounter(path, {})
    want = Counter(p for _, t in rows for p in counter.pieces(t or ""))
    total = want.total()
    docs = docs_of(spark, rows).coalesce(1).sortWithinPartitions("doc_id")
    got = {r.piece: r.n for r in token_counts.frequent_pieces(docs, path, 20).collect()}
    assert got == {p: n for p, n in want.items() if 20 * n >= total} and {"alpha", "gamma", "\u2019tis"} <= set(got)
    got = {r.piece: r.n for r in token_counts.frequent_pieces(docs, path, 10_000).collect()}
    assert got == {p: n for p, n in want.items() if len(p) <= token_counts.LONGEST}
    many = token_counts.frequent_pieces(docs_of(spark, rows).repartition(7), path, 20).collect()
    assert {r.piece for r in many} >= {p for p, n in want.items() if 20 * n > 2 * total} and all(r.n <= want[r.piece] for r in many)
    monkeypatch.setattr(token_counts, "COUNTED", 40)
    got = {r.piece: r.n for r in token_counts.frequent_pieces(docs, path, 20).collect()}
    assert all(want[p] - total // 10 <= n <= want[p] for p, n in got.items()) and {"alpha", "gamma"} <= set(got)
    assert token_counts.frequent_lengths(docs_of(spark, []), path) == {}


def test_cut_counts_loses_at_most_its_share():
    rng = random.Random(3)
    n, true = Counter(), Counter()
    for _ in range(20_000):
        w = int(rng.paretovariate(0.8))
        true[w] += 1
        n[w] += 1
        if len(n) > 80:
            token_counts.cut_counts(n, 20)
    assert all(0 <= true[w] - n[w] <= 20_000 / 21 for w in true) and len(n) <= 80
