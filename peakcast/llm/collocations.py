"""Phrase collocation mining on Rabin-Karp fingerprints.

Tasks hash every word with a running polynomial over a text's bytes and every n-gram with one over its word hashes: an
n-gram's fingerprint is a difference of two prefix sums, whatever its length. Fingerprints are counted in each task; the
shuffle adds up the counts and keeps a second fingerprint's range and an occurrence pointer (the least hash of a text that
holds the n-gram, so that copies of a text are one place). Phrases count per language, so a language is part of the
fingerprint.

N-grams are counted by length: one of n words can reach a count only if both its parts of n - 1 words do. Which
fingerprints reached it goes to the tasks as a bit table of a fixed size (BITS bits), so the shuffle gets few of the
rare n-grams; a bit that is set by chance costs work, never a result.

Only phrases with enough occurrences are materialised: pointers are grouped by text and joined to the texts, which are
hashed again and cut where a wanted fingerprint begins. Fingerprints whose
second fingerprint isn't the same everywhere, or whose texts at the pointer differ, stand for several phrases: these are
counted anew by their texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored
from .textio import Texts, U, byte_table, chunks, mix, words

LEAST, LONGEST, INSIDE_PERCENT, TOP = 10, 3, 50, 2000
UNKNOWN = "und"
SPLITTERS = sorted({ord(c) for c in ".,;:!?"} | set(range(0x0A, 0x0E)))
_TABLE = byte_table({0x20, 0x09, *SPLITTERS})
_LETTERS = _TABLE.astype(np.uint32)
_SPLITS = np.zeros(256, bool)
_SPLITS[SPLITTERS] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
#: Bits of a table of fingerprints (8 MB).
BITS = 26
#: Bytes of text that a task hashes at a time; a longer text is cut between pieces.
CHUNK = 1 << 20
#: Pointers are text hashes without their last bits: equal pointers of different texts cost work, never a result.
POINTER_SHIFT = 24
#: N-grams that a task holds before it counts them.
HELD = 1 << 20
_WORD_BASE, _GRAM_BASE, _GRAM_BASE_2 = 0x2545F4914F6CDD1D, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_POWERS: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int, kind=U) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i, modulo the size of ``kind``, for i < n (kept, doubled as needed)."""
    key = base, kind
    if key not in _POWERS or len(_POWERS[key][0]) < n:
        m, out = max(1 << 16, 1 << (max(n, 1) - 1).bit_length()), []
        with np.errstate(over="ignore"):
            for b in (base, pow(base, -1, 1 << 64)):
                a = np.full(m, b & np.iinfo(kind).max, kind)
                a[0] = 1
                out.append(np.multiply.accumulate(a, dtype=kind))
        _POWERS[key] = out[0], out[1]
    return _POWERS[key]


class Prefix:
    """Prefix sums of a polynomial in ``base``: fingerprints of any spans of ``items`` by two look-ups. 32-bit items have
    sums modulo 2**32, others modulo 2**64."""

    def __init__(self, items: np.ndarray, base: int):
        power, self.inverse = powers(base, len(items) + 1, items.dtype.type)
        self.run = np.zeros(len(items) + 1, items.dtype)
        with np.errstate(over="ignore"):
            np.cumsum(items * power[:len(items)], out=self.run[1:])

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(((self.run[end] - self.run[begin]) * self.inverse[begin]).astype(U) + (end - begin).astype(U) * U(0xD6E8FEB86659FD93))


    def runs(self, n: int) -> np.ndarray:
        """Fingerprints of all spans of ``n`` items."""
        k = max(len(self.run) - n, 0)
        with np.errstate(over="ignore"):
            return mix(((self.run[n:] - self.run[:k]) * self.inverse[:k]).astype(U) + U(n * 0xD6E8FEB86659FD93 & (1 << 64) - 1))


def segments(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) as ``chunks``, but a text of more than CHUNK bytes comes in several turns, cut after
    splitters, which no phrase crosses. A single piece beyond that size stays whole."""
    for lo, hi, t in chunks(column, CHUNK):
        if hi - lo > 1 or len(t.data) <= CHUNK:
            yield lo, hi, t
            continue
        cuts = np.flatnonzero(_SPLITS[t.data]) + 1
        at = 0
        while at < len(t.data):
            last = np.searchsorted(cuts, at + CHUNK, "right") - 1
            end = int(cuts[last]) if last >= 0 and cuts[last] > at else int(next(iter(cuts[last + 1:]), len(t.data)))
            end = len(t.data) if len(t.data) - at <= CHUNK else end
            yield lo, hi, Texts(t.data[at:end], np.array([0, end - at]))
            at = end


def language_seeds(langs: list[str]) -> np.ndarray:
    seen = {x: int.from_bytes(x.encode()[:64], "little") * 0x9E3779B97F4A7C15 + len(x.encode()) * 0x632BE59BD9B4E019 & (1 << 64) - 1 for x in set(langs)}
    return mix(np.array([seen[x] for x in langs], U))


@dataclass
class Grams:
    """N-grams of some texts by word: of length n, ``fp[n][i]`` is that which begins at word i, ``inside[n][i]`` says
    whether it ends in the piece where it begins."""
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    fp: dict[int, np.ndarray]
    check: dict[int, np.ndarray]
    inside: dict[int, np.ndarray]
    lower: np.ndarray

    def phrase(self, i: int, n: int) -> str:
        return b" ".join(self.lower[self.begin[j]:self.end[j]].tobytes() for j in range(i, i + n)).decode("utf-8", "replace")


def grams(t: Texts, seeds: np.ndarray, sizes, fp_bits: int = 64, with_check: bool = True) -> Grams:
    w = words(t, _TABLE)
    m = len(w.hashes)
    text = np.repeat(np.arange(len(t)), np.diff(w.first))
    piece = np.cumsum(_SPLITS[t.data], dtype=np.int32)[w.begin] + text if m else text
    first, second = Prefix(w.hashes, _GRAM_BASE), None
    if with_check:
        second = Prefix(Prefix(_LETTERS[t.data], _WORD_BASE).spans(w.begin, w.end), _GRAM_BASE_2)
    out = Grams(w.begin, w.end, text, {}, {}, {}, _LOWER[t.data])
    seed = seeds[text]
    for n in sizes:
        k = max(m - n + 1, 0)
        with np.errstate(over="ignore"):
            out.fp[n] = (mix((first.runs(n) ^ seed[:k]) + U(n)) >> U(64 - fp_bits)).view(np.int64)
        if second is not None:
            out.check[n] = (second.runs(n) >> U(33)).astype(np.int32)
        out.inside[n] = piece[:k] == piece[n - 1:]
    return out


def _slot(fp: np.ndarray) -> np.ndarray:
    return (mix(fp.view(U)) >> U(64 - BITS)).astype(np.int64)


def has_bit(table: np.ndarray, fp: np.ndarray) -> np.ndarray:
    s = _slot(fp)
    return table[s >> 3] >> (s & 7).astype(np.uint8) & 1 == 1


def bit_table(fps: DataFrame, column: str = "fp") -> np.ndarray:
    """A table of 2**BITS bits with those of the column's values set. Tasks find the bits, the shuffle merges them by
    word, and the driver gets the words that are not zero: as many as the table has, at most."""

    def work(batches):
        for b in batches:
            s = np.unique(_slot(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            word, at = np.unique(s >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(U(1) << (s & 63).astype(U), at) if len(s) else np.zeros(0, U)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    merged = fps.select(column).mapInArrow(work, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << BITS - 6, np.int64)
    out[merged.column("word").to_numpy()] = merged.column("bits").to_numpy()
    return out.view(np.uint8)


def _pair(fp: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One number for a fingerprint and the text that it is to be found in."""
    with np.errstate(over="ignore"):
        return mix(fp.view(U) + mix(doc.view(U) + U(0x51))).view(np.int64)


def scan(batches, sizes, fp_bits: int, with_check: bool = True):
    """(languages, pointers, n-grams) of runs of rows (doc, lang, text)."""
    for b in batches:
        langs, docs = b.column(1).to_pylist(), b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        seeds = language_seeds(langs)
        for lo, hi, t in segments(b.column(2)):
            yield langs[lo:hi], docs[lo:hi], grams(t, seeds[lo:hi], sizes, fp_bits, with_check)


class Miner:
    """The scans of one corpus (``docs``: doc, the text's hash; lang; text; none of them null)."""

    def __init__(self, docs: DataFrame, least: int, longest: int, fp_bits: int):
        self.docs, self.least, self.longest, self.fp_bits = docs, least, longest, fp_bits

    def counted(self, n: int, shorter: np.ndarray | None) -> DataFrame:
        """fp, n, size, check_low, check_high, doc of the n-grams whose fingerprint occurs often enough. ``shorter``: bit
        table of the fingerprints of n - 1 words that do."""
        shared = None if shorter is None else self.docs.sparkSession.sparkContext.broadcast(shorter)
        fp_bits = self.fp_bits

        def summed(held):
            """One row for each fingerprint among the held n-grams."""
            fp, check, doc = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(fp)
            fp, check, doc = fp[order], check[order], doc[order]
            start = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]][:len(fp)])
            least = lambda f, x: f.reduceat(x, start) if len(start) else x
            return pa.RecordBatch.from_arrays([
                pa.array(x) for x in (fp[start], np.diff(np.r_[start, len(fp)]), least(np.minimum, check), least(np.maximum, check),
                                      least(np.minimum, doc))], names=["fp", "n", "low", "high", "doc"])

        def work(batches):
            held, size = [], 0
            for _, docs, g in scan(batches, (n - 1, n) if shared else (n,), fp_bits):
                keep = g.inside[n]
                if shared:
                    part = has_bit(shared.value, g.fp[n - 1])
                    keep = keep & part[:len(keep)] & part[1:]
                at = np.flatnonzero(keep)
                held.append((g.fp[n][at], g.check[n][at], docs[g.text[at]]))
                size += len(at)
                if size >= HELD:
                    yield summed(held)
                    held, size = [], 0
            if held:
                yield summed(held)

        return (self.docs.mapInArrow(work, "fp long, n long, low int, high int, doc long").groupBy("fp")
                .agg(F.sum("n").alias("n"), F.min("low").alias("check_low"), F.max("high").alias("check_high"), F.min("doc").alias("doc"))
                .filter(F.col("n") >= self.least).withColumn("size", F.lit(n)))

    def at_pointers(self, frequent: DataFrame) -> DataFrame:
        """fp, size, lang, phrase for each frequent fingerprint, as it stands in the text of its pointer: several rows for a
        fingerprint if that text has several phrases of it. A text's list of wanted fingerprints is no longer than the
        text; a task passes on a text once, however many copies of it there are."""
        wanted = stored(frequent.groupBy("doc").agg(F.collect_list("fp").alias("want")), "pointers")
        shared = self.docs.sparkSession.sparkContext.broadcast(bit_table(wanted, "doc"))
        fp_bits, sizes = self.fp_bits, range(1, self.longest + 1)

        def pointed(batches):
            seen: set[int] = set()
            for b in batches:
                doc = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                keep = has_bit(shared.value, doc)
                for i in np.flatnonzero(keep).tolist():
                    keep[i] = doc[i] not in seen
                    seen.add(int(doc[i]))
                yield b.filter(pa.array(keep))

        def work(batches):
            for b in batches:
                wants = b.column(3)
                owner = np.repeat(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(wants.offsets.to_numpy()))
                pairs = np.unique(_pair(wants.flatten().to_numpy(zero_copy_only=False).astype(np.int64), owner))
                for langs, docs, g in scan([b], sizes, fp_bits, False):
                    rows = set()
                    for n in sizes:
                        found = np.isin(_pair(g.fp[n], docs[g.text[:len(g.fp[n])]]), pairs) & g.inside[n]
                        for i in np.flatnonzero(found).tolist():
                            rows.add((int(g.fp[n][i]), n, langs[g.text[i]], g.phrase(i, n)))
                    rows = sorted(rows)
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(
                        (pa.int64(), pa.int32(), pa.string(), pa.string()))], names=["fp", "size", "lang", "phrase"])

        texts = self.docs.mapInArrow(pointed, "doc long, lang string, text string").join(wanted, "doc")
        found = texts.select("doc", "lang", "text", "want").mapInArrow(work, "fp long, size int, lang string, phrase string")
        return found.join(frequent.select("fp", "size"), ["fp", "size"], "left_semi").distinct()

    def by_text(self, clashing: DataFrame) -> DataFrame:
        """size, lang, phrase, n of the phrases whose fingerprint is among ``clashing`` (fp, size), counted by their texts."""
        shared = self.docs.sparkSession.sparkContext.broadcast(bit_table(clashing))
        fp_bits, sizes = self.fp_bits, range(1, self.longest + 1)

        def work(batches):
            for langs, _, g in scan(batches, sizes, fp_bits, False):
                n_of: Counter = Counter()
                for n in sizes:
                    for i in np.flatnonzero(g.inside[n] & has_bit(shared.value, g.fp[n])).tolist():
                        n_of[int(g.fp[n][i]), n, langs[g.text[i]], g.phrase(i, n)] += 1
                yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in n_of], kind) for j, kind in enumerate(
                    (pa.int64(), pa.int32(), pa.string(), pa.string()))] + [pa.array(n_of.values(), pa.int64())],
                    names=["fp", "size", "lang", "phrase", "n"])

        return (self.docs.mapInArrow(work, "fp long, size int, lang string, phrase string, n long").join(clashing, ["fp", "size"], "left_semi")
                .groupBy("size", "lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= self.least))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, fp_bits: int = 64, text: str = "text",
                     lang: str = "lang") -> DataFrame:
    """lang, phrase, size (words), n: all phrases of up to ``longest`` words that occur at least ``least`` times in a
    language, with their exact counts, whatever the fingerprints' collisions (``fp_bits`` below 64 makes some)."""
    d = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    d = d.select(F.shiftright(F.xxhash64("lang", "text"), POINTER_SHIFT).alias("doc"), "lang", "text")
    m = Miner(d, least, longest, fp_bits)
    frequent, bits = None, None
    for n in range(1, longest + 1):
        level = stored(m.counted(n, bits), f"grams-{n}")
        bits = bit_table(level) if n < longest else None
        frequent = level if frequent is None else frequent.unionByName(level)
    found = stored(m.at_pointers(frequent), "phrases")
    several = found.groupBy("fp", "size").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") > 1).select("fp", "size")
    clashing = stored(frequent.filter(F.col("check_low") != F.col("check_high")).select("fp", "size").unionByName(several).distinct(), "clashes")
    out = (found.join(frequent.select("fp", "size", "n"), ["fp", "size"]).join(clashing, ["fp", "size"], "left_anti")
           .select("lang", "phrase", "size", "n"))
    if clashing.head(1):
        out = out.unionByName(m.by_text(clashing).select("lang", "phrase", "size", "n"))
    return out


def _words(phrase: Column, first: int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, inside_percent: int = INSIDE_PERCENT,
                 top: int = TOP, fp_bits: int = 64, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``longest`` words.

    ASCII letters are folded; texts are split into pieces at ``.,;:!?`` and line breaks, pieces into words at blanks and
    tabs; phrases stand inside a piece. Null texts are empty, a null language is ``und``; repeated rows and null ids count
    as often as they stand; an empty table, or one without phrases that are frequent enough, gives no rows. Score:
    1,000,000 a^2 / (l r) rounded down, at the cut of a phrase where it is least (the first of equal ones), in exact
    decimals: right while counts are below 10^13. A phrase goes if it stands inside a longer one that occurs at
    ``inside_percent`` or more of its own occurrences. Ties are ordered by a (falling), then by the phrase's bytes.
    """
    all_phrases = stored(frequent_phrases(docs, least, longest, fp_bits, text, lang), "frequent-phrases")
    size = F.col("size")
    long_ones = all_phrases.filter(size >= 2).withColumnRenamed("n", "a")
    cuts = long_ones.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.withColumn("left", _words(F.col("phrase"), 1, F.col("cut"))).withColumn(
        "right", F.array_join(F.slice(F.split("phrase", " "), F.col("cut") + 1, size - F.col("cut")), " "))
    for part, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(all_phrases.select("lang", F.col("phrase").alias(part), F.col("n").alias(count)), ["lang", part])
    exact = lambda c: F.col(c).cast("decimal(13,0)")
    cuts = cuts.withColumn("num", F.lit(1_000_000).cast("decimal(7,0)") * (exact("a") * exact("a"))).withColumn("den", exact("l") * exact("r"))
    scored = (cuts.withColumn("score", F.expr("num div den")).groupBy("lang", "phrase", "a", "size")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")))
    # Every shorter phrase inside a longer one, with the count of the longer one that holds most of it.
    inner = long_ones.filter(size >= 3).select("lang", "a", "size", F.split("phrase", " ").alias("w"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), size - 1)).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("i"))
    held = inner.groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = (scored.join(held, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
              .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    total = (docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                         F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("n"))
             .groupBy("lang").agg(F.sum("n").alias("n")))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '{UNKNOWN}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT id, lang, string_split_regex(t, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM d),
p AS (SELECT id, lang, generate_subscripts(pieces, 1) AS piece, unnest(pieces) AS t FROM s),
x AS (SELECT id, lang, piece, regexp_extract_all(t, '[^\\x20\\x09]+') AS w FROM p),
w AS (SELECT id, lang, piece, generate_subscripts(w, 1) AS pos, unnest(w) AS w1 FROM x),
g AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY id, piece ORDER BY pos)),
total AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM f2 b JOIN f1 l ON l.lang = b.lang AND l.w1 = b.w1 JOIN f1 r ON r.lang = b.lang AND r.w1 = b.w2 WHERE b.f >= {LEAST}
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, l.f, r.f
  FROM f3 t JOIN f1 l ON l.lang = t.lang AND l.w1 = t.w1 JOIN f2 r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, l.f, r.f
  FROM f3 t JOIN f2 l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2 JOIN f1 r ON r.lang = t.lang AND r.w1 = t.w3),
scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
best AS (
  SELECT lang, phrase, a, l, r, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN held h USING (lang, phrase) WHERE h.longer IS NULL OR 100 * h.longer < {INSIDE_PERCENT} * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= {TOP})
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang)"""
