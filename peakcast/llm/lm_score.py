"""Language-model scores by stupid backoff over word bigrams.

With counts c over the whole corpus of N words, a word after another has ln(c(v w) / c(v)) if the pair occurs at
least MIN_COUNT times, else ln(BACKOFF * c(w) / N); a text's first word has ln(c(w) / N). A document's score is
the sum. (A pair that occurs once is only known from the text that is being scored, so it counts as unseen.)

* Words are counted in tasks first and summed by hash: the unigram table, stored.
* Pairs that occur a tenth of a bucket's size or more often are counted in tasks first, too, and broadcast: tasks
  score them where they stand. Both words of such a pair are as frequent, so only pairs of such words are counted;
  there are TOP_PAIRS such pairs at most, as the bound rises with the number of words beyond that.
* All other pairs are dealt out by the pair's hash, packed by task and hash bucket. A bucket holds all
  occurrences of its pairs, so the task that gets it makes its part of the pair table, joins it to the
  occurrences and sums by document. No pair crosses the network twice. The number of buckets follows the
  number of words, so a bucket's size doesn't grow, and no single pair is more than a tenth of it.
* Counts of the TOP_WORDS most frequent words are broadcast (16 bytes each). Terms of other words are joined to
  the unigram table by hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, stored
from .textio import SPACE_TABLE, U, Texts, Words, chunks, mix, words

MIN_COUNT, BACKOFF = 2, 0.4
TOP_WORDS = 1 << 18
#: Word pairs for each bucket, about.
BUCKET_PAIRS = 2_500_000
#: Broadcast pairs, at most (16 bytes each).
TOP_PAIRS = 1 << 18
_FLUSH = 4_000_000


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (64-bit hash), n: how often each word occurs. Tasks send each of their words once for every few million."""
    def work(batches):
        held, size = [], 0
        for b in batches:
            for _, _, t in chunks(b.column(0)):
                held.append(words(t, SPACE_TABLE).hashes)
                size += len(held[-1])
                if size >= _FLUSH:
                    h, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays([_signed(h), pa.array(n.astype(np.int64))], names=["word", "n"])
                    held, size = [], 0
        if size:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(h), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.select("text").mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Frequent:
    """Counts of the most frequent words, sorted by hash for binary search."""

    def __init__(self, word: np.ndarray, n: np.ndarray, total: int):
        order = np.argsort(word)
        self.word, self.log_n, self.log_total = word[order], np.log(n[order].astype(float)), float(np.log(max(total, 1)))

    def log_counts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log count, whether the word is here)."""
        if not len(self.word):
            return np.zeros(len(h)), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        return self.log_n[at], self.word[at] == h


def _pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(v * U(0x9E3779B97F4A7C15) + mix(w + U(0x632BE59BD9B4E019)))


def _pairs(t: Texts):
    """(words, document of each word, index of the first word of each pair)."""
    w = words(t, SPACE_TABLE)
    doc = np.repeat(np.arange(len(t), dtype=np.int64), np.diff(w.first))
    return w, doc, np.flatnonzero(doc[:-1] == doc[1:])


@dataclass
class FrequentPairs:
    """The pairs that occur at least ``limit`` times, and the words that do."""
    pairs: Frequent
    words: Frequent

    def terms(self, w: Words, doc: np.ndarray, i: np.ndarray, n_docs: int, min_count: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
        """(number of backoffs, sum of scores) by document of the frequent ones among its pairs."""
        if not len(self.pairs.word):
            return np.zeros(n_docs, np.int64), np.zeros(n_docs)
        log_n, here = self.pairs.log_counts(_pair_hash(w.hashes[i], w.hashes[i + 1]))
        i, log_n = i[here], log_n[here]
        seen = log_n >= np.log(min_count)
        log_word = self.words.log_counts(np.where(seen, w.hashes[i], w.hashes[i + 1]))[0]
        value = np.where(seen, log_n - log_word, np.log(backoff) + log_word - self.words.log_total)
        return np.bincount(doc[i], ~seen, n_docs), np.bincount(doc[i], value, n_docs)


def frequent_pairs(docs: DataFrame, counts: DataFrame, total: int, limit: int) -> FrequentPairs:
    """The pairs that occur at least ``limit`` times: total / limit of them at most, and as many words."""
    def table(rows: DataFrame) -> Frequent:
        t = rows.filter(F.col("n") >= limit).toArrow()
        return Frequent(np.asarray(t.column(0), np.int64).view(U), np.asarray(t.column(1), np.int64), total)

    frequent = table(counts.select("word", "n"))
    if not len(frequent.word):
        return FrequentPairs(frequent, frequent)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches):
        held, size = [], 0

        def summed():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([_signed(h), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for b in batches:
            for _, _, t in chunks(b.column(0)):
                w, _, i = _pairs(t)
                known = shared.value.log_counts(w.hashes)[1]
                i = i[known[i] & known[i + 1]]
                held.append(_pair_hash(w.hashes[i], w.hashes[i + 1]))
                size += len(i)
                if size >= _FLUSH:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    found = docs.select("text").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return FrequentPairs(table(found), frequent)


def pack(t: Texts, ids: pa.Array, n_buckets: int, frequent: Frequent) -> pa.RecordBatch | None:
    """A row for each bucket: the ids of the documents with pairs in it, how many each has, and the pairs' words, one
    pair after another and white space between all words. Without the frequent pairs."""
    w, doc, i = _pairs(t)
    pair = _pair_hash(w.hashes[i], w.hashes[i + 1])
    if len(frequent.word):
        rare = ~frequent.log_counts(pair)[1]
        i, pair = i[rare], pair[rare]
    if not len(i):
        return None
    bucket = (pair >> U(32)) % U(n_buckets)
    order = np.argsort(bucket.astype(np.int32), kind="stable")
    i, bucket = i[order], bucket[order].astype(np.int64)
    size = w.end[i + 1] - w.begin[i] + 1
    stop = np.cumsum(size)
    at = np.arange(stop[-1], dtype=np.int64) + np.repeat(w.begin[i] - (stop - size), size)
    folded = np.append(SPACE_TABLE[t.data], np.uint8(0))
    out = folded[at]
    out[out == 0] = 32
    out[stop - 1] = 32
    run = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (doc[i][1:] != doc[i][:-1])]))
    per_doc = np.diff(np.append(run, len(i)))
    rows = np.flatnonzero(np.concatenate([[True], bucket[run][1:] != bucket[run][:-1]]))
    lists = pa.array(np.append(rows, len(run)).astype(np.int32))
    text_at = np.append((stop - size)[run[rows]], stop[-1])
    grams = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(text_at.astype(np.int64)), pa.py_buffer(out)])
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[run[rows]].astype(np.int32)), pa.ListArray.from_arrays(lists, ids.take(pa.array(doc[i][run]))),
         pa.ListArray.from_arrays(lists, pa.array(per_doc.astype(np.int32))), grams.cast(pa.binary())], names=["bucket", "docs", "sizes", "grams"])


TERMS = "doc_id long, n_words long, n_backoff long, score double, word long, weight double"


def _terms(ids, n_words, n_backoff, score, word=None, weight=None) -> pa.RecordBatch:
    """Rows of TERMS: a document's part, or (with ``word``) ``weight`` times the log count of a word yet to be joined."""
    n = len(ids)
    zero = np.zeros(n, np.int64)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(zero if n_words is None else n_words.astype(np.int64)), pa.array(zero if n_backoff is None else n_backoff.astype(np.int64)),
         pa.array(np.zeros(n) if score is None else score), pa.nulls(n, pa.int64()) if word is None else _signed(word),
         pa.array(np.zeros(n) if weight is None else weight)], names=["doc_id", "n_words", "n_backoff", "score", "word", "weight"])


def score_bucket(rows: list[pa.RecordBatch], top: Frequent, min_count: int, backoff: float):
    """Terms of all pairs of a bucket: counts its pairs, joins the counts to the occurrences, sums by document."""
    table = pa.Table.from_batches(rows).combine_chunks()
    ids = pa.concat_arrays([c.flatten() for c in table.column("docs").chunks])
    sizes = np.concatenate([np.asarray(c.flatten()) for c in table.column("sizes").chunks])
    h = np.concatenate([words(t, SPACE_TABLE).hashes for c in table.column("grams").chunks for _, _, t in chunks(c)])
    v, w = h[0::2], h[1::2]
    pairs = _pair_hash(v, w)
    order = np.argsort(pairs)
    new = np.concatenate([[True], pairs[order][1:] != pairs[order][:-1]])
    count = np.empty(len(pairs), np.int64)
    count[order] = np.diff(np.append(np.flatnonzero(new), len(pairs)))[np.cumsum(new) - 1]
    code = ids.dictionary_encode(null_encoding="encode")
    names = code.dictionary
    doc = np.repeat(np.asarray(code.indices), sizes)
    seen = count >= min_count
    log_n, known = top.log_counts(np.where(seen, v, w))
    sign = np.where(seen, -1.0, 1.0)
    value = np.where(seen, np.log(count), np.log(backoff) - top.log_total) + np.where(known, sign * log_n, 0.0)
    yield _terms(names, None, np.bincount(doc, ~seen, len(names)), np.bincount(doc, value, len(names)))
    rest = np.flatnonzero(~known)
    if len(rest):
        yield _terms(names.take(pa.array(doc[rest])), None, None, None, np.where(seen, v, w)[rest], sign[rest])


def lm_scores(docs: DataFrame, min_count: int = MIN_COUNT, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, n_backoff (words scored by the backoff), score (sum of natural logs), mean_score (score per
    word), of documents under the counts of these same documents.

    Words are runs of characters other than ASCII white space, A-Z in lower case. Null, empty and blank texts have
    0 words, score 0 and a null mean. Rows that repeat an id are summed to one row; a null id is an id of its own. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    d = doc_text(docs)
    counts = stored(word_counts(d), "words")
    total = counts.agg(F.sum("n")).head()[0] or 0
    table = counts.orderBy(F.desc("n"), "word").limit(TOP_WORDS).toArrow()  # the documented bound
    top = spark.sparkContext.broadcast(Frequent(np.asarray(table.column("word"), np.int64).view(U), np.asarray(table.column("n"), np.int64), total))
    n_buckets = max(1, -(-total // BUCKET_PAIRS))
    frequent = spark.sparkContext.broadcast(frequent_pairs(d, counts, total, max(1, BUCKET_PAIRS // 10, -(-total // TOP_PAIRS))))

    def pairs(batches):
        for b in batches:
            for lo, hi, t in chunks(b.column(1)):
                row = pack(t, b.column(0).slice(lo, hi - lo), n_buckets, frequent.value.pairs)
                if row is not None:
                    yield row

    def score(batches):
        rows = [b for b in batches if len(b)]
        if rows:
            yield from score_bucket(rows, top.value, min_count, backoff)

    def firsts(batches):
        """Terms of the first words and of the frequent pairs."""
        for b in batches:
            for lo, hi, t in chunks(b.column(1)):
                w, doc, i = _pairs(t)
                back, value = frequent.value.terms(w, doc, i, hi - lo, min_count, backoff)
                ids, n = b.column(0).slice(lo, hi - lo), np.diff(w.first)
                have = n > 0
                h = np.zeros(len(n), U)
                h[have] = w.hashes[w.first[:-1][have]]
                log_n, known = top.value.log_counts(h)
                yield _terms(ids, n, back, np.where(have, np.where(known, log_n, 0.0) - top.value.log_total, 0.0) + value)
                rest = np.flatnonzero(have & ~known)
                if len(rest):
                    yield _terms(ids.take(pa.array(rest)), None, None, None, h[rest], np.ones(len(rest)))

    packed = d.mapInArrow(pairs, "bucket int, docs array<long>, sizes array<int>, grams binary")
    dealt = packed.repartitionById(n_buckets, "bucket")
    terms = stored(dealt.mapInArrow(score, TERMS).unionByName(d.mapInArrow(firsts, TERMS)), "terms")
    left = (terms.filter(F.col("word").isNotNull()).groupBy("doc_id", "word").agg(F.sum("weight").alias("weight")).join(counts, "word")
            .select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_backoff"), (F.col("weight") * F.log("n")).alias("score")))
    parts = terms.filter(F.col("word").isNull()).select("doc_id", "n_words", "n_backoff", "score").unionByName(left)
    return (parts.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("n_words", "n_backoff", "score")))
            .withColumn("mean_score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))))


ORACLE = rf"""
WITH w AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
ww AS (SELECT id, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM w),
p AS (SELECT id, doc_id, pos, word, lag(word) OVER (PARTITION BY id ORDER BY pos) AS prev FROM ww),
c1 AS (SELECT word, count(*) AS n FROM ww GROUP BY word),
c2 AS (SELECT prev, word, count(*) AS n FROM p WHERE prev IS NOT NULL GROUP BY prev, word),
total AS (SELECT sum(n) AS t FROM c1),
s AS (
  SELECT p.doc_id, p.prev IS NOT NULL AND c2.n < {MIN_COUNT} AS back,
         CASE WHEN p.prev IS NULL THEN ln(u.n / t::DOUBLE) WHEN c2.n >= {MIN_COUNT} THEN ln(c2.n / v.n::DOUBLE)
              ELSE ln({BACKOFF} * u.n / t) END AS score
  FROM p JOIN c1 u USING (word) LEFT JOIN c1 v ON v.word = p.prev LEFT JOIN c2 ON c2.prev = p.prev AND c2.word = p.word, total)
SELECT d.doc_id, count(s.score) AS n_words, count(*) FILTER (WHERE back) AS n_backoff, round(coalesce(sum(s.score), 0.0), 4) AS score,
       round(sum(s.score) / count(s.score), 4) AS mean_score
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN s ON d.doc_id IS NOT DISTINCT FROM s.doc_id GROUP BY d.doc_id"""
