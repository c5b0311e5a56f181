"""Near-duplicate documents by min-max hashing.

Each of K permutations of the shingle hashes gives two signature values, its minimum and its maximum, so a
signature of 2K values costs K evaluations a shingle. Both agree between two sets with a probability of their
Jaccard similarity. Values are banded; documents that share a band are candidates, and a candidate pair is
confirmed on the full shingle sets.

* Equal sets are one class from the start (their number never matters afterwards).
* A bucket of m classes first proposes m - 1 pairs, each class with the bucket's leader, the class that meets others
  most often (of near copies of a text, the one closest to it). A class tests its most frequent leaders. Confirmed
  links merge classes into components.
* What is left are links between different components; links inside a component would change nothing. Classes in
  buckets that hold several components are joined on the prefixes of their sets: with shingles in one order for all,
  rarest first, two sets that meet the threshold share one of the first n - ceil(threshold * n) + 1 of either, and
  enough can follow it in both. So no link is given up, and near copies that differ too much, each in its own way, don't meet as pairs at all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import broadcast_if_small, doc_text, stored
from .textio import SPACE_TABLE, U, chunks, mix, shingles, words

WORDS, ROWS = 5, 4
#: A pair at the threshold itself shares no band with at most this probability.
MISS = 1e-6
#: Ids (8 bytes each) up to which the candidates' ids are broadcast to fetch their texts.
BROADCAST_IDS = 2_000_000
LEADERS = 2
#: Slots of the shingle counts that give the order of shingles: its broadcast has 4 bytes each.
SLOTS = 1 << 21


def n_bands(percent: int) -> int:
    """Bands of ROWS values for a threshold of ``percent`` / 100."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607)
    a, b = (r.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    return a * U(2) + U(1), b


def distinct_sorted(s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each segment in ascending order, and the segments' new borders."""
    s = s.copy()
    for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
        if j - i > 1:
            s[i:j].sort()
    keep = np.ones(len(s), bool)
    keep[1:] = s[1:] != s[:-1]
    keep[first[:-1][first[:-1] < len(s)]] = True
    at = np.zeros(len(s) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    return s[keep], at[first]


def min_max(s: np.ndarray, first: np.ndarray, bands: int) -> np.ndarray:
    """Band hashes (one row per non-empty segment) of signatures of ROWS * bands values."""
    k = -(-ROWS * bands // 2)
    starts = first[:-1][np.diff(first) > 0]
    values = np.zeros((2 * k, len(starts)), U)
    with np.errstate(over="ignore"):
        for j, (a, b) in enumerate(zip(*_permutations(k))):
            x = s * a + b
            values[j] = np.minimum.reduceat(x, starts)
            values[k + j] = np.maximum.reduceat(x, starts)
        out = np.zeros((bands, len(starts)), U)
        for i in range(bands):
            h = np.full(len(starts), i + 1, U)
            for j in range(ROWS):
                h = mix(h * U(0x9E3779B97F4A7C15) + values[i * ROWS + j])
            out[i] = h
    return out.T


def _lists(rows: np.ndarray, present: np.ndarray, width: int) -> pa.Array:
    """array<long> with a list of ``width`` where ``present``, else an empty one."""
    off = np.zeros(len(present) + 1, np.int32)
    np.cumsum(present * width, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(rows.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, n_shingles, set1, set2 (128 bits that name the shingle set; null if empty), bands."""
    bands = n_bands(percent)

    def work(batches):
        for b in batches:
            for lo, hi, t in chunks(b.column(1)):
                s, first = shingles(words(t, SPACE_TABLE), WORDS)
                s, first = distinct_sorted(s, first)
                n = np.diff(first)
                full = n > 0
                sums = np.zeros((2, len(n)), U)
                if len(s):
                    with np.errstate(over="ignore"):
                        for i in range(2):
                            sums[i, full] = np.add.reduceat(mix(s + U(i * 0x5851F42D + 1)), first[:-1][full])
                sig = min_max(s, first, bands) if len(s) else np.zeros((0, bands), U)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                     *(pa.array(x.view(np.int64), mask=~full) for x in sums), _lists(sig, full, bands)],
                    names=["doc_id", "n_shingles", "set1", "set2", "bands"])

    return doc_text(docs).mapInArrow(work, "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, set1, set2, shingles (distinct hashes): for the documents of candidate pairs."""
    def work(batches):
        for b in batches:
            for lo, hi, t in chunks(b.column(1)):
                s, first = distinct_sorted(*shingles(words(t, SPACE_TABLE), WORDS))
                full = np.diff(first) > 0
                sums = np.zeros((2, len(full)), U)
                if len(s):
                    with np.errstate(over="ignore"):
                        for i in range(2):
                            sums[i, full] = np.add.reduceat(mix(s + U(i * 0x5851F42D + 1)), first[:-1][full])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *(pa.array(x.view(np.int64), mask=~full) for x in sums),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(s.view(np.int64)))],
                    names=["doc_id", "set1", "set2", "shingles"])

    return docs.mapInArrow(work, "doc_id long, set1 long, set2 long, shingles array<long>")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, id, comp, n, rest) for the shingles in each set's prefix, from (id, comp, n, shingles); ``rest`` counts
    the set's shingles from this one on. The order is by how often a shingle's slot occurs in these sets, then by the shingle: counts that share a slot only cost time."""
    spark = sets.sparkSession

    def count(batches):
        n = np.zeros(SLOTS, np.int64)
        for b in batches:
            n += np.bincount(np.asarray(b.column(0).flatten(), np.int64).view(U) & U(SLOTS - 1), minlength=SLOTS)
        at = np.flatnonzero(n)
        for lo in range(0, len(at), 100_000):
            part = at[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(n[part])], names=["slot", "n"])

    got = (sets.select("shingles").mapInArrow(count, "slot int, n long").groupBy("slot")
           .agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).toArrow())  # SLOTS rows at most
    table = np.zeros(SLOTS, np.int32)
    table[np.asarray(got.column("slot"))] = np.asarray(got.column("n"))
    shared = spark.sparkContext.broadcast(table)

    def first(batches):
        for b in (x.slice(lo, 1000) for x in batches for lo in range(0, len(x), 1000)):
            lists = b.column(3)
            flat = np.asarray(lists.flatten(), np.int64).view(U)
            off = np.append(0, np.cumsum(np.asarray(lists.value_lengths(), np.int64)))
            n = np.diff(off)
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((flat, shared.value[flat & U(SLOTS - 1)], owner))
            length = n + (-percent * n // 100) + 1  # n - ceil(percent * n / 100) + 1
            at = np.arange(len(flat)) - off[owner]
            inside = at < length[owner]
            rows = pa.array(owner[inside])
            yield pa.RecordBatch.from_arrays([pa.array(flat[order[inside]].view(np.int64)), *(b.column(i).take(rows) for i in range(3)),
                                              pa.array((n[owner] - at)[inside])], names=["shingle", "id", "comp", "n", "rest"])

    return sets.select("id", "comp", "n", "shingles").mapInArrow(first, "shingle long, id long, comp long, n long, rest long")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, comp) after merging the comps that ``links`` (a, b: comps) connect, as (id, comp).

    Each step hooks a comp to the linked comp of smallest priority, a hash that changes every second step, so
    chains shrink by a constant share and stars in two steps. Links and labels stay tables.
    """
    edges = stored(links.filter(F.col("a") != F.col("b")).distinct(), "edges")
    step = 0
    while not edges.isEmpty():
        def priority(c):
            return F.struct(F.xxhash64(F.lit(step // 2), F.col(c)).alias("p"), F.col(c).alias("c"))
        both = edges.union(edges.select("b", "a"))
        hook = stored(both.groupBy("a").agg(F.min(priority("b")).alias("m"))
                      .select(F.col("a").alias("comp"), F.least("m", F.struct(F.xxhash64(F.lit(step // 2), F.col("a")).alias("p"), F.col("a").alias("c")))["c"].alias("to")), "hook")
        labels = stored(labels.join(hook, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")
        ha, hb = hook.select(F.col("comp").alias("a"), F.col("to").alias("ta")), hook.select(F.col("comp").alias("b"), F.col("to").alias("tb"))
        edges = stored(edges.join(ha, "a").join(hb, "b").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                       .filter(F.col("a") != F.col("b")).distinct(), "edges")
        step += 1
    return labels


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold, and their number of common shingles."""
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    p = pairs.join(x, "a").join(y, "b").select(
        "a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"),
        (F.size("sa") + F.size("sb")).cast("long").alias("both"))
    return p.filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b", "common")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents with 100 * |A and B| >= percent * |A or B| are linked.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat a doc_id are one
    document and give one row: if their texts differ, the document is linked with whatever one of them is linked with,
    and n_shingles is that of the text with the smallest set name (of an empty one only if the id has no other). Rows
    with a null id are never linked: each distinct one gives a row with a null component_id and kept true. An empty
    table gives no rows.
    """
    raw = stored(signatures(docs, percent), "signatures")
    # A hot id is combined before the shuffle; null ids stay apart by their set.
    sig = stored(raw.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", "set1", "set2")
                 .agg(F.min("n_shingles").alias("n_shingles"), F.min("bands").alias("bands")), "texts")
    full = sig.filter(F.col("n_shingles") > 0)
    several = stored(full.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("set1", "set2")).alias("first"))
                     .filter(F.col("c") > 1).select("doc_id", F.col("first.set1").alias("first1"), F.col("first.set2").alias("first2")), "several")
    clashes = not several.isEmpty()
    if clashes:  # further texts of an id get keys of their own
        first = F.col("first1").isNull() | ((F.col("set1") == F.col("first1")) & (F.col("set2") == F.col("first2")))
        full = (full.join(several, "doc_id", "left")
                .withColumn("key", F.when(first, F.col("doc_id")).otherwise(F.xxhash64(F.lit("text"), "doc_id", "set1", "set2"))))
    else:
        full = full.withColumn("key", F.col("doc_id"))
    reps = stored(full.groupBy("set1", "set2")
                  .agg(F.min("key").alias("id"), F.min_by("doc_id", "key").alias("doc"), F.min("doc_id").alias("least"),
                       F.min("n_shingles").alias("n"), F.min("bands").alias("bands")), "classes")
    members = reps.select(F.explode("bands").alias("bucket"), "id", "n")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1)
    members = stored(members.join(shared, "bucket"), "members")
    popular = stored(members.groupBy("id").agg(F.sum("m").alias("met")), "popular")
    wanted = stored(members.select("id").distinct().join(reps.select("id", "doc", "set1", "set2"), "id"), "candidates")
    texts = doc_text(docs).join(broadcast_if_small(wanted.select(F.col("doc").alias("doc_id")).distinct(), BROADCAST_IDS), "doc_id")
    sets = stored(shingle_sets(texts).withColumnRenamed("doc_id", "doc").join(wanted, ["doc", "set1", "set2"])
                  .select("id", "shingles").dropDuplicates(["id"]), "sets")
    labels = wanted.select("id", F.col("id").alias("comp"))
    if clashes:  # each of an id's texts is linked with the first of them: a star, whatever their number
        class_of = reps.select("set1", "set2", "id")
        ends = (full.join(several.select("doc_id"), "doc_id", "left_semi").join(class_of.withColumnRenamed("id", "a"), ["set1", "set2"])
                .join(class_of.select(F.col("set1").alias("first1"), F.col("set2").alias("first2"), F.col("id").alias("b")), ["first1", "first2"])
                .select("a", "b").distinct())
        ends = stored(ends, "same-id")
        ids = labels.select("id").union(ends.select("a")).union(ends.select("b")).distinct()
        labels = components(stored(ids.select("id", F.col("id").alias("comp")), "ids"), ends)
    tested = None

    for proposal in ("leaders", "prefixes"):
        at = members.join(labels, "id")
        # Only buckets that still hold different components go on.
        open_ = at.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter(F.col("x") != F.col("y")).select("bucket")
        at = stored(at.join(open_, "bucket").join(popular, "id"), "open")
        if at.isEmpty():
            break
        near = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
        if proposal == "leaders":
            lead = at.groupBy("bucket").agg(F.min(F.struct((-F.col("met")).alias("h"), F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"))).alias("l")).select("bucket", "l.id2", "l.n2", "l.comp2")
            found = at.join(lead, "bucket").filter((F.col("comp") != F.col("comp2")) & near)
            votes = found.groupBy("id", "id2").agg(F.count(F.lit(1)).alias("votes"))
            top = W.partitionBy("id").orderBy(F.desc("votes"), "id2")
            pairs = votes.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= LEADERS)
        else:
            left = at.groupBy("id").agg(F.min("comp").alias("comp"), F.min("n").alias("n"))
            p = stored(prefixes(sets.join(left, "id"), percent), "prefixes")
            other = p.select("shingle", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("rest").alias("rest2"))
            # From a pair's first common shingle on, both must have as many as the threshold asks them to share.
            enough = F.least("rest", "rest2") * (100 + percent) >= percent * (F.col("n") + F.col("n2"))
            pairs = p.join(other, "shingle").filter((F.col("id") < F.col("id2")) & (F.col("comp") != F.col("comp2")) & near & enough)
        pairs = pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        links = stored(confirmed(pairs, sets, percent).select("a", "b"), "links")
        ends = (links.join(labels.select(F.col("id").alias("a"), F.col("comp").alias("ca")), "a")
                .join(labels.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        labels = components(labels, ends)
        tested = pairs if tested is None else tested.union(pairs)

    least = reps.select("id", "least")
    named = labels.join(least, "id").groupBy("comp").agg(F.min("least").alias("component_id"))
    names = labels.join(named, "comp").select("id", "component_id")
    classes = stored(reps.select("id", "set1", "set2", "least").join(names, "id", "left")
                     .select("set1", "set2", F.coalesce("component_id", "least").alias("component_id")), "named")
    best = F.min(F.struct(F.col("set1").isNull().alias("empty"), "set1", "set2", "n_shingles"))
    out = sig.groupBy("doc_id").agg(best.alias("s")).select("doc_id", "s.n_shingles", "s.set1", "s.set2").join(classes, ["set1", "set2"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    nameless = (raw.filter(F.col("doc_id").isNull()).select("doc_id", "n_shingles", "set1", "set2").distinct()
                .select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    return out.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` (all its columns) with one document of each group of near duplicates, the one of smallest id; rows
    that repeat its id stay. Rows with a null id stay."""
    gone = near_duplicates(docs, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("__doc_id"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__doc_id"], "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
ww AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM w),
g AS (
  SELECT doc_id, n, pos, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
         || ' ' || lead(word, 4) OVER o AS s FROM ww WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
s AS (
  SELECT DISTINCT doc_id, s FROM g WHERE s IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') AS s FROM w WHERE len(w) BETWEEN 1 AND 4),
sz AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sz p ON p.doc_id = x.doc_id JOIN sz q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS to_id FROM documents UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.to_id)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sz z ON z.doc_id = d.doc_id
JOIN (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id) c ON c.id = d.doc_id"""
