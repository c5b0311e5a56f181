"""Approximate nearest neighbours by balanced posting lists.

Centroids come from bisecting a bounded sample into halves of equal size, again and again, so lists are balanced.
They are searched by walking an in-memory graph that links each centroid to its nearest ones. Every vector is
listed at its nearest centroid and, if it lies near a border, at the others whose distance is at most
``1 + BORDER`` times the least (MAX_COPIES at most). A query visits the lists whose centroid's distance is at
most ``1 + REACH`` times that of its nearest one, and LEAST_LISTS lists at least. If these hold fewer ids than
wanted (one id may have many vectors there), it visits four times as many, and so on up to all lists.

Lists and the queries that visit them are cut into blocks of bounded size, and the blocks are joined on the list,
so that a long list is many rows of work. Equal vectors are listed once with their smallest ids: with k results
wanted, no query can need more than the k + 1 smallest.

SAMPLE_FLOATS bounds the sample. There are about as many lists as a list has vectors (the root of their number),
which balances the search for lists against their scans, but a quarter of the sample at most. All vectors are
listed. Recall is measured against brute force in the tests.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

SAMPLE_FLOATS = 2_000_000
BLOCK = 256
#: Results that a task holds before it cuts them down to each query's best.
HELD = 400_000
BORDER, MAX_COPIES, REACH, LEAST_LISTS = 0.1, 8, 0.28, 12
LINKS = 16


@dataclass
class Index:
    """Unit centroids and, for each, the numbers of the centroids it is linked to."""
    centroids: np.ndarray
    links: np.ndarray

    def near(self, x: np.ndarray, ratio: float, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centroid, distance) of the centroids within ``ratio`` times a row's least distance, as the graph finds
        them: from the entry, all found centroids within the ratio are expanded until none is left. Of the others that
        were met on the way, the nearest are added up to ``least`` centroids (all centroids if there are no more)."""
        n, c = len(x), len(self.centroids)
        if least >= c:
            r, k = np.divmod(np.arange(n * c), c)
            return r, k, np.sqrt(np.maximum(2 - 2 * (x @ self.centroids.T), 0)).reshape(-1)
        dist = np.full((n, c), np.inf, np.float32)
        expanded = np.zeros((n, c), bool)
        rows, cols = np.arange(n), np.zeros(n, np.int64)
        while len(rows):
            dist[rows, cols] = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x[rows], self.centroids[cols]), 0))
            front = ~expanded & (dist <= (dist.min(axis=1) * ratio + 1e-9)[:, None])
            r, k = np.nonzero(front)
            expanded[r, k] = True
            reached = np.zeros((n, c), bool)
            reached[np.repeat(r, self.links.shape[1]), self.links[k].reshape(-1)] = True
            rows, cols = np.nonzero(reached & np.isinf(dist))
        keep = dist <= (dist.min(axis=1) * ratio + 1e-9)[:, None]
        first = np.argpartition(dist, min(least, c) - 1, axis=1)[:, :min(least, c)]
        np.put_along_axis(keep, first, True, axis=1)
        r, k = np.nonzero(keep & np.isfinite(dist))
        return r, k, dist[r, k]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest component lies in [0.5, 1): a cosine's products neither
    overflow nor vanish, and its value stays the same to the last bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _units(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def build_index(sample: np.ndarray, lists: int, seed: int = 3) -> Index:
    """Centroids by balanced bisection, and the graph of each one's nearest others (and its neighbours in order of
    bisection, which keeps the graph in one piece)."""
    rng = np.random.default_rng(seed)
    u = _units(sample)
    parts = [np.arange(len(u))]
    while len(parts) < lists and max(map(len, parts)) > 1:
        halves = []
        for ix in parts:
            if len(ix) < 2:
                halves.append(ix)
                continue
            a, b = u[rng.choice(ix, 2, replace=False)]
            for _ in range(6):
                order = np.argsort(-(u[ix] @ (a - b)), kind="stable")
                left, right = ix[order[:len(ix) // 2]], ix[order[len(ix) // 2:]]
                a, b = u[left].mean(axis=0), u[right].mean(axis=0)
            halves += [left, right]
        parts = halves
    means = np.array([u[ix].mean(axis=0) for ix in parts])
    short = np.linalg.norm(means, axis=1) < 1e-12
    means[short] = [u[parts[i][0]] for i in np.flatnonzero(short)] if short.any() else means[short]
    c = _units(means)
    n = len(c)
    links = np.empty((n, min(LINKS, n) + 2), np.int64)
    for lo in range(0, n, 512):
        s = c[lo:lo + 512] @ c.T
        links[lo:lo + 512, :-2] = np.argsort(-s, axis=1, kind="stable")[:, :links.shape[1] - 2]
    links[:, -2], links[:, -1] = (np.arange(n) + 1) % n, (np.arange(n) - 1) % n
    return Index(c.astype(np.float32), links)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def valid_vectors(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v: vectors that take part. Null, empty and zero vectors, vectors with null or non-finite components and
    null ids take none. -0.0 equals 0.0."""
    v = F.transform(F.col(embedding).cast("array<double>"), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    e = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return e.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine & F.exists("v", lambda x: x != 0))


def nearest(embeddings: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine, double precision): each query's k nearest found.

    Queries are the rows for which ``is_query`` (a function of the id column) holds; candidates are all rows but those
    of the query's own id. Ties go to the smaller vec_id; with fewer candidates, all are returned. Rows that repeat an
    id with another vector are candidates by their better score. Vectors must have one length: those whose length is
    not the most frequent one take no part. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    e = stored(valid_vectors(embeddings), "vectors")
    sizes = e.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").head(1)
    width = sizes[0]["n"] if sizes else 1
    e = e.filter(F.size("v") == width)
    small = W.partitionBy("v").orderBy("vec_id")  # the limit below is applied before the shuffle, too
    groups = (e.distinct().withColumn("r", F.row_number().over(small)).filter(F.col("r") <= k + 1)
              .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))  # k + 1 ids at most
    groups = stored(groups, "groups")
    n = groups.count()
    wanted = max(1, min(n, SAMPLE_FLOATS // width))
    sample = groups.orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(wanted).select("v").toArrow()  # the documented bound
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = _vectors(sample.column("v").combine_chunks())
    lists = 1 << max(0, round(np.log2(max(1, min(np.sqrt(n), len(sample) / 4)))))
    shared = spark.sparkContext.broadcast(build_index(sample, lists))

    def listed(ratio: float, copies: int | None, least: int = 1):
        def work(batches):
            for b in batches:
                for lo in range(0, len(b), 512):
                    part = b.slice(lo, 512)
                    x = _units(_vectors(part.column("v"))).astype(np.float32)
                    r, c, d = shared.value.near(x, ratio, least)
                    if copies is not None:
                        order = np.lexsort((c, d, r))
                        r, c = r[order], c[order]
                        first = np.searchsorted(r, np.arange(len(x)))
                        keep = np.arange(len(r)) - first[r] < copies
                        r, c = r[keep], c[keep]
                    taken = part.take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), *taken.columns], names=["list", *taken.schema.names])
        return work

    def blocks(rows: DataFrame, name: str, *fields: str) -> DataFrame:
        """Rows of a list in blocks of about BLOCK: the number of blocks follows the list's counted size."""
        rows = stored(rows, name)
        count = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
        salted = rows.join(count, "list").withColumn("part", F.pmod(F.xxhash64(*fields), F.col("parts")))
        return salted.groupBy("list", "part").agg(F.collect_list(F.struct(*fields)).alias(name)).drop("part")

    postings = blocks(groups.mapInArrow(listed(1 + BORDER, MAX_COPIES), "list int, v array<double>, ids array<long>"), "entries", "v", "ids")
    q = e.filter(is_query(F.col("vec_id"))).distinct().select("v", F.col("vec_id").alias("query_id"))

    def visits(q: DataFrame, least: int) -> DataFrame:
        return blocks(q.mapInArrow(listed(1 + REACH, None, least), "list int, v array<double>, query_id long"), "visitors", "v", "query_id")

    def best_of(parts):
        """The k best results of each query, of several arrays of (query, vec_id, score)."""
        q, v, x = (np.concatenate(col) for col in zip(*parts))
        order = np.lexsort((-x, v, q))
        q, v, x = q[order], v[order], x[order]
        again = np.zeros(len(q), bool)  # a vector met in several lists
        again[1:] = (q[1:] == q[:-1]) & (v[1:] == v[:-1])
        q, v, x = q[~again], v[~again], x[~again]
        order = np.lexsort((v, -x, q))
        q, v, x = q[order], v[order], x[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[keep], v[keep], x[keep]

    def scan(batches):
        held, size = [], 0
        for b in batches:
            for i in range(len(b)):
                ent, vis = b.column("entries")[i].values, b.column("visitors")[i].values
                x, y = _scaled(_vectors(ent.field("v"))), _scaled(_vectors(vis.field("v")))
                ids = ent.field("ids")
                owner = np.repeat(np.arange(len(ids)), np.diff(np.asarray(ids.offsets)))
                flat = np.asarray(ids.flatten(), np.int64)
                by_id = np.argsort(flat, kind="stable")
                own, first = np.unique(flat[by_id], return_index=True)  # an id may have several vectors in a block
                scores = (y @ x.T) / (np.linalg.norm(y, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :])
                for qid, s in zip(np.asarray(vis.field("query_id"), np.int64), scores):
                    s = np.maximum.reduceat(s[owner][by_id], first)  # each id's best score, before the cut to k
                    best = np.lexsort((own, -s))
                    best = best[own[best] != qid][:k]
                    held.append((np.full(len(best), qid), own[best], s[best]))
                    size += len(best)
                if size >= HELD:
                    held = [best_of(held)]
                    size = len(held[0][0])
                    if size >= HELD // 2:  # too many queries to hold
                        yield from results(held.pop())
                        size = 0
        if held:
            yield from results(best_of(held))

    def results(part):
        for lo in range(0, len(part[0]), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(col[lo:lo + 10_000]) for col in part], names=["query_id", "vec_id", "score"])

    def search(q: DataFrame, least: int) -> DataFrame:
        found = (postings.join(visits(q, least), "list").select("entries", "visitors")
                 .mapInArrow(scan, "query_id long, vec_id long, score double"))
        return stored(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "found")

    ids = e.select("vec_id").distinct().limit(k + 1).count()
    least, best = LEAST_LISTS, search(q, LEAST_LISTS)
    while least < lists:  # the lists near a query may hold too few ids, if one has many vectors there
        full = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k, ids - 1)).select("query_id")
        short = stored(q.join(full, "query_id", "left_anti").select("v", "query_id"), "short")
        if ids < 2 or not short.head(1):
            break
        least *= 4
        best = best.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(search(short, least))
    top = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
