"""Mixing sources to target weights with soft membership.

A classifier learned from labelled rows gives each document's posterior over domains, p. With n tokens and rate r
(how many times the document is taken), domain d expects sum(n r p_d) tokens. Rates are the nonnegative least
squares fit of these totals to the targets, found by projected gradient from r = 1: every step moves all rates
against the gradient and sets negative ones to 0. Residuals are weighted by the inverse of each domain's tokens
and rates scaled by document length, which makes a step of 1 safe and leaves the rate a function of p alone.

Only the residuals (one number per domain) reach the driver. A document's rate after t steps follows from p and
the t residuals sent so far, so no table of rates is kept between steps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MAX_GROUPS, doc_text, one_text, smallest_by_hash, stored
from .textio import SPACE_TABLE, U, Texts, chunks, words

BITS = 16
#: Labelled documents that the classifier is fitted on for each domain, at most (those of smallest id hash).
MAX_TRAIN = 1500
STEPS, TOLERANCE = 60, 1e-5


@dataclass
class Domains:
    """Multinomial word model: log probabilities by domain and hashed word, and log shares of the domains."""
    names: list[str]
    log_p: np.ndarray
    log_share: np.ndarray

    def posteriors(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, posterior rows) of texts. The log likelihood is divided by the root of the length, since words of
        a text are not independent; a text without words has the domains' shares."""
        w = words(t, SPACE_TABLE)
        n = np.diff(w.first)
        run = np.zeros((len(self.names), len(w.hashes) + 1))
        np.cumsum(self.log_p[:, (w.hashes >> U(64 - BITS)).astype(np.int64)], axis=1, out=run[:, 1:])
        s = (run[:, w.first[1:]] - run[:, w.first[:-1]]) / np.sqrt(np.maximum(n, 1)) + self.log_share[:, None]
        e = np.exp(s - s.max(axis=0))
        return n, (e / e.sum(axis=0)).T


def learn(docs: DataFrame, labelled: DataFrame, max_train: int = MAX_TRAIN) -> Domains:
    """The classifier from ``labelled`` (doc_id, domain): null ids and domains don't count; a document teaches once in each
    of its domains, however often it stands there. More than MAX_GROUPS domains are an error."""
    known = (labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain"))
             .filter(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()))
    share = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).limit(MAX_GROUPS + 1).collect()}
    if len(share) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} domains: the model would not be bounded")
    names = sorted(share)
    ids = smallest_by_hash(known, "domain", "doc_id", max_train)

    def work(batches):
        for b in batches:
            who = np.asarray(b.column(0).to_pylist(), object)
            for lo, hi, t in chunks(b.column(1)):
                w = words(t, SPACE_TABLE)
                slot = (w.hashes >> U(64 - BITS)).astype(np.int64)
                owner = np.repeat(who[lo:hi], np.diff(w.first))
                for name in sorted(set(who[lo:hi])):
                    n = np.bincount(slot[owner == name], minlength=1 << BITS)
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))],
                                                     names=["domain", "slot", "n"])

    texts = one_text(doc_text(docs).join(F.broadcast(ids), "doc_id"), ["domain", "doc_id"])
    rows = (texts.select("domain", "text").mapInArrow(work, "domain string, slot int, n long")
            .groupBy("domain", "slot").agg(F.sum("n").alias("n")).toPandas())
    counts = np.full((len(names), 1 << BITS), 0.1)
    if len(rows):
        counts[np.searchsorted(names, rows["domain"]), rows["slot"]] += rows["n"]
    total = sum(share.values())
    return Domains(names, np.log(counts / counts.sum(axis=1, keepdims=True)), np.log([share[x] / total for x in names]))


def rates(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the steps: each lowers a rate by the posterior mean of the step's weighted residuals, to 0 at least."""
    r = np.ones(len(p))
    for v in steps:
        r = np.maximum(r - p @ v, 0.0)
    return r


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, width)


def _member(docs: DataFrame, model: Domains):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n: bigint, p: array<double>>")
    def member(column: pa.Array) -> pa.Array:
        parts = [shared.value.posteriors(t) for _, _, t in chunks(column)]
        n = np.concatenate([x[0] for x in parts]) if parts else np.zeros(0, np.int64)
        p = np.concatenate([x[1] for x in parts]) if parts else np.zeros((0, len(shared.value.names)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.reshape(-1)))
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), lists], names=["n", "p"])

    return member


@dataclass
class Mix:
    """The fit: domains, targets and expected totals in tokens, and the steps that give a document's rate."""
    model: Domains
    targets: np.ndarray
    totals: np.ndarray
    steps: list[np.ndarray]

    @property
    def residual(self) -> float:
        """Largest difference of a domain's expected total and its target, as a share of all tokens of the targets. Above
        TOLERANCE, STEPS steps did not reach the targets (they may be out of reach)."""
        return float(np.abs(self.totals - self.targets).max(initial=0.0) / max(self.targets.sum(), 1.0))

    def rate(self, p: Column) -> Column:
        steps, width = self.steps, len(self.model.names)

        @F.arrow_udf("double")
        def rate(column: pa.Array) -> pa.Array:
            return pa.array(rates(_matrix(column, width), steps))

        return rate(p)


def fit(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0,
        max_train: int = MAX_TRAIN) -> Mix | None:
    """Fit rates whose expected domain token totals match ``weights`` (shares of ``budget`` times all tokens; default:
    in proportion to the root of each domain's tokens). None if no row is labelled. A domain without a weight
    has target 0; a domain of which no document has a trace cannot be matched and is left out of the fit."""
    model = learn(docs, labelled, max_train)
    width = len(model.names)
    if not width:
        return None
    table = stored(doc_text(docs).select(_member(docs, model)(F.col("text")).alias("m")).select("m.n", "m.p"), "members")

    def totals(steps: list[np.ndarray]) -> np.ndarray:
        def work(batches):
            for b in batches:
                p = _matrix(b.column(1), width)
                sums = (np.asarray(b.column(0), float) * rates(p, steps)) @ p
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(sums)], names=["d", "tokens"])

        out = np.zeros(width)
        for r in table.mapInArrow(work, "d int, tokens double").groupBy("d").agg(F.sum("tokens").alias("tokens")).collect():  # a row per domain
            out[r["d"]] = r["tokens"]
        return out

    size = totals([])
    if weights is None:
        share = np.sqrt(size)
    else:
        share = np.array([max(float(weights.get(x, 0.0)), 0.0) for x in model.names])
    targets = share / share.sum() * size.sum() * budget if share.sum() > 0 else np.zeros(width)
    scale = np.divide(1.0, size, out=np.zeros(width), where=size > 0)
    steps, now = [], size
    for _ in range(STEPS):
        left = np.where(size > 0, now - targets, 0.0)
        if np.abs(left).max(initial=0.0) <= TOLERANCE * max(size.sum(), 1.0):
            break
        steps.append(left * scale)
        now = totals(steps)
    return Mix(model, targets, now, steps)


def _copies(rate: Column, *key: Column | str) -> Column:
    """Whole copies of a rate: its floor, and one more with the fraction's probability by a hash of the key."""
    u = F.pmod(F.xxhash64(F.lit("copies"), *key), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """doc_id, n_tokens, domain (of the largest posterior), p_domain, rate, copies, fit_steps, fit_residual (``Mix.residual``;
    the last two are the same everywhere): one row per input row.

    Null and empty texts have no tokens and the domains' shares as posterior. Repeated rows get the same rate each.
    Without labelled rows, domain and p_domain are null and every rate is ``budget``. An empty table: no rows.
    """
    m = fit(docs, labelled, weights, budget)
    d = doc_text(docs)
    if m is None:
        n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
        got = d.select("doc_id", n.alias("n_tokens"), F.lit(None).cast("string").alias("domain"),
                       F.lit(None).cast("double").alias("p_domain"), F.lit(float(budget)).alias("rate"))
    else:
        names = F.array(*map(F.lit, m.model.names))
        got = d.select("doc_id", _member(docs, m.model)(F.col("text")).alias("m"))
        got = got.select("doc_id", "m", F.array_max("m.p").alias("p_domain"), m.rate(F.col("m.p")).alias("rate"))
        got = got.select("doc_id", F.col("m.n").alias("n_tokens"), F.get(names, (F.array_position("m.p", F.col("p_domain")) - 1).cast("int")).alias("domain"),
                         "p_domain", "rate")
    return (got.withColumn("copies", _copies(F.col("rate"), "doc_id")).withColumn("fit_steps", F.lit(0 if m is None else len(m.steps)))
            .withColumn("fit_residual", F.lit(0.0 if m is None else m.residual)))


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """``docs`` (all its columns) with mix_rate and mix_copy: each row as often as its rate says (copy 1, 2, ...), rows
    without a copy gone. Null and empty texts have the domains' shares as posterior, and so a rate like others; repeated
    rows are copied each; columns of these two names are replaced. An empty table: no rows."""
    m = fit(docs, labelled, weights, budget)
    text = F.col("text").cast("string")
    rate = F.lit(float(budget)) if m is None else m.rate(_member(docs, m.model)(text)["p"])
    return (docs.withColumn("mix_rate", rate)
            .withColumn("mix_copy", F.explode(F.when(_copies(F.col("mix_rate"), F.col("doc_id")) > 0,
                                                     F.sequence(F.lit(1), _copies(F.col("mix_rate"), F.col("doc_id")))))))


def languages(docs: DataFrame) -> DataFrame:
    """The labelled table of the query and the pipeline: a document's language as its domain, where it is known."""
    return docs.select(F.col("doc_id"), F.col("lang").alias("domain"))
