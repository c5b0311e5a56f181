"""Token counts by a map-side two-tier lookup.

Tier 1 is a compact table (pre-token -> number of tokens) of frequent pre-tokens, broadcast to the workers;
tier 2 is a cache in each Python worker, filled by encoding the pre-tokens that tier 1 misses. Pre-tokens
never leave the task that cut them: no shuffle. Both tiers only save work: a count never depends on them.

Tier 1 holds the pre-tokens that make up at least 1 / ``table_size`` of all pre-tokens of all documents, so it has at most
``table_size`` entries. Each task counts its own documents' pre-tokens and passes on those with that share of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, stored

# The vocabulary file's pre-token pattern, written out for the characters that PLAIN allows.
LETTER = "a-zªµºß-öø-ɏ"
NUMBER = "0-9²³¹¼½¾"
PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")

#: Texts of these characters alone are cut here: all of them are their own composed form, and their lower
#: case and classes are the same in any Unicode version. Other texts are encoded whole by the library.
PLAIN = re.compile("[\t\n\r -~¡-įı-ɏ]*")

BLANKS = re.compile("[\t\n\r ]+")

#: Entries a worker's cache may hold before it starts anew, and characters of a piece that either tier holds.
CACHE_ENTRIES, LONGEST = 400_000, 64
#: Different pre-tokens that a task counts at a time; beyond, the counts are cut to COUNTED // 4 of them.
COUNTED = 400_000


class Lengths(dict):
    """Pre-token -> token count; a miss is encoded and, unless it is long, kept."""

    def __init__(self, encode, frequent: dict[str, int]):
        super().__init__(frequent)
        self.encode, self.frequent = encode, frequent

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece, add_special_tokens=False).ids)
        if len(piece) > LONGEST:
            return n
        if len(self) >= CACHE_ENTRIES + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        self[piece] = n
        return n


class TokenCounter:
    """Counts the tokens of one text exactly as the library does."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.encode = tok.encode
        self.special = [t.content for t in tok.get_added_tokens_decoder().values()]
        self.lengths = Lengths(tok.encode, frequent)

    def pieces(self, text: str) -> list[str] | None:
        """Parts of the text whose token counts add up to the text's, or None for a text with special strings, which only
        the library may cut. Runs between blanks of PLAIN characters are cut into pre-tokens; any other run is one
        part, since neither composition nor a pre-token passes a blank."""
        if any(s in text for s in self.special):
            return None
        if PLAIN.fullmatch(text):
            return PRE_TOKEN.findall(text.lower())
        plain, other = [], []
        for run in BLANKS.split(text):
            (plain if PLAIN.fullmatch(run) else other).append(run)
        return PRE_TOKEN.findall(" ".join(plain).lower()) + other

    def count(self, text: str) -> int:
        found = self.pieces(text)
        if found is None:
            return len(self.encode(text, add_special_tokens=False).ids)
        return sum(map(self.lengths.__getitem__, found))


_WORKER: dict[tuple, TokenCounter] = {}


def _counter(path: str, shared) -> TokenCounter:
    """One counter for each vocabulary and table in a Python worker, kept from task to task."""
    key = (path, getattr(shared, "id", id(shared)))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TokenCounter(path, shared.value if shared else {})
    return _WORKER[key]


def cut_counts(n: Counter, most: int) -> None:
    """Leave ``most`` entries at most, each lowered by the count of the next one: what is lost of any entry is at most
    1 / (most + 1) of what was counted."""
    low = sorted(n.values(), reverse=True)[most]
    for p in [p for p, c in n.items() if c <= low]:
        del n[p]
    for p in n:
        n[p] -= low


def frequent_pieces(docs: DataFrame, path: str, table_size: int) -> DataFrame:
    """(piece, n): the pre-tokens of at most LONGEST characters with at least 1 / ``table_size`` of all pre-tokens of all
    documents, at most ``table_size`` rows. Each task counts in bounded memory and passes on only what has that share
    of its own pre-tokens, so n may fall short by 1 / table_size + 4 / COUNTED of all; a piece above both shares together
    is never missed."""
    def count(batches):
        c, n, total = _counter(path, None), Counter(), 0
        for b in batches:
            for i in range(len(b)):
                found = c.pieces(b.column(0)[i].as_py()) or ()
                total += len(found)
                n.update(found)
                if len(n) > COUNTED:
                    cut_counts(n, COUNTED // 4)
        kept = [(p, k) for p, k in n.items() if k * table_size >= total and len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([None, *(p for p, _ in kept)], pa.string()),
                                          pa.array([total, *(k for _, k in kept)], pa.int64())], names=["piece", "n"])

    texts = doc_text(docs).select("text").filter(F.col("text").isNotNull())
    sums = stored(texts.mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")), "pieces")
    total = sums.agg(F.max(F.when(F.col("piece").isNull(), F.col("n")))).first()[0] or 0
    return sums.filter(F.col("piece").isNotNull() & (F.col("n") * table_size >= total))


def frequent_lengths(docs: DataFrame, path: str, table_size: int = 50_000) -> dict[str, int]:
    """Tier 1: token counts of the frequent pre-tokens, ``table_size`` of LONGEST characters at most whatever the corpus."""
    c = TokenCounter(path, {})
    return {r["piece"]: c.lengths[r["piece"]] for r in frequent_pieces(docs, path, table_size).collect()}


def token_counts(docs: DataFrame, path: str, limit: int = 2048, table_size: int = 50_000) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``): one row per input row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null ids each give their row; an empty
    table gives no rows. ``path`` is a vocabulary file that every worker can open.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_lengths(docs, path, table_size))

    @F.pandas_udf("long")
    def n_tokens(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = _counter(path, shared)
        for texts in column:
            yield pd.Series([c.count(t) if t else 0 for t in texts], dtype="int64")

    d = doc_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return (d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n_tokens("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
