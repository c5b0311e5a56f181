"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A window of ``WINDOW`` consecutive words of a benchmark item contaminates a document that has the same window
with at most ``SUBSTITUTIONS`` words replaced. Every such pair of windows agrees on all positions of at least
one of two spaced seeds (fixed masks of six positions that ignore the others; the tests enumerate all
placements of the substitutions), so equal seed hashes find every one. Hits are verified word by word.

Items of fewer than ``WINDOW`` words are sought whole: from ``LOOSE`` words on with one word replaced at most (three seeds
that ignore every third position each, so that one of them ignores the replaced word), shorter ones unchanged, and those of
fewer than ``ANYWHERE`` words, which stand in clean texts as well, only as a document's whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, stored
from .wordcols import ascii_words, hash_at

WINDOW, SUBSTITUTIONS, LOOSE, ANYWHERE = 13, 2, 8, 5
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
#: Windows are verified in blocks of so many start positions, so a long item costs no long slices.
BLOCK = 32
#: Seed rows up to which the benchmark's side is broadcast (16 bytes of key and position and a few more each).
BROADCAST_SEEDS = 1_000_000


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Seeds of an item of ``n`` words, n < WINDOW."""
    if n < LOOSE:
        return [tuple(range(n))]
    return [tuple(i for i in range(n) if i % 3 != j) for j in range(3)]


def _kinds(lengths: set[int]) -> dict[int, tuple[int | None, tuple[int, ...]]]:
    """Seeds by kind, as (item length, None for the masks of windows; positions), for the short items of these lengths."""
    short = [(n, m) for n in sorted(lengths) for m in short_masks(n)]
    return dict(enumerate([*((None, m) for m in MASKS), *short]))


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct items with at least one word: uid, item_id, item_words, n_item."""
    b = benchmark.select(F.col(item_id).cast("long").alias("item_id"), ascii_words(F.col(text)).alias("item_words"))
    return (b.withColumn("n_item", F.size("item_words")).filter(F.col("n_item") > 0)
            .withColumn("uid", F.xxhash64("item_id", "item_words")).dropDuplicates(["uid"]))


def _item_seeds(items: DataFrame, kinds: dict) -> DataFrame:
    """(seed, kind, uid, item_pos): those of long items at all positions, those of short ones at the first."""
    pos, words, n = F.col("pos"), F.col("item_words"), F.col("n_item")
    last = F.greatest(n - min(m[-1] for m in MASKS) - 1, F.lit(0))
    fits = [n >= WINDOW if length is None else (n == length) & (pos == 0) for length, _ in kinds.values()]
    seeds = F.array(*(F.struct(F.lit(k).alias("kind"), F.when(fit, hash_at(words, pos, m, k)).alias("seed"))
                      for (k, (_, m)), fit in zip(kinds.items(), fits)))
    return (items.select("uid", "n_item", "item_words", F.explode(F.when(n >= WINDOW, F.sequence(F.lit(0), last)).otherwise(F.array(F.lit(0)))).alias("pos"))
            .select("uid", pos.alias("item_pos"), F.explode(seeds).alias("s"))
            .select("s.seed", "s.kind", "uid", "item_pos").filter(F.col("seed").isNotNull()))


def _text_seeds(words: DataFrame, kinds: dict) -> DataFrame:
    """``words`` (with an array ``words``) by position and seed: its columns, pos, seed."""
    w, pos = F.col("words"), F.col("pos")
    seeds = []
    for k, (length, m) in kinds.items():
        h = hash_at(w, pos, m, k)
        seeds.append(F.when((pos == 0) & (F.size(w) == length), h) if length and length < ANYWHERE else h)
    return (words.select("*", F.posexplode("words").alias("pos", "word"))
            .select(*words.columns, "pos", F.explode(F.array(*seeds)).alias("seed")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (doc_id, item_id) with a contaminated window: n_windows (pairs of a document window and an item
    window that agree), best_matches (most equal words in one), first_word and last_word (first and last document
    word, from 0, of all these windows).

    Null or empty texts have no windows, rows without a window no row. Identical repeated rows count once; rows of
    one doc_id with different texts are looked at one by one and reported under that id. A null id is reported as
    null. Either table may be empty; items without words contaminate nothing.

    Seeds of the benchmark are broadcast up to BROADCAST_SEEDS, counted first. Beyond, ids and seeds are shuffled and the
    words of documents with hits are fetched afterwards, so no text is sent once for each of its words.
    """
    items = stored(benchmark_items(benchmark), "items")
    lengths = {r[0] for r in items.filter(F.col("n_item") < WINDOW).select("n_item").distinct().collect()}  # 12 at most
    kinds = _kinds(lengths)
    pos, iw = F.col("pos"), F.col("item_words")
    seeds = stored(_item_seeds(items, kinds), "seeds")
    words = doc_text(docs).select("doc_id", ascii_words(F.col("text")).alias("words"))
    few = seeds.count() <= BROADCAST_SEEDS
    if few:
        found = ["doc_id", "words"]
        hits = _text_seeds(words, kinds).join(F.broadcast(seeds), "seed")
    else:
        found = ["text_id"]
        words = words.withColumn("text_id", F.xxhash64("doc_id", "words"))
        hits = _text_seeds(words, kinds).select("text_id", "pos", "seed").filter(F.col("seed").isNotNull()).join(seeds, "seed")
    span = F.lit(None).cast("int")
    for k, (_, m) in kinds.items():
        span = F.when(F.col("kind") == k, F.lit(m[-1] + 1)).otherwise(span)
    last_start = F.col("item_pos")  # starts of the item windows that hold the seed
    first_start = F.greatest(F.col("item_pos") + span - WINDOW, F.lit(0))
    blocks = F.array_distinct(F.array((first_start / BLOCK).cast("int"), (last_start / BLOCK).cast("int")))
    a = F.greatest(F.col("block") * BLOCK, -F.col("diagonal"), F.lit(0))
    part = (hits.select(*found, "uid", (pos - F.col("item_pos")).alias("diagonal"), F.explode(blocks).alias("block"))
            .withColumn("a", a))
    if not few:
        part = part.distinct().join(words.dropDuplicates(["text_id"]), "text_id")
    part = (part.select("doc_id", "uid", "diagonal", "block", "a",
                        F.slice("words", F.col("diagonal") + F.col("a") + 1,
                                F.lit(BLOCK + WINDOW - 1) - (F.col("a") - F.col("block") * BLOCK)).alias("doc_part"))
            .distinct())
    c = part.join(items, "uid")
    item_part = F.slice(iw, F.col("a") + 1, F.size("doc_part"))
    length = F.least(F.lit(WINDOW), F.col("n_item"))
    need = length - F.when(F.col("n_item") >= WINDOW, SUBSTITUTIONS).when(F.col("n_item") >= LOOSE, 1).otherwise(0)
    c = (c.withColumn("agree", F.zip_with(F.slice("doc_part", F.lit(1), F.size(item_part)), item_part, lambda x, y: F.when(x == y, 1).otherwise(0)))
         .withColumn("length", length)
         .withColumn("start", F.explode(F.when(F.size("agree") >= length, F.sequence(F.lit(0), F.size("agree") - length))))
         .filter(F.col("a") + F.col("start") < (F.col("block") + 1) * BLOCK)
         .withColumn("matches", F.aggregate(F.slice("agree", F.col("start") + 1, F.col("length")), F.lit(0), lambda x, y: x + y))
         .filter(F.col("matches") >= need)
         .withColumn("first", F.col("diagonal") + F.col("a") + F.col("start")))
    return (c.groupBy("doc_id", "item_id")
            .agg(F.count(F.lit(1)).alias("n_windows"), F.max("matches").alias("best_matches"),
                 F.min("first").cast("long").alias("first_word"),
                 F.max(F.col("first") + F.col("length") - 1).cast("long").alias("last_word")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (all its columns) without the documents that have a contaminated window. Null and empty texts stay, and so do
    repeated rows of a clean document; with a contaminated text an id goes with all its rows. Rows with a null id are
    kept only if no row with a null id is contaminated."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__doc_id")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["__doc_id"]), "left_anti")


ORACLE = f"""
WITH dw AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos, len(w) AS n FROM (
    SELECT DISTINCT doc_id, regexp_extract_all(lower(replace(coalesce(text, ''), chr(8490), 'é')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents)),
bw AS (
  SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos, len(w) AS n FROM (
    SELECT DISTINCT item_id, regexp_extract_all(lower(replace(coalesce(text, ''), chr(8490), 'é')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark)),
eq AS (SELECT d.doc_id, b.item_id, d.pos - b.pos AS diagonal, b.pos AS q, d.n AS n_doc, b.n AS n_item
       FROM dw d JOIN bw b USING (word)),
hot AS (SELECT doc_id, item_id, diagonal, any_value(n_doc) AS n_doc, any_value(n_item) AS n_item, list(q) AS qs
        FROM eq GROUP BY ALL HAVING count(*) >= any_value(least({WINDOW}, n_item)) - {SUBSTITUTIONS}),
win AS (SELECT doc_id, item_id, diagonal, least({WINDOW}, n_item) AS length, n_doc, n_item, qs,
               unnest(range(0, n_item - least({WINDOW}, n_item) + 1)) AS s FROM hot),
cnt AS (SELECT *, len(list_filter(qs, lambda x: x >= s AND x < s + length)) AS matches FROM win
        WHERE diagonal + s >= 0 AND diagonal + s + length <= n_doc AND (n_item >= {ANYWHERE} OR n_doc = n_item))
SELECT doc_id, item_id, count(*) AS n_windows, CAST(max(matches) AS INTEGER) AS best_matches,
       CAST(min(diagonal + s) AS BIGINT) AS first_word, CAST(max(diagonal + s + length - 1) AS BIGINT) AS last_word
FROM cnt WHERE matches >= length - CASE WHEN n_item >= {WINDOW} THEN {SUBSTITUTIONS} WHEN n_item >= {LOOSE} THEN 1 ELSE 0 END
GROUP BY doc_id, item_id"""
