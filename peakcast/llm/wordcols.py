"""Column expressions on words (no Python on the executors): cutting a text and hashing words at a position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words are runs of characters other than these (every ASCII character that is no letter and no digit).
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Its lower case is the ASCII letter k; folding must not make an ASCII word of it.
KELVIN = "K"


def ascii_words(text: Column) -> Column:
    """Words of a text (null: none). ASCII letters are folded; a text's other letters are folded too, which
    never changes where words begin or whether one equals an ASCII word."""
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("é")))
    return F.array_remove(F.split(folded, NO_WORD), "")


def hash_at(words: Column, pos: Column, offsets: tuple[int, ...], kind: int) -> Column:
    """64-bit hash of the words at ``pos + offset``, null where the last of them is past the end. ``kind`` keeps
    different offset patterns apart."""
    h = F.xxhash64(F.lit(kind), *(F.get(words, pos + o) for o in offsets))
    return F.when(pos + offsets[-1] < F.size(words), h)
