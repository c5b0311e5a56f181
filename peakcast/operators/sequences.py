"""Within-season mark sequences: day gaps, last-L truncation, (value, gap, wind) arrays, padding.

Plan shape: ``row_number() <= L + 1`` over (key, season) ordered newest first.
Spark turns that filter into a WindowGroupLimit that runs *before* the shuffle,
so every map task sends at most L + 1 rows per season whatever the skew; the
one extra row is the predecessor needed for the oldest kept gap. ``lead`` on the
same window spec gives the previous mark in date order without a second sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import wind_mps
from .clean import ORD

SEQ_FIELDS = ("value", "gap", "wind")


def last_marks(marks: DataFrame, key: str = "fam_key", seqlen: int = 32) -> DataFrame:
    """The last ``seqlen`` marks of each season, each with its day gap to the previous mark.

    Columns: key, season_key, rn (1 = newest), step (0-based position in the left-padded
    [seqlen] array, newest at seqlen-1), value, gap, wind.
    """
    w = Window.partitionBy(key, "season_key").orderBy(F.col("date").desc(), F.col(ORD).desc())
    top = (marks.select(key, "season_key", "date", ORD, "value", "Wind")
           .withColumn("rn", F.row_number().over(w))
           .filter(F.col("rn") <= seqlen + 1))
    gap = F.greatest(F.coalesce(F.datediff(F.col("date"), F.lead("date").over(w)), F.lit(0)), F.lit(0))
    return (top.withColumn("gap", gap.cast("double"))
            .filter(F.col("rn") <= seqlen)
            .select(key, "season_key", "rn", (F.lit(seqlen) - F.col("rn")).alias("step"),
                    F.col("value").cast("double").alias("value"), "gap",
                    wind_mps(F.col("Wind")).alias("wind")))


def season_sequences(marks: DataFrame, key: str = "fam_key", seqlen: int = 32) -> DataFrame:
    """One row per (key, season): ``seq`` = array<struct<value,gap,wind>> oldest first, and its length."""
    rows = last_marks(marks, key, seqlen)
    seq = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("step"), F.col("value"), F.col("gap"), F.col("wind")))),
        lambda x: F.struct(*[x[f].alias(f) for f in SEQ_FIELDS]))
    return rows.groupBy(key, "season_key").agg(seq.alias("seq"), F.count(F.lit(1)).cast("int").alias("length"))


def pad_left(seq_col, seqlen: int = 32):
    """Left-pad a sequence array with zero steps to exactly ``seqlen`` (truncating to the last ``seqlen``)."""
    zero = F.struct(*[F.lit(0.0).alias(f) for f in SEQ_FIELDS])
    n = F.size(seq_col)
    tail = F.when(n > seqlen, F.slice(seq_col, n - seqlen + 1, seqlen)).otherwise(seq_col)
    return F.concat(F.array_repeat(zero, F.greatest(F.lit(seqlen) - F.size(tail), F.lit(0))), tail)
