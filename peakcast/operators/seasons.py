"""Season-level aggregates: oriented peaks, group attributes, modal event, lengths, next-season targets.

Plan shape. Level 1 runs over every mark and groups by (key, season, event, attributes) with
fixed-width aggregates only (count, min / max of the value, the first position, the orientation
of the first row): with a packed numeric position this is a hash aggregate whose map-side partial
step combines a hot key before the shuffle. The "value of the first row" picks (orientation,
attributes, modal event with ties to the earliest first appearance, then the name) are then
resolved over the level-1 output, which has about one row per season and event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import next_season_key, season_label_order
from .clean import ORD

SEASON_ATTRS = ("SeasonYear", "SeasonLabel", "Gender", "family")


def _first_non_null(c: str, order: Column) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))


def _level1(marks: DataFrame, keys: list[str]) -> DataFrame:
    return marks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(ORD).alias("_o"),
        F.min("value").alias("_mn"), F.max("value").alias("_mx"),
        F.min_by("is_time", F.col(ORD)).alias("_t"))


def season_aggregate(marks: DataFrame, key: str = "fam_key", attrs=SEASON_ATTRS,
                     seqlen: int = 32, event_col: str = "Event") -> DataFrame:
    """One row per (key, season): peak_value, is_time, attributes, n_marks, length, event_used."""
    attrs = list(attrs)
    l1 = _level1(marks, [key, "season_key", event_col, *attrs])
    # per event: totals, first appearance, and each attribute's first non-null value with its position
    l2 = l1.groupBy(key, "season_key", event_col).agg(
        F.sum("_n").alias("_n"), F.min("_o").alias("_o"), F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx"),
        F.min_by("_t", F.col("_o")).alias("_t"),
        *[F.struct(_first_non_null(a, F.col("_o")).alias("v"),
                   F.min(F.when(F.col(a).isNotNull(), F.col("_o"))).alias("o")).alias(f"_a_{a}") for a in attrs])
    l3 = l2.groupBy(key, "season_key").agg(
        F.min_by("_t", F.col("_o")).alias("is_time"),
        F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx"), F.sum("_n").alias("n_marks"),
        F.min_by(F.col(event_col), F.struct(-F.col("_n"), F.col("_o"), F.col(event_col))).alias("event_used"),
        *[F.min_by(F.col(f"_a_{a}.v"), F.col(f"_a_{a}.o")).alias(a) for a in attrs])
    return l3.select(
        key, "season_key", *attrs, "is_time",
        F.when(F.col("is_time"), F.col("_mn")).otherwise(F.col("_mx")).alias("peak_value"),
        F.col("n_marks").cast("long").alias("n_marks"),
        F.least(F.col("n_marks"), F.lit(seqlen)).cast("int").alias("length"),
        "event_used",
    )


def family_season_peaks(marks: DataFrame, key: str = "fam_key", attrs=SEASON_ATTRS) -> DataFrame:
    """Oriented season peak (min for times, max for distances) with first-row attributes."""
    attrs = list(attrs)
    l1 = _level1(marks, [key, "season_key", *attrs])
    agg = l1.groupBy(key, "season_key").agg(
        F.min_by("_t", F.col("_o")).alias("is_time"),
        F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx"),
        *[_first_non_null(a, F.col("_o")).alias(a) for a in attrs],
    )
    return agg.select(key, "season_key", *attrs, "is_time",
                      F.when(F.col("is_time"), F.col("_mn")).otherwise(F.col("_mx")).alias("peak_value"))


def next_season_targets_join(peaks: DataFrame, key: str = "fam_key") -> DataFrame:
    """Season joined to the same-label season of the next year (inner: seasons without one drop out)."""
    nxt = peaks.select(F.col(key).alias("_k"), F.col("SeasonYear").alias("_y"),
                       F.col("SeasonLabel").alias("_l"), F.col("peak_value").alias("y_next"))
    cond = ((F.col(key) == F.col("_k")) & ((F.col("SeasonYear") + 1) == F.col("_y"))
            & (F.col("SeasonLabel") == F.col("_l")))
    return (peaks.join(nxt, cond, "inner").drop("_k", "_y", "_l")
            .withColumn("next_season_key", next_season_key(F.col("SeasonYear"), F.col("SeasonLabel"))))


def next_season_targets_frame(peaks: DataFrame, key: str = "fam_key") -> DataFrame:
    """Same result as the join, as a range frame over (key, label) ordered by year: no self-join."""
    w = Window.partitionBy(key, "SeasonLabel").orderBy("SeasonYear").rangeBetween(1, 1)
    return (peaks.withColumn("y_next", F.first("peak_value", ignorenulls=True).over(w))
            .filter(F.col("y_next").isNotNull())
            .withColumn("next_season_key", next_season_key(F.col("SeasonYear"), F.col("SeasonLabel"))))


def season_index(seasons: DataFrame, key: str = "fam_key") -> DataFrame:
    """Season position inside a key: by year, then label order (unknown labels last)."""
    w = Window.partitionBy(key).orderBy(F.col("SeasonYear"),
                                        season_label_order(F.col("SeasonLabel")).asc_nulls_last(),
                                        F.col("SeasonLabel"))
    return seasons.withColumn("season_idx", F.row_number().over(w))
