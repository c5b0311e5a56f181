"""Inspection of a raw mark table: composable filters, counts, top-k, summary, string widths.

Every report is one aggregation (partial + final); top-k uses
``orderBy(...).limit(k)``, which Spark plans as TakeOrderedAndProject (a
per-partition top-k, then a merge), so no task ever holds more than k rows
per partition. Ties are broken by the grouping keys so results are total.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: columns shown in a sample head, in this order (absent ones are skipped).
SHOW_COLS = ["SeasonYear", "SeasonLabel", "Gender", "Division", "School", "Team", "Event", "Athlete",
             "ClassYear", "MarkOrTime", "Wind", "Meet", "MeetDate", "SourceURL"]


def mark_filters(df: DataFrame, *, year: int | None = None, season: str | None = None,
                 gender: str | None = None, school: str | None = None, event: str | None = None,
                 athlete: str | None = None) -> DataFrame:
    """AND of the optional filters; each is skipped when its value is None or its column is absent.

    year: equality; season / gender: case-insensitive equality; school / event / athlete:
    case-insensitive regular-expression search, null never matches.
    """
    preds: list[Column] = []
    if year is not None and "SeasonYear" in df.columns:
        preds.append(F.col("SeasonYear") == F.lit(year))
    for col, v in (("SeasonLabel", season), ("Gender", gender)):
        if v and col in df.columns:
            preds.append(F.lower(F.col(col)) == F.lower(F.lit(v)))
    for col, v in (("School", school), ("Event", event), ("Athlete", athlete)):
        if v and col in df.columns:
            preds.append(F.coalesce(F.col(col).rlike("(?i)" + v), F.lit(False)))
    return df.filter(reduce(lambda a, b: a & b, preds)) if preds else df


def counts_by(df: DataFrame, keys: list[str], top: int, count_col: str = "count") -> DataFrame:
    """Row counts per key combination, the ``top`` largest (ties by key, ascending)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), *[F.col(k).asc_nulls_last() for k in keys]).limit(top))


def summary(df: DataFrame) -> DataFrame:
    """Row count and column count as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def head(df: DataFrame, order_cols: list[str], n: int) -> DataFrame:
    cols = [c for c in SHOW_COLS if c in df.columns]
    return df.orderBy(*order_cols).limit(n).select(*order_cols, *cols)


def max_string_lengths(df: DataFrame, cols: list[str]) -> DataFrame:
    """max(1, longest value) per string column, one row (the fixed-width sizes of the array layout)."""
    return df.agg(*[F.greatest(F.lit(1), F.coalesce(F.max(F.length(c)), F.lit(1))).alias(c) for c in cols])
