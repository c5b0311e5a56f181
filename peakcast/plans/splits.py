"""Queries of the splits: which row goes where, not only how many do."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators.seasons import family_season_peaks, next_season_targets_join
from ..operators.training import MIN_TRAIN_PER_EVENT, SPLIT_SEED, inverse_z, task_counts, task_split, time_split
from . import core
from . import oracle_sql as O
from .registry import SQL, TRAIN_CTES, WINDOW_CTES, register


def _shuffled(source: str, group: str, key: str) -> str:
    """SQL: rows of ``source`` with their place r in the seeded shuffle of their group, and its size n."""
    return f"""
shuffled AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY md5({key} || ':' || season_key || ':{SPLIT_SEED}'), {key}, season_key) - 1 AS r,
         count(*) OVER (PARTITION BY {group}) AS n
  FROM {source})"""


def _samples(spark, sf):
    return core.materialize(core.samples(spark, sf, with_seq=False), "samples")


@register("w9_fallback_split_rows", O.with_ctes(*WINDOW_CTES, _shuffled("samples", "Gender", "fam_key"), body="""
SELECT fam_key, season_key, Gender, CASE WHEN r < floor(0.8 * n) THEN 'train' ELSE 'val' END AS split FROM shuffled"""))
def w9_fallback_split_rows(spark, sf):
    """No gender has a training year: 80 / 20 by the seeded shuffle, row by row."""
    split = time_split(_samples(spark, sf), train_max_year=1900, valid_year=1901)
    return split.select("fam_key", "season_key", "Gender", "split")


_LATE = "NOT (Gender = 'Women' AND SeasonLabel = 'Outdoors' AND SeasonYear <= 2022)"


@register("w9_label_fallback_rows", O.with_ctes(*WINDOW_CTES, f"late AS (SELECT * FROM samples WHERE {_LATE})",
                                                _shuffled("late", "Gender, SeasonLabel", "fam_key"), body="""
SELECT fam_key, season_key, Gender, SeasonLabel,
       CASE WHEN NOT bool_or(SeasonYear <= 2022) OVER (PARTITION BY Gender, SeasonLabel)
            THEN CASE WHEN r < floor(0.7 * n) THEN 'train' WHEN r < floor(0.85 * n) THEN 'val' ELSE 'test' END
            WHEN SeasonYear <= 2022 THEN 'train' WHEN SeasonYear = 2023 THEN 'val' WHEN SeasonYear >= 2024 THEN 'test' END AS split
FROM shuffled"""))
def w9_label_fallback_rows(spark, sf):
    """Of the (gender, season label) units one is without a training year: it is split 70 / 15 / 15 by the seeded
    shuffle, the others by year."""
    split = time_split(_samples(spark, sf).filter(_LATE), train_max_year=2022, valid_year=2023, test_min_year=2024,
                       group=("Gender", "SeasonLabel"), fallback=(0.7, 0.85))
    return split.select("fam_key", "season_key", "Gender", "SeasonLabel", "split")


_M3 = SQL["m3_event_task_metrics"]
_TARGET_CTES = _M3[len("WITH "):_M3.index("models AS (")].rstrip().rstrip(",")


@register("w9_task_fallback_rows", O.with_ctes(_TARGET_CTES, "plain AS (SELECT * EXCLUDE (split) FROM targets)",
                                               _shuffled("plain", "event, Gender, SeasonLabel", "key"), f"""
timed AS (
  SELECT *, count(*) FILTER (WHERE SeasonYear <= 2020) OVER (PARTITION BY event, Gender, SeasonLabel) AS n_train,
         greatest({MIN_TRAIN_PER_EVENT}, floor(0.7 * n)) AS cut FROM shuffled)""", body=f"""
SELECT key, season_key, event, Gender, SeasonLabel,
       CASE WHEN n_train < {MIN_TRAIN_PER_EVENT}
            THEN CASE WHEN r < cut THEN 'train' WHEN r < floor(0.85 * n) THEN 'val' ELSE 'test' END
            WHEN SeasonYear <= 2020 THEN 'train' WHEN SeasonYear = 2021 THEN 'val' WHEN SeasonYear >= 2022 THEN 'test' END AS split
FROM timed WHERE n_train >= {MIN_TRAIN_PER_EVENT} OR cut < n"""))
def w9_task_fallback_rows(spark, sf):
    """Tasks of few training rows are split at random (at least the minimum, else 70 %, to train; up to 85 % to
    validation); tasks that training would take whole are left out."""
    peaks = family_season_peaks(core.prepared(spark, sf, variant="event"), key="key",
                                attrs=("SeasonYear", "SeasonLabel", "Event", "Gender"))
    targets = core.materialize(next_season_targets_join(core.materialize(peaks, "event_peaks"), key="key").withColumnRenamed("Event", "event"), "event_targets")
    split = task_split(targets, FC.TASK_KEYS, train_max_year=2020, valid_year=2021, test_min_year=2022)
    return split.select("key", "season_key", "event", "Gender", "SeasonLabel", "split")


@register("a17_counts_with_test_years", O.with_ctes(*WINDOW_CTES, body="""
SELECT event, Gender, SeasonLabel,
       count(*) FILTER (WHERE SeasonYear <= 2021) AS n_train, count(*) FILTER (WHERE SeasonYear = 2022) AS n_val,
       count(*) FILTER (WHERE SeasonYear >= 2023) AS n_test
FROM samples GROUP BY event, Gender, SeasonLabel"""))
def a17_counts_with_test_years(spark, sf):
    return task_counts(time_split(_samples(spark, sf), train_max_year=2021, valid_year=2022, test_min_year=2023), FC.TASK_KEYS)


@register("c18_restored_targets", O.with_ctes(*TRAIN_CTES, body="""
SELECT fam_key, season_key, event, round(z, 6) AS z, round(y, 6) AS restored FROM tset"""))
def c18_restored_targets(spark, sf):
    """Each standardised target brought back to its event's unit; the twin has the target itself."""
    return core.training(spark, sf).select("fam_key", "season_key", "event", F.round("z", 6).alias("z"),
                                           F.round(inverse_z("z", "mu", "sd"), 6).alias("restored"))
