"""Grouping keys: athlete, family, event-level and season keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import pystrip

# Fixed value: separator of the composite keys.
KEY_SEP = "||"


def athlete_key(athlete: Column, gender: Column, *, stripped: bool = False) -> Column:
    a, g = (athlete, gender) if stripped else (pystrip(athlete), pystrip(gender))
    return F.concat(F.lower(a), F.lit(KEY_SEP), g)


def family_key(athlete: Column, gender: Column, family: Column, *, stripped: bool = False) -> Column:
    return F.concat(athlete_key(athlete, gender, stripped=stripped), F.lit(KEY_SEP), family)


def event_key(athlete: Column, event: Column, gender: Column) -> Column:
    """Key of the per-event (older) variant: athlete || lower(event) || gender."""
    return F.concat(F.lower(pystrip(athlete)), F.lit(KEY_SEP), F.lower(pystrip(event)),
                    F.lit(KEY_SEP), gender)


def season_key(year: Column, label: Column) -> Column:
    return F.concat(year.cast("int").cast("string"), F.lit("-"), label)


def next_season_key(year: Column, label: Column) -> Column:
    return F.concat((year.cast("int") + 1).cast("string"), F.lit("-"), label)
