"""Event names, aliases, families and orientation as column expressions.

Everything here is a plain Catalyst expression (``isin`` / ``create_map`` /
``when``), so it stays inside whole-stage codegen and needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import pystrip

# ---------------------------------------------------------------------------
# These must equal the reference's tables for results to match.
# ---------------------------------------------------------------------------
RUN_EVENTS = (
    "60 Meters", "100 Meters", "200 Meters", "400 Meters", "800 Meters", "1500 Meters",
    "Mile", "3000 Meters", "5000 Meters", "10000 Meters", "60 Hurdles", "110 Hurdles", "100 Hurdles",
    "400 Hurdles", "3000 Steeplechase", "DMR", "4 x 100 Relay", "4 x 400 Relay",
)
FIELD_EVENTS = (
    "Long Jump", "Triple Jump", "High Jump", "Pole Vault",
    "Shot Put", "Discus", "Hammer", "Javelin", "Weight Throw",
)
EVENT_ALIASES = {
    "60m": "60 Meters", "100m": "100 Meters", "200m": "200 Meters", "400m": "400 Meters",
    "800m": "800 Meters", "1500m": "1500 Meters", "mile": "Mile",
    "3k": "3000 Meters", "5k": "5000 Meters", "10k": "10000 Meters",
    "60h": "60 Hurdles", "110h": "110 Hurdles", "100h": "100 Hurdles",
    "4x1": "4 x 100 Relay", "4x4": "4 x 400 Relay",
}
# The older (beta) variant: no 100 Hurdles in the run set, and five fewer aliases.
RUN_EVENTS_BETA = tuple(e for e in RUN_EVENTS if e != "100 Hurdles")
EVENT_ALIASES_BETA = {k: v for k, v in EVENT_ALIASES.items()
                      if k not in ("60h", "110h", "100h", "4x1", "4x4")}
SAME_NAME_FAMILIES = (
    "200 Meters", "400 Meters", "800 Meters", "3000 Meters", "5000 Meters", "10000 Meters",
    "400 Hurdles", "3000 Steeplechase", "4 x 400 Relay",
    "Long Jump", "Triple Jump", "High Jump", "Pole Vault",
    "Shot Put", "Discus", "Hammer", "Javelin", "Weight Throw", "DMR",
)
# Keyword classifier used when scoring submitted marks.
TIME_KEYWORDS = ("meters", "hurdles", "relay", "mile", "miles", "steeple", "1500", "3000",
                 "5000", "10000", "10k", "marathon")
FIELD_KEYWORDS = ("jump", "vault", "shot", "discus", "hammer", "javelin", "weight")
# Season labels: sort order and model label id; unknown labels sort last, id 0.
SEASON_LABEL_ORDER = {"Indoors": 0, "Outdoors": 1}
SEASON_LABEL_ID = {"Indoors": 0, "Outdoors": 1}
# Label ids for a scoring window, by vocabulary size of the model.
SEASON_LABEL_ID_VOCAB2 = {"Indoors": 0, "Outdoors": 1, "PAD": 0}
SEASON_LABEL_ID_VOCAB3 = {"PAD": 0, "Indoors": 1, "Outdoors": 2}
# ---------------------------------------------------------------------------


def _lit_map(d: dict) -> Column:
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def canonical_event(event: Column, *, beta: bool = False, stripped: bool = False) -> Column:
    """Known names pass through; else lower(strip(e)) is looked up in the alias table; else unchanged."""
    run = RUN_EVENTS_BETA if beta else RUN_EVENTS
    aliases = EVENT_ALIASES_BETA if beta else EVENT_ALIASES
    known = event.isin(*(run + FIELD_EVENTS))
    name = event if stripped else pystrip(event)
    alias = F.try_element_at(_lit_map(aliases), F.lower(name))
    short = F.length(name) <= max(map(len, aliases))  # no longer text is an alias: lower case has as many characters or more
    return F.when(known | ~short, event).otherwise(F.coalesce(alias, event))


def event_to_family(event: Column, gender: Column, *, canonical: bool = False, stripped: bool = False) -> Column:
    """Family that lets indoor and outdoor analogues share one timeline.

    ``canonical=True`` when ``event`` is already canonical (the lookup is idempotent);
    ``stripped=True`` when ``gender`` has no surrounding whitespace.
    """
    e = event if canonical else canonical_event(event)
    g = F.lower(gender if stripped else pystrip(gender))
    return (
        F.when(e.isin(*SAME_NAME_FAMILIES), e)
        .when(e.isin("60 Meters", "100 Meters"), F.lit("short_sprint"))
        .when(e.isin("Mile", "1500 Meters"), F.lit("metric_mile"))
        .when(e == "60 Hurdles", F.lit("short_hurdles"))
        .when((e == "110 Hurdles") & g.startswith("men"), F.lit("short_hurdles"))
        .when((e == "100 Hurdles") & g.startswith("women"), F.lit("short_hurdles"))
        .otherwise(e)
    )


def is_time_event(name: Column) -> Column:
    """Keyword classifier: field keyword -> False, time keyword -> True, else digits followed by m."""
    n = F.lower(name)
    field = F.lit(False)
    for k in FIELD_KEYWORDS:
        field = field | n.contains(k)
    time = F.lit(False)
    for k in TIME_KEYWORDS:
        time = time | n.contains(k)
    return (F.when(field, False).when(time, True)
            .otherwise(F.coalesce(n.rlike(r"\d+\s*m"), F.lit(False))))


def season_label_order(label: Column) -> Column:
    """Sort position of a season label; unknown labels are null (sort them last)."""
    return F.try_element_at(_lit_map(SEASON_LABEL_ORDER), label)


def season_label_id(label: Column) -> Column:
    return F.coalesce(F.try_element_at(_lit_map(SEASON_LABEL_ID), label), F.lit(0))


def window_label_id(label: Column, vocab: int = 2) -> Column:
    """Label id used by a scoring window; depends on the model's label vocabulary size."""
    m = SEASON_LABEL_ID_VOCAB2 if vocab == 2 else SEASON_LABEL_ID_VOCAB3
    return F.try_element_at(_lit_map(m), label)


def normalise_season_label(label: Column) -> Column:
    """trim + title case; anything other than Indoors / Outdoors becomes null (rejected)."""
    t = F.initcap(pystrip(label))
    return F.when(t.isin("Indoors", "Outdoors"), t)
