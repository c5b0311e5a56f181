"""Mark, wind and date parsing plus result formatting, all as built-in column expressions.

Every numeric cast is guarded by a strict number pattern first: Spark's cast
accepts forms such as ``1.5f`` / ``1.5d`` that Python's ``float`` rejects.
``inf`` / ``nan`` are rejected (a NaN mark is dropped anyway).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .events import FIELD_EVENTS, RUN_EVENTS, RUN_EVENTS_BETA
from .text import pystrip

# Accepted date layouts, tried in this order (Spark pattern letters).
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "MMM d, yyyy", "MMM d yyyy")
# Their shapes, the last two in one. A text of a shape is put in the order of the first, which a cast reads: a pattern
# parser costs several times as much, and each of its failures an exception.
ISO_SHAPE, SLASH_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
MONTH_SHAPE = r"^[A-Za-z]{3} [0-9]{1,2},? [0-9]{4}$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

NUM = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
FLOAT_RE = rf"^\s*{NUM}\s*$"
INT_RE = r"^\s*[+-]?[0-9]+\s*$"
# m:s and h:m:s after spaces are removed (int / float parts may carry other whitespace).
TIME2_RE = rf"^\s*([+-]?[0-9]+)\s*:\s*({NUM})\s*$"
TIME3_RE = rf"^\s*([+-]?[0-9]+)\s*:\s*([+-]?[0-9]+)\s*:\s*({NUM})\s*$"
FEET_INCHES_RE = r"^([0-9]{1,3})-([0-9]{1,2}(?:\.[0-9]+)?)$"
# A number with at most one trailing m (the m is dropped before the number is read).
METRES_RE = rf"^\s*({NUM})\s*[mM]?$"


def _to_double(s: Column) -> Column:
    return F.when(s.rlike(FLOAT_RE), pystrip(s).cast("double"))


def _strip(s: Column, stripped: bool) -> Column:
    return s if stripped else pystrip(s)


def parse_time_to_seconds(s: Column, *, stripped: bool = False) -> Column:
    """``m:s`` / ``h:m:s`` with integer minutes and hours, else a plain number; null for codes (DNF, DQ, FS, NT, NS) and
    junk, neither of which has the shape of a number.

    ``stripped=True`` skips the leading/trailing whitespace removal when the caller already did it.
    """
    st = _strip(s, stripped)
    ns = F.replace(st, F.lit(" "), F.lit(""))

    def g(rx, i):
        return F.regexp_extract(ns, rx, i)

    two = g(TIME2_RE, 1).cast("long") * 60 + g(TIME2_RE, 2).cast("double")
    three = (g(TIME3_RE, 1).cast("long") * 3600 + g(TIME3_RE, 2).cast("long") * 60
             + g(TIME3_RE, 3).cast("double"))
    return (
        F.when(st.isNull() | (st == ""), F.lit(None).cast("double"))
        .when(~ns.contains(":"), F.when(ns.rlike(FLOAT_RE), ns.cast("double")))
        .when(ns.rlike(TIME2_RE), two)
        .when(ns.rlike(TIME3_RE), three)
    )


def parse_distance_to_meters(s: Column, *, stripped: bool = False) -> Column:
    """Feet-inches ``f-i`` to metres, else one trailing ``m`` or ``M`` dropped and a plain number (a code, NM, is none)."""
    st = _strip(s, stripped)
    feet_inches = (F.regexp_extract(st, FEET_INCHES_RE, 1).cast("long") * 12
                   + F.regexp_extract(st, FEET_INCHES_RE, 2).cast("double")) * 0.0254
    return (
        F.when(st.isNull() | (st == ""), F.lit(None).cast("double"))
        .when(st.contains("-") & st.rlike(FEET_INCHES_RE), feet_inches)
        .otherwise(F.nullif(F.regexp_extract(st, METRES_RE, 1), F.lit("")).cast("double"))  # '' where it has no such shape
    )


def mark_to_numeric(event: Column, mark: Column, *, beta: bool = False) -> tuple[Column, Column]:
    """(value, is_time): run events are times, field events distances, others by heuristic.

    Heuristic: a time that has ``:`` or is under 30 s; else a distance; nothing parsed -> (null, True).
    """
    run = RUN_EVENTS_BETA if beta else RUN_EVENTS
    return orient_mark(parse_time_to_seconds(mark), parse_distance_to_meters(mark), mark,
                       event.isin(*run), event.isin(*FIELD_EVENTS))


def orient_mark(t: Column, d: Column, mark: Column, is_run: Column, is_field: Column) -> tuple[Column, Column]:
    """(value, is_time) from an already parsed time ``t`` and distance ``d``."""
    heur_time = t.isNotNull() & (F.coalesce(mark, F.lit("")).contains(":") | (t < 30))
    value = F.when(is_run, t).when(is_field, d).when(heur_time, t).otherwise(d)
    is_time = (F.when(is_run, True).when(is_field, False).when(heur_time, True)
               .otherwise(d.isNull()))
    return value, is_time


def wind_mps(wind: Column) -> Column:
    """Remove ``+`` and ``m/s``; numeric or 0.0."""
    w = F.replace(F.replace(wind, F.lit("+"), F.lit("")), F.lit("m/s"), F.lit(""))
    return F.coalesce(_to_double(w), F.lit(0.0))


def parse_date(s: Column, *, stripped: bool = False) -> Column:
    """A date in one of the four accepted layouts (DATE_FORMATS); else null."""
    t = _strip(s, stripped)
    year = F.substring(t, -4, 4)
    name = F.translate(F.substring(t, 1, 3), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    at = F.position(name, F.lit(MONTHS)) + 2
    month = F.when(at % 3 == 0, (at / 3).cast("int").cast("string"))
    day = F.rtrim(F.substring(t, 5, 2), F.lit(", "))
    # A pattern is only tried on texts that hold its separator.
    iso = (F.when(t.contains("-") & t.rlike(ISO_SHAPE), t)
           .when(t.contains("/") & t.rlike(SLASH_SHAPE), F.concat(year, F.lit("-"), F.replace(F.substring_index(t, "/", 2), F.lit("/"), F.lit("-"))))
           .when(t.contains(" ") & t.rlike(MONTH_SHAPE), F.concat(year, F.lit("-"), month, F.lit("-"), day)))
    return iso.try_cast("date")


# ---- scoring-input parsers ------------------------------------------------

TIME_LIKE_RE = r"^\s*(?:([0-9]+):)?([0-9]+)(?:\.([0-9]+))?\s*$"


def parse_time_like(s: Column) -> Column:
    """``(m:)?s(.frac)?`` only: no hours, no sign."""
    t = pystrip(s)
    mm = F.regexp_extract(t, TIME_LIKE_RE, 1)
    ss = F.regexp_extract(t, TIME_LIKE_RE, 2)
    frac = F.regexp_extract(t, TIME_LIKE_RE, 3)
    total = (F.when(mm != "", mm.cast("double") * 60.0).otherwise(0.0)
             + ss.cast("double")
             + F.when(frac != "", F.concat(F.lit("0."), frac).cast("double")).otherwise(0.0))
    return F.when(t.rlike(TIME_LIKE_RE), total)


def parse_float(s: Column) -> Column:
    """lower, drop ``m/s`` and every ``m``, then a number or null."""
    t = F.replace(F.replace(F.lower(pystrip(s)), F.lit("m/s"), F.lit("")), F.lit("m"), F.lit(""))
    return _to_double(t)


def submitted_mark(mark: Column, time_event: Column) -> Column:
    """Time events try the time pattern first, then a plain number; others a plain number."""
    return F.coalesce(F.when(time_event, parse_time_like(mark)), parse_float(mark))


def submitted_wind(wind: Column, season_label: Column) -> Column:
    """Indoors 0; else drop ``m/s`` and parentheses, parse; empty or junk -> 0."""
    w = pystrip(wind)
    for tok in ("m/s", "(", ")"):
        w = F.replace(w, F.lit(tok), F.lit(""))
    return F.when(season_label == "Indoors", F.lit(0.0)).otherwise(
        F.coalesce(parse_float(w), F.lit(0.0)))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def fmt_time(seconds: Column) -> Column:
    """>= 60 s as ``m:ss.ff``, else ``ss.ffs``; ``n/a`` for null / NaN / inf."""
    x = seconds.cast("double")
    m = F.floor(x / 60)
    rest = x - m * 60
    return (F.when(~is_finite(x), F.lit("n/a"))
            .when(x >= 60, F.format_string("%d:%05.2f", m.cast("long"), rest))
            .otherwise(F.format_string("%.2fs", x)))


def fmt_dist(meters: Column) -> Column:
    x = meters.cast("double")
    return F.when(~is_finite(x), F.lit("n/a")).otherwise(F.format_string("%.2f m", x))
