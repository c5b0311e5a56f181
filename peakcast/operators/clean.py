"""Raw marks -> prepared marks (typed, keyed, cleaned).

One narrow projection plus two filters: no shuffle, fully inside whole-stage
codegen, and Catalyst prunes the raw columns that are not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import FIELD_EVENTS, RUN_EVENTS, RUN_EVENTS_BETA
from ..functions.marks import (FLOAT_RE, orient_mark, parse_distance_to_meters,
                               parse_time_to_seconds)
from ..functions.text import pystrip_edges
from ..functions import (canonical_event, event_key, event_to_family, family_key,
                         mark_to_numeric, parse_date, pystrip, season_key, athlete_key)

# Fixed value: the eleven raw columns kept by the cleaning step.
KEEP_COLS = ["Division", "School", "Gender", "SeasonLabel", "SeasonYear", "Event",
             "Athlete", "MarkOrTime", "Wind", "Meet", "MeetDate"]

# Texts that the keys of marks are made of.
KEY_TEXTS = ("Event", "Athlete", "Gender", "SeasonLabel")

# Name of the struct column holding the source position used to break ties.
ORD = "_ord"


def ordinal(cols: list[str], digits: dict[str, int] | None = None) -> Column:
    """Source position of a row (the total tie order).

    With ``digits`` (decimal width of each non-negative integer key, 38 in total at most) the keys
    are packed into one DECIMAL(38,0) whose numeric order is their lexicographic order; a fixed-width
    value lets ``min`` / ``min_by`` run as hash aggregates. A key outside its width fails the job
    rather than mis-order rows. Without ``digits`` the position is an orderable struct.
    """
    if not digits:
        return F.struct(*[F.col(c) for c in cols])
    from decimal import Decimal
    dec = "decimal(38,0)"
    # Neighbours of 18 digits in all are put together as longs, which costs far less than decimal arithmetic.
    parts, ok = [], F.lit(True)
    for c in cols:
        w, value = digits[c], F.col(c).cast("long")
        if parts and parts[-1][1] + w <= 18:
            parts[-1] = (parts[-1][0] * F.lit(10 ** w) + value, parts[-1][1] + w)
        else:
            parts.append((value, w))
        ok = ok & (F.col(c) >= 0) & (F.col(c) < F.lit(10 ** w))
    packed = parts[0][0].cast(dec)
    for value, w in parts[1:]:
        packed = (packed * F.lit(Decimal(10) ** w).cast(dec) + value.cast(dec)).cast(dec)
    return F.when(ok, packed).otherwise(F.raise_error(F.lit("ordinal key outside its declared width")).cast(dec))


def prepare_marks(raw: DataFrame, ordinal_cols: list[str], *, variant: str = "family",
                  blank_as_null: bool = False, ordinal_digits: dict[str, int] | None = None) -> DataFrame:
    """Clean marks into values, dates, orientation, families and keys.

    ``variant="family"`` gives athlete+gender+family keys (the main model);
    ``variant="event"`` the per-event key of the older models (beta alias table).
    ``blank_as_null`` turns empty strings into nulls before the null filter.
    """
    beta = variant == "event"
    run = RUN_EVENTS_BETA if beta else RUN_EVENTS
    str_cols = [c for c in KEEP_COLS if c != "SeasonYear"]
    # The strip reads a text several times, so texts are columns before it. The source position is packed last: its parts
    # are longs, which pass from step to step at less cost than a decimal.
    df = raw.select(*ordinal_cols, F.col("SeasonYear").cast("int").alias("SeasonYear"),
                    *[F.col(c).cast("string").alias(c) for c in str_cols])
    df = df.select(*ordinal_cols, "SeasonYear", *[pystrip_edges(F.col(c)).alias(c) for c in str_cols])
    if blank_as_null:
        df = df.select(*ordinal_cols, "SeasonYear",
                       *[F.nullif(F.col(c), F.lit("")).alias(c) for c in str_cols])
    # every string column is stripped above, so the helpers skip their own strip
    df = df.withColumn("Event", canonical_event(F.col("Event"), beta=beta, stripped=True))
    # Parsed intermediates get their own projection: each is referenced several times below,
    # so Catalyst keeps it apart and every parser runs once per row.
    is_run, is_field = F.col("Event").isin(*run), F.col("Event").isin(*FIELD_EVENTS)
    # A run event's mark is no distance and a field event's no time, so only other events' marks are read as both.
    df = df.select("*", parse_date(F.col("MeetDate"), stripped=True).alias("date"), is_run.alias("_run"), is_field.alias("_field"),
                   F.when(~is_field, parse_time_to_seconds(F.col("MarkOrTime"), stripped=True)).alias("_t"),
                   F.when(~is_run, parse_distance_to_meters(F.col("MarkOrTime"), stripped=True)).alias("_d"))
    value, is_time = orient_mark(F.col("_t"), F.col("_d"), F.col("MarkOrTime"), F.col("_run"), F.col("_field"))
    keep = value.isNotNull() & ~F.isnan(value)
    for c in ("date", "Event", "Athlete", "SeasonLabel", "SeasonYear"):
        keep = keep & F.col(c).isNotNull()
    # Row drops are a 0-or-1 element generator rather than a Filter: a Filter would be pushed
    # below this projection with the parsers inlined into it (parsed twice, oversized codegen).
    # Its parts are columns of their own: Spark compiles a projection, but interprets a generator's own input. (That input
    # must not be a single column, or Spark would infer such a filter from it.) The texts that keys are made of pass through
    # it, so a filter on a key (joins infer them) stays above it, where it does not grow by the steps of the cleaning.
    row_cols = [c for c in df.columns if c not in ("_t", "_d", "_run", "_field")]
    df = df.select(*row_cols, keep.alias("_keep"), value.alias("_v"), is_time.alias("_i"))
    one = F.array(F.struct(F.col("_v").alias("value"), F.col("_i").alias("is_time"), *KEY_TEXTS))
    df = df.select(*[c for c in row_cols if c not in KEY_TEXTS], F.inline(F.when(F.col("_keep"), one)))
    rest = [c for c in row_cols if c not in ordinal_cols]
    df = df.select(*ordinal_cols, ordinal(ordinal_cols, ordinal_digits).alias(ORD), *rest, "value", "is_time")
    season = season_key(F.col("SeasonYear"), F.col("SeasonLabel")).alias("season_key")
    if beta:
        return df.select("*", event_key(F.col("Athlete"), F.col("Event"), F.col("Gender")).alias("key"), season)
    # One projection, in which Spark evaluates the family that two columns hold once.
    family = event_to_family(F.col("Event"), F.col("Gender"), canonical=True, stripped=True)
    return df.select("*", family.alias("family"), athlete_key(F.col("Athlete"), F.col("Gender"), stripped=True).alias("ath_key"),
                     family_key(F.col("Athlete"), F.col("Gender"), family, stripped=True).alias("fam_key"), season)


def typed_layout(rows: DataFrame) -> DataFrame:
    """The typed 16-column persisted layout: missing columns as '', three ints with -1 for junk."""
    from ..sources.layout import RAW_COLUMNS, INT_COLUMNS
    out = []
    for c in RAW_COLUMNS:
        src = F.col(c) if c in rows.columns else F.lit("")
        if c in INT_COLUMNS:
            num = F.when(src.cast("string").rlike(FLOAT_RE), pystrip(src.cast("string")).cast("double"))
            out.append(F.coalesce(num.try_cast("int"), F.lit(-1)).alias(c))
        else:
            out.append(F.coalesce(src.cast("string"), F.lit("")).alias(c))
    return rows.select(*out)
