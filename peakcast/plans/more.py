"""Further registered queries: mixed seasons, window tensors, lists, labels, scoring windows and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import core
from . import oracle_sql as O
from .registry import (CORE, RAW_SCHEMA_DDL, SEASON_CTES, SQL, TRAIN_CTES, WINDOW_CTES, _FILTERS, _SUBS_SQL, _fmt_sql,
                       _submissions, r6, register)
from ..functions.events import SEASON_LABEL_ID_VOCAB2, SEASON_LABEL_ID_VOCAB3, normalise_season_label, window_label_id
from ..operators import forecast as FC
from ..operators.inspect import mark_filters
from ..operators.seasons import family_season_peaks, season_aggregate
from ..operators.training import allowed_events, time_split
from ..operators.windows import flat_features
from ..session import scratch_path
from ..sources import io as IO
from ..sources.fixture import ORDINAL_COLS, raw_marks

# ---- A1, A2, A5 on seasons with several events and both orientations ------------------------

MIXED = "mixed AS (SELECT * REPLACE (ath_key AS fam_key) FROM marks)"
_MIXED_CTES = CORE + (MIXED, O.SEASONS.replace("FROM marks", "FROM mixed"))


def _mixed(spark, sf):
    """Marks keyed by athlete and gender alone: a season holds several events, times and distances."""
    return core.prepared(spark, sf).withColumn("fam_key", F.col("ath_key"))


@register("a1_mixed_season_table", O.with_ctes(*_MIXED_CTES, body="""
SELECT fam_key, season_key, SeasonYear, SeasonLabel, Gender, family, is_time, round(peak_value, 6) AS peak_value, n_marks, length, event_used
FROM seasons"""))
def a1_mixed_season_table(spark, sf):
    s = season_aggregate(_mixed(spark, sf))
    return s.select("fam_key", "season_key", "SeasonYear", "SeasonLabel", "Gender", "family", "is_time", r6("peak_value").alias("peak_value"),
                    "n_marks", "length", "event_used")


@register("a2_mixed_season_peaks", O.with_ctes(*_MIXED_CTES, body="""
SELECT fam_key, season_key, family, is_time, round(peak_value, 6) AS peak_value FROM seasons"""))
def a2_mixed_season_peaks(spark, sf):
    return family_season_peaks(_mixed(spark, sf)).select("fam_key", "season_key", "family", "is_time", r6("peak_value").alias("peak_value"))


# ---- J3, V2, V7, V8, S8: sequences, padding, windows ----------------------------------------

_STEPS = f"""
ranked AS (
  SELECT fam_key, season_key, value, Wind, row_number() OVER w AS rn, date, lead(date) OVER w AS prev_date
  FROM marks WINDOW w AS (PARTITION BY fam_key, season_key ORDER BY date DESC, {O.ORD_DESC})),
steps AS (
  SELECT fam_key, season_key, 32 - rn AS step, value, CAST(greatest(coalesce(date_diff('day', prev_date, date), 0), 0) AS DOUBLE) AS gap,
         {O.wind_sql('Wind')} AS wind FROM ranked WHERE rn <= 32),
wsteps AS (
  SELECT s.fam_key, s.season_key, 3 - (s.i - h.i) AS slot, t.step, t.value, t.gap, t.wind
  FROM samples s JOIN idx h ON h.fam_key = s.fam_key AND h.i BETWEEN s.i - 3 AND s.i
  JOIN steps t ON t.fam_key = h.fam_key AND t.season_key = h.season_key)"""


@register("v8_window_steps", O.with_ctes(*WINDOW_CTES, _STEPS, body="""
SELECT fam_key, season_key, CAST(slot AS INTEGER) AS slot, CAST(step AS INTEGER) AS step, round(value, 6) AS value, gap, round(wind, 6) AS wind
FROM wsteps"""))
def v8_window_steps(spark, sf):
    """Every mark of every sample's window, at its place in the padded K x L block."""
    s = core.samples(spark, sf)
    w = s.select("fam_key", "season_key", F.posexplode("window").alias("slot", "h"))
    w = w.select("fam_key", "season_key", "slot", F.size("h.seq").alias("n"), F.posexplode("h.seq").alias("p", "m"))
    return w.select("fam_key", "season_key", "slot", (F.lit(32) - F.col("n") + F.col("p")).alias("step"), r6("m.value").alias("value"), F.col("m.gap").alias("gap"),
                    r6("m.wind").alias("wind"))


@register("v7_flat_vectors", O.with_ctes(*WINDOW_CTES, _STEPS, body="""
SELECT s.fam_key, s.season_key, 384 AS size,
       round(coalesce(sum((slot * 96 + step * 3 + 1) * value + (slot * 96 + step * 3 + 2) * gap + (slot * 96 + step * 3 + 3) * wind), 0.0), 2) AS weighted
FROM samples s LEFT JOIN wsteps w USING (fam_key, season_key) GROUP BY s.fam_key, s.season_key"""))
def v7_flat_vectors(spark, sf):
    """The dense K * L * 3 vector: its size, and its sum weighted by position (which fixes padding and order)."""
    x = flat_features(core.samples(spark, sf))
    # a mark's three terms are added first, as in the twin: sums of doubles depend on their order
    term = lambda v, i: F.get("x", i * 3 + v) * (i * 3 + v + 1)
    per_mark = F.transform(F.sequence(F.lit(0), F.lit(core.K_SEASONS * core.SEQLEN - 1)), lambda i: term(0, i) + term(1, i) + term(2, i))
    weighted = F.aggregate(per_mark, F.lit(0.0), lambda a, b: a + b)
    return x.select("fam_key", "season_key", F.size("x").alias("size"), F.round(weighted, 2).alias("weighted"))


@register("s8_saved_sequences", SQL["v1_season_sequences"])
def s8_saved_sequences(spark, sf):
    """Season table with its sequences, saved and read back, step by step."""
    base = scratch_path(spark, "s8")
    IO.save_table(core.build_seasons(core.prepared(spark, sf)), f"{base}/seasons")
    t = IO.load_table(spark, f"{base}/seasons").select("fam_key", "season_key", F.size("seq").alias("n"), F.posexplode("seq").alias("p", "m"))
    return t.select("fam_key", "season_key", (F.lit(32) - F.col("n") + F.col("p")).alias("step"), r6("m.value").alias("value"), F.col("m.gap").alias("gap"),
                    r6("m.wind").alias("wind"))


# ---- A9, O7, A16 ----------------------------------------------------------------------------

_LIST = "SELECT '{0}' AS list, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS pos, v AS value FROM (SELECT DISTINCT {0} AS v FROM marks WHERE {0} IS NOT NULL)"


@register("a9_sorted_lists", O.with_ctes(*CORE, body=" UNION ALL ".join(_LIST.format(c) for c in ("Gender", "family", "Event", "SeasonLabel"))))
def a9_sorted_lists(spark, sf):
    """Gender, family, event and season-label lists, each sorted: one pass, combined in tasks first."""
    names = ("Gender", "family", "Event", "SeasonLabel")
    one = core.prepared(spark, sf).select(F.explode(F.array(*(F.struct(F.lit(c).alias("list"), F.col(c).alias("value")) for c in names))).alias("x"))
    one = one.select("x.*").filter(F.col("value").isNotNull()).distinct()
    lists = one.groupBy("list").agg(F.sort_array(F.collect_list("value")).alias("values"))
    return lists.select("list", F.posexplode("values").alias("pos", "value"))


@register("a16_weighted_mean_loss", O.with_ctes(*TRAIN_CTES, body="""
SELECT round(sum(l * n) / greatest(sum(n), 1), 6) AS mean_loss
FROM (SELECT avg(abs(peak_value - y)) AS l, count(*) AS n FROM tset WHERE split = 'val' GROUP BY Gender, event)"""))
def a16_weighted_mean_loss(spark, sf):
    m = FC.per_event_mae(FC.persistence(core.training(spark, sf)))
    return FC.weighted_mean_loss(m, "val_mae", "n").select(r6("mean_loss").alias("mean_loss"))


# ---- C25, V11, F13 --------------------------------------------------------------------------

@register("c25_season_labels", O.with_ctes(O.RAW_MARKS, body="""
SELECT ord_key, line_no, part_key, supp_key,
       CASE line_no % 5 WHEN 0 THEN SeasonLabel WHEN 1 THEN SeasonLabel WHEN 2 THEN SeasonLabel ELSE NULL END AS label
FROM raw_marks"""))
def c25_season_labels(spark, sf):
    """Labels as users type them: as stored, in capitals with blanks, in lower case; others are rejected."""
    k, lab = F.col("line_no") % 5, F.col("SeasonLabel")
    typed = (F.when(k == 1, F.concat(F.lit("  "), F.upper(lab), F.lit("\t"))).when(k == 2, F.lower(lab)).when(k == 3, F.concat(lab, F.lit("?")))
             .when(k == 4, F.lit("")).otherwise(lab))
    return raw_marks(spark, sf).select(*ORDINAL_COLS, normalise_season_label(typed).alias("label"))


def _case(col: str, values: dict) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


@register("v11_label_vocabulary", O.with_ctes(O.RAW_MARKS, body=f"""
SELECT label, CAST({_case('label', SEASON_LABEL_ID_VOCAB2)} AS INTEGER) AS id2, CAST({_case('label', SEASON_LABEL_ID_VOCAB3)} AS INTEGER) AS id3
FROM (SELECT DISTINCT SeasonLabel AS label FROM raw_marks UNION SELECT 'PAD' UNION SELECT 'Winter')"""))
def v11_label_vocabulary(spark, sf):
    r = raw_marks(spark, sf)
    labels = r.select(F.explode(F.array(F.col("SeasonLabel"), F.lit("PAD"), F.lit("Winter"))).alias("label")).distinct()
    return labels.select("label", window_label_id(F.col("label"), 2).cast("int").alias("id2"), window_label_id(F.col("label"), 3).cast("int").alias("id3"))


_ODD = "CASE line_no % 5 WHEN 0 THEN CAST('nan' AS DOUBLE) WHEN 1 THEN CAST('inf' AS DOUBLE) WHEN 2 THEN NULL ELSE value END"


@register("f13_finite_guard", O.with_ctes(*CORE, f"odd AS (SELECT ord_key, line_no, part_key, supp_key, Event, {_ODD} AS v FROM marks)", body=f"""
SELECT ord_key, line_no, part_key, supp_key, {_fmt_sql('v', 'Event')} AS text FROM odd"""))
def f13_finite_guard(spark, sf):
    k = F.col("line_no") % 5
    v = (F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).when(k == 2, F.lit(None).cast("double")).otherwise(F.col("value")))
    m = core.prepared(spark, sf).select(*ORDINAL_COLS, "Event", v.alias("v"))
    return m.select(*ORDINAL_COLS, FC.format_forecast(F.col("v"), F.col("Event")).alias("text"))


# ---- V10: scoring windows -------------------------------------------------------------------

@register("v10_scoring_windows", O.with_ctes(*TRAIN_CTES, _SUBS_SQL, f"""
known AS (SELECT DISTINCT submission_id, gender, event, season_label FROM subs s
          WHERE EXISTS (SELECT 1 FROM allowed a WHERE a.Gender = s.gender AND a.event = s.event)),
lens AS (SELECT submission_id, least(count(*), 32) AS n FROM subs WHERE value IS NOT NULL GROUP BY submission_id)""", body=f"""
SELECT k.submission_id, gender, event,
       concat_ws(',', {", ".join([str(SEASON_LABEL_ID_VOCAB2['PAD'])] * 3)}, {_case('season_label', SEASON_LABEL_ID_VOCAB2)}) AS label_ids,
       '0,0,0,' || CAST(coalesce(n, 0) AS VARCHAR) AS lengths, 1 AS n_seasons
FROM known k LEFT JOIN lens USING (submission_id)"""))
def v10_scoring_windows(spark, sf):
    subs = _submissions(spark, sf)
    allowed = allowed_events(time_split(core.materialize(core.samples(spark, sf, with_seq=False), "samples")))
    win, _ = FC.scoring_window(FC.scoring_blocks(subs), subs, allowed)
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return win.select("submission_id", "gender", "event", join("label_ids").alias("label_ids"), join("lengths").alias("lengths"), "n_seasons")


# ---- S3, S11, S12, S15: exports, written and read back --------------------------------------

@register("s3_appended_csv", O.with_ctes(O.RAW_MARKS, body="""
SELECT CAST(ord_key AS VARCHAR) AS ord_key, CAST(line_no AS VARCHAR) AS line_no, Athlete, Event FROM raw_marks"""))
def s3_appended_csv(spark, sf):
    """Two runs append to one CSV folder; both are read back."""
    base = scratch_path(spark, "s3")
    m = raw_marks(spark, sf).select("ord_key", "line_no", "Athlete", "Event")
    for part in (0, 1):
        IO.write_csv(m.filter(F.pmod("line_no", F.lit(2)) == part), f"{base}/out", mode="append")
    return spark.read.option("header", True).csv(f"{base}/out", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, quote='"')


@register("s11_metrics_csv", SQL["m8_persistence_metrics"])
def s11_metrics_csv(spark, sf):
    base = scratch_path(spark, "s11")
    m = FC.per_event_mae(FC.persistence(core.training(spark, sf))).select("Gender", "event", r6("val_mae").alias("val_mae"), "n")
    IO.write_csv(m, f"{base}/metrics", single_file=True)
    return spark.read.schema("Gender string, event string, val_mae double, n long").option("header", True).csv(f"{base}/metrics")


@register("s12_exported_filtered_marks", "SELECT * REPLACE (nullif(MarkOrTime, '') AS MarkOrTime, nullif(Wind, '') AS Wind) FROM (" + SQL["f7_filtered_marks"] + ")")
def s12_exported_filtered_marks(spark, sf):
    """Filtered marks as CSV, read back with the table's types; an empty text comes back as no value."""
    base = scratch_path(spark, "s12")
    IO.write_csv(mark_filters(raw_marks(spark, sf), **_FILTERS), f"{base}/marks")
    return spark.read.schema(RAW_SCHEMA_DDL).option("header", True).csv(f"{base}/marks", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue="")


@register("s15_single_page_layout", O.with_ctes(O.RAW_MARKS, body="""
SELECT '' AS "Team", Division, Gender, Event, Athlete, '' AS "Year", MarkOrTime AS "Mark/Time", Wind, Meet, MeetDate AS "Date" FROM raw_marks"""))
def s15_single_page_layout(spark, sf):
    from ..operators.clean import typed_layout
    return IO.single_page_layout(typed_layout(raw_marks(spark, sf)))
