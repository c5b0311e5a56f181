"""Registered queries: one Spark plan per inventory operator plus its independent DuckDB twin.

Every query reads the driver tables at ``sf_dir`` (``lineitem``, ``pages``,
``supplier`` ...) or data Spark derives from them; none runs on fixed input.
Doubles are rounded to 6 places and dates rendered as ``yyyy-MM-dd`` text so
both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core
from . import oracle_sql as O
from ..operators.seasons import (family_season_peaks, next_season_targets_frame,
                                 next_season_targets_join)
from ..operators.sequences import last_marks
from ..operators.training import allowed_events, event_ids, event_stats, time_split
from ..operators.windows import explode_window, history_windows

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


CORE = (O.RAW_MARKS, O.PREPARED)
SEASON_CTES = CORE + (O.SEASONS,)
WINDOW_CTES = SEASON_CTES + (O.WINDOWS,)
TRAIN_CTES = WINDOW_CTES + (O.TRAINING,)


# ---- 2.4 / 2.3: cleaning -------------------------------------------------------------------

@register("f1_prepared_marks", O.with_ctes(*CORE, body="""
SELECT ord_key, line_no, part_key, supp_key, fam_key, season_key, Event, family, strftime(date, '%Y-%m-%d') AS date,
       round(value, 6) AS value, is_time
FROM marks"""))
def f1_prepared_marks(spark, sf):
    m = core.prepared(spark, sf)
    return m.select("ord_key", "line_no", "part_key", "supp_key", "fam_key", "season_key", "Event", "family", core.date_str("date").alias("date"),
                    r6("value").alias("value"), "is_time")


@register("c7_event_families", O.with_ctes(*CORE, body="""
SELECT Event, family, is_time, count(*) AS n_marks, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value
FROM marks GROUP BY Event, family, is_time"""))
def c7_event_families(spark, sf):
    m = core.prepared(spark, sf)
    return m.groupBy("Event", "family", "is_time").agg(
        F.count(F.lit(1)).alias("n_marks"), r6(F.min("value")).alias("min_value"),
        r6(F.max("value")).alias("max_value"))


# ---- 2.5: season aggregates ---------------------------------------------------------------

@register("a3_family_season_peaks", O.with_ctes(*SEASON_CTES, body="""
SELECT fam_key, season_key, SeasonYear, SeasonLabel, Gender, family, is_time, round(peak_value, 6) AS peak_value
FROM seasons"""))
def a3_family_season_peaks(spark, sf):
    p = family_season_peaks(core.prepared(spark, sf))
    return p.withColumn("peak_value", r6("peak_value"))


@register("a5_season_table", O.with_ctes(*SEASON_CTES, body="""
SELECT fam_key, season_key, round(peak_value, 6) AS peak_value, n_marks, length, event_used FROM seasons"""))
def a5_season_table(spark, sf):
    s = core.build_seasons(core.prepared(spark, sf), with_seq=False)
    return s.select("fam_key", "season_key", r6("peak_value").alias("peak_value"), "n_marks", "length", "event_used")


_NEXT_SQL = O.with_ctes(*SEASON_CTES, body="""
SELECT a.fam_key, a.season_key, CAST(a.SeasonYear + 1 AS VARCHAR) || '-' || a.SeasonLabel AS next_season_key,
       round(a.peak_value, 6) AS peak_value, round(b.peak_value, 6) AS y_next
FROM seasons a JOIN seasons b
  ON b.fam_key = a.fam_key AND b.SeasonLabel = a.SeasonLabel AND b.SeasonYear = a.SeasonYear + 1""")


def _next_cols(df: DataFrame) -> DataFrame:
    return df.select("fam_key", "season_key", "next_season_key", r6("peak_value").alias("peak_value"),
                     r6("y_next").alias("y_next"))


@register("j1_next_season_targets", _NEXT_SQL)
def j1_next_season_targets(spark, sf):
    return _next_cols(next_season_targets_join(family_season_peaks(core.prepared(spark, sf))))


@register("w4_next_season_frame", _NEXT_SQL)
def w4_next_season_frame(spark, sf):
    return _next_cols(next_season_targets_frame(family_season_peaks(core.prepared(spark, sf))))


# ---- 2.7 / 2.10: sequences and windows -----------------------------------------------------

@register("v1_season_sequences", O.with_ctes(*CORE, body=f"""
, ranked AS (
  SELECT fam_key, season_key, value, Wind,
         row_number() OVER w AS rn, date, lead(date) OVER w AS prev_date
  FROM marks WINDOW w AS (PARTITION BY fam_key, season_key ORDER BY date DESC, {O.ORD_DESC}))
SELECT fam_key, season_key, CAST(32 - rn AS INTEGER) AS step, round(value, 6) AS value,
       CAST(greatest(coalesce(date_diff('day', prev_date, date), 0), 0) AS DOUBLE) AS gap,
       round({O.wind_sql('Wind')}, 6) AS wind
FROM ranked WHERE rn <= 32""").replace("\n, ranked", ",\nranked"))
def v1_season_sequences(spark, sf):
    rows = last_marks(core.prepared(spark, sf), seqlen=core.SEQLEN)
    return rows.select("fam_key", "season_key", "step", r6("value").alias("value"), "gap", r6("wind").alias("wind"))


@register("w3_history_window", O.with_ctes(*WINDOW_CTES, body="""
SELECT t.fam_key, t.season_key AS target_season_key, CAST(h.i - t.i + 3 AS INTEGER) AS slot,
       h.season_key AS hist_season_key, """ + O.LABEL_ID.replace("SeasonLabel", "h.SeasonLabel") + """ AS label_id,
       h.length
FROM targets t JOIN idx h ON h.fam_key = t.fam_key AND h.i BETWEEN t.i - 3 AND t.i"""))
def w3_history_window(spark, sf):
    s = core.samples(spark, sf, with_seq=False)
    return explode_window(s)


@register("v8_window_samples", O.with_ctes(*WINDOW_CTES, body="""
SELECT fam_key, season_key, SeasonYear, SeasonLabel, Gender, family, event, round(peak_value, 6) AS peak_value,
       round(y, 6) AS y, n_seasons
FROM samples"""))
def v8_window_samples(spark, sf):
    s = core.samples(spark, sf, with_seq=True)
    return s.select("fam_key", "season_key", "SeasonYear", "SeasonLabel", "Gender", "family", "event",
                    r6("peak_value").alias("peak_value"), r6("y").alias("y"), "n_seasons")


# ---- 2.3 / 2.5 / 2.11: training set --------------------------------------------------------

@register("a11_event_stats", O.with_ctes(*TRAIN_CTES, body="""
SELECT a.Gender, a.event, CAST(a.n_train AS BIGINT) AS n_train, i.event_id, round(st.mu, 6) AS mu, round(st.sd, 6) AS sd
FROM allowed a JOIN ids i USING (Gender, event) JOIN stats st USING (Gender, event)"""))
def a11_event_stats(spark, sf):
    s = time_split(core.materialize(core.samples(spark, sf, with_seq=False), "samples"))
    allowed = allowed_events(s)
    kept = s.join(allowed.select("Gender", "event"), ["Gender", "event"], "left_semi")
    return (allowed.join(event_ids(allowed), ["Gender", "event"]).join(event_stats(kept), ["Gender", "event"])
            .select("Gender", "event", "n_train", "event_id", r6("mu").alias("mu"), r6("sd").alias("sd")))


@register("m1_training_set", O.with_ctes(*TRAIN_CTES, body="""
SELECT fam_key, season_key, Gender, event, split, event_id, round(y, 6) AS y, round(z, 6) AS z FROM tset"""))
def m1_training_set(spark, sf):
    t = core.training(spark, sf)
    return t.select("fam_key", "season_key", "Gender", "event", "split", "event_id", r6("y").alias("y"),
                    r6("z").alias("z"))


# ---- 2.1 / 2.3 / 2.5 / 2.8: inspection of the raw mark table ------------------------------

from ..operators.clean import typed_layout  # noqa: E402
from ..operators.inspect import counts_by, head, mark_filters, max_string_lengths, summary  # noqa: E402
from ..sources.fixture import ORDINAL_COLS, raw_marks  # noqa: E402
from ..sources.layout import STRING_COLUMNS  # noqa: E402

_TYPED_SQL = """
typed AS (
  SELECT Division, School, Gender, SeasonLabel, CAST(SeasonYear AS INTEGER) AS SeasonYear, -1 AS ListHnd,
         -1 AS SeasonHnd, '' AS SourceURL, '' AS Team, Event, Athlete, '' AS ClassYear, MarkOrTime, Wind, Meet,
         MeetDate
  FROM raw_marks)"""


@register("s4_typed_layout", O.with_ctes(O.RAW_MARKS, _TYPED_SQL, body="SELECT * FROM typed"))
def s4_typed_layout(spark, sf):
    return typed_layout(raw_marks(spark, sf))


def _top_sql(keys: list[str], k: int) -> str:
    ks = ", ".join(keys)
    return O.with_ctes(O.RAW_MARKS, body=f"""
SELECT {ks}, count(*) AS count FROM raw_marks GROUP BY {ks}
ORDER BY count DESC, {", ".join(f"{c} ASC NULLS LAST" for c in keys)} LIMIT {k}""")


@register("a6_counts_by_year_season_gender", _top_sql(["SeasonYear", "SeasonLabel", "Gender"], 15))
def a6_counts_by_year_season_gender(spark, sf):
    return counts_by(raw_marks(spark, sf), ["SeasonYear", "SeasonLabel", "Gender"], 15)


@register("a7_top_events", _top_sql(["Event"], 50))
def a7_top_events(spark, sf):
    return counts_by(raw_marks(spark, sf), ["Event"], 50)


@register("a8_top_schools", _top_sql(["School"], 10))
def a8_top_schools(spark, sf):
    return counts_by(raw_marks(spark, sf), ["School"], 10)


@register("a15_dataset_summary", O.with_ctes(O.RAW_MARKS, _TYPED_SQL, body="""
SELECT count(*) AS n_rows, 16 AS n_columns FROM typed"""))
def a15_dataset_summary(spark, sf):
    return summary(typed_layout(raw_marks(spark, sf)))


@register("o3_sample_head", O.with_ctes(O.RAW_MARKS, body=f"""
SELECT {O.ORD}, SeasonYear, SeasonLabel, Gender, Division, School, Event, Athlete, MarkOrTime, Wind, Meet, MeetDate
FROM raw_marks ORDER BY {O.ORD} LIMIT 10"""))
def o3_sample_head(spark, sf):
    return head(raw_marks(spark, sf), ORDINAL_COLS, 10)


@register("c21_max_lengths", O.with_ctes(O.RAW_MARKS, _TYPED_SQL, body="SELECT " + ", ".join(
    f"CAST(greatest(1, coalesce(max(length({c})), 1)) AS INTEGER) AS {c}" for c in STRING_COLUMNS) + " FROM typed"))
def c21_max_lengths(spark, sf):
    return max_string_lengths(typed_layout(raw_marks(spark, sf)), STRING_COLUMNS)


_FILTERS = dict(year=2022, season="outdoors", gender="MEN", school="school [1-3]", event="meters",
                athlete="athlete 1")


@register("f7_filtered_marks", O.with_ctes(O.RAW_MARKS, body=f"""
SELECT * FROM raw_marks
WHERE SeasonYear = 2022 AND lower(SeasonLabel) = lower('outdoors') AND lower(Gender) = lower('MEN')
  AND coalesce(regexp_matches(School, '(?i)school [1-3]'), false)
  AND coalesce(regexp_matches(Event, '(?i)meters'), false)
  AND coalesce(regexp_matches(Athlete, '(?i)athlete 1'), false)"""))
def f7_filtered_marks(spark, sf):
    return mark_filters(raw_marks(spark, sf), **_FILTERS)


@register("a9_task_lists", O.with_ctes(*CORE, body="""
SELECT DISTINCT Event, Gender, SeasonLabel FROM marks"""))
def a9_task_lists(spark, sf):
    return core.prepared(spark, sf).select("Event", "Gender", "SeasonLabel").distinct()


# ---- 2.2: pages, anchors, catalogue ---------------------------------------------------------

from ..functions import gender_from_url, slug, url_has_required_query, url_query_param  # noqa: E402
from ..functions.text import PY_WHITESPACE  # noqa: E402
from ..operators.catalogue import SITE, anchors, build_catalogue, valid_catalogue  # noqa: E402
from ..operators.pages import page_rows, pages_without_rows  # noqa: E402
from ..sources.fixture import read_table  # noqa: E402
from ..sources.layout import SEASONS  # noqa: E402
from ..sources.rendered import division_pages, nested_variant, result_pages  # noqa: E402

_WS = O.WS_SQL


_ANCHOR_SQL = r"""(?s)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)')[^>]*>(.*?)</a>""".replace("'", "''")


@register("p1_page_anchors", f"""
WITH a AS (
  SELECT page_id, generate_subscripts(h, 1) - 1 AS pos, concat(unnest(h), unnest(g)) AS href, unnest(t) AS inner_html
  FROM (SELECT page_id, regexp_extract_all(html, '{_ANCHOR_SQL}', 1) AS h, regexp_extract_all(html, '{_ANCHOR_SQL}', 2) AS g,
               regexp_extract_all(html, '{_ANCHOR_SQL}', 3) AS t FROM pages))
SELECT page_id, CAST(pos AS INTEGER) AS pos, {O.decode_sql('href')} AS href, text FROM (
  SELECT *, {O.node_text_sql('inner_html')} AS text FROM a)
WHERE text <> ''""")
def p1_page_anchors(spark, sf):
    return anchors(read_table(spark, sf, "pages").select("page_id", "html"))


def _param_sql(name: str) -> str:
    return f"regexp_extract('&' || q, '&{name}=([^&]*)', 1)"


@register("p10_url_params", f"""
SELECT page_id, url, {_param_sql('page')} AS page_param, {_param_sql('ref')} AS ref_param,
       {_param_sql('list_hnd')} AS list_hnd,
       regexp_matches({_param_sql('list_hnd')}, '^[0-9]+$') AND regexp_matches({_param_sql('season_hnd')}, '^[0-9]+$')
         AS has_required_query,
       CASE WHEN contains(url, '_m_') THEN 'Men' WHEN contains(url, '_f_') OR contains(url, '_w_') THEN 'Women'
            ELSE 'Unknown' END AS url_gender
FROM (SELECT *, regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q FROM pages)""")
def p10_url_params(spark, sf):
    u = F.col("url")
    return read_table(spark, sf, "pages").select(
        "page_id", "url", url_query_param(u, "page").alias("page_param"), url_query_param(u, "ref").alias("ref_param"),
        url_query_param(u, "list_hnd").alias("list_hnd"), url_has_required_query(u).alias("has_required_query"),
        gender_from_url(u).alias("url_gender"))


_SEASON_VALUES = ", ".join(f"({y}, '{lab}', {lh}, {sh})" for y, lab, lh, sh in SEASONS)

_CATALOGUE_SQL = f"""
WITH t AS (
  SELECT s_suppkey AS k, s_name,
         CASE s_suppkey % 3 WHEN 0 THEN 'NCAA Division I' WHEN 1 THEN 'NCAA Division II' ELSE 'NCAA Division III' END
           AS division,
         chr(CAST(65 + s_nationkey % 26 AS INTEGER)) || chr(CAST(65 + (s_nationkey * 7 + 3) % 26 AS INTEGER)) AS st,
         regexp_replace(s_name, '[^A-Za-z0-9]+', '_', 'g') AS sl
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 11 <> 0),
teams AS (
  SELECT division, CASE WHEN k % 7 = 0 THEN s_name || ' (Men)' ELSE s_name END AS school, 'Men' AS gender,
         st || '_college_m_' || sl || '.html' AS tail FROM t
  UNION ALL
  SELECT division, s_name, 'Women', st || '_college_' || CASE WHEN k % 13 = 0 THEN 'w' ELSE 'f' END || '_' || sl || '.html'
  FROM t),
seasons(year, season, lh, sh) AS (VALUES {_SEASON_VALUES})
SELECT division, school, gender, year, season,
       '{SITE}/all_performances/' || tail || '?list_hnd=' || CAST(lh AS VARCHAR) || '&season_hnd='
         || CAST(sh AS VARCHAR) AS url
FROM teams CROSS JOIN seasons"""


@register("p5_result_urls", _CATALOGUE_SQL)
def p5_result_urls(spark, sf):
    pages = division_pages(read_table(spark, sf, "supplier"), read_table(spark, sf, "nation"))
    return valid_catalogue(build_catalogue(pages))


_RAW_ROW_COLS = "Division, School, Gender, SeasonLabel, SeasonYear, Event"
_CLASS_YEAR_SQL = "CASE line_no % 4 WHEN 0 THEN 'FR-1' WHEN 1 THEN 'SO-2' WHEN 2 THEN 'JR-3' ELSE 'SR-4' END"


def captured_pages(spark, sf) -> DataFrame:
    """Rendered result pages joined to their catalogue rows, stored as a table (as captured pages are)."""
    pages, cat = result_pages(raw_marks(spark, sf))
    return core.materialize(pages.join(cat, "url"), "pages", core.PAGE_FILES)


def _round_trip(spark, sf, mode: str) -> DataFrame:
    rows = page_rows(captured_pages(spark, sf), mode=mode)
    return rows.select("Division", "School", "Team", "Gender", "SeasonLabel", "SeasonYear", "Event", "Athlete", "ClassYear",
                       "MarkOrTime", "Wind", "Meet", "MeetDate")


@register("p14_page_rows", O.with_ctes(O.RAW_MARKS, body=f"""
SELECT {_RAW_ROW_COLS}, School AS Team, trim(Athlete, {_WS}) AS Athlete, {_CLASS_YEAR_SQL} AS ClassYear, MarkOrTime, Wind, Meet,
       MeetDate
FROM raw_marks"""))
def p14_page_rows(spark, sf):
    return _round_trip(spark, sf, "npy")


@register("p20_page_rows_csv_mode", O.with_ctes(O.RAW_MARKS, body=f"""
SELECT {_RAW_ROW_COLS}, School AS Team, trim(Athlete, {_WS}) AS Athlete, {_CLASS_YEAR_SQL} AS ClassYear,
       CASE WHEN (ord_key + line_no) % 5 = 1 THEN '' ELSE MarkOrTime END AS MarkOrTime, Wind, Meet, MeetDate
FROM raw_marks"""))
def p20_page_rows_csv_mode(spark, sf):
    return _round_trip(spark, sf, "csv")


@register("p16_nested_markup", SQL["p14_page_rows"])
def p16_nested_markup(spark, sf):
    """Nested divs, comments, scripts, bare attribute values and stray cells change nothing in the rows."""
    pages, cat = result_pages(raw_marks(spark, sf))
    pages = pages.withColumn("html", nested_variant(F.col("html"), F.pmod(F.xxhash64("page_id"), F.lit(5))))
    rows = page_rows(core.materialize(pages.join(cat, "url"), "nested-pages", core.PAGE_FILES))
    return rows.select("Division", "School", "Team", "Gender", "SeasonLabel", "SeasonYear", "Event", "Athlete", "ClassYear",
                       "MarkOrTime", "Wind", "Meet", "MeetDate")


@register("p12_inferred_page_meta", O.with_ctes(O.RAW_MARKS, body="""
SELECT DISTINCT School, Gender, Division FROM raw_marks"""))
def p12_inferred_page_meta(spark, sf):
    pages, _ = result_pages(raw_marks(spark, sf))
    return page_rows(pages, meta_cols=False).select("School", "Gender", "Division").distinct()


@register("p23_pages_without_rows", O.with_ctes(O.RAW_MARKS, body="""
SELECT DISTINCT Division, School, Gender, SeasonYear, SeasonLabel FROM raw_marks WHERE SeasonLabel = 'Indoors' AND SeasonYear % 2 = 0"""))
def p23_pages_without_rows(spark, sf):
    """Pages of some seasons come without rows (their row classes are another page kind's); those are found."""
    pages, cat = result_pages(raw_marks(spark, sf))
    c = pages.join(cat, "url")
    blank = (F.col("season") == "Indoors") & (F.col("year") % 2 == 0)
    c = c.withColumn("html", F.when(blank, F.regexp_replace("html", "performance-list-row", "performance-list-rows")).otherwise(F.col("html")))
    return pages_without_rows(c).select(F.col("division").alias("Division"), F.col("school").alias("School"), F.col("gender").alias("Gender"),
                                        F.col("year").alias("SeasonYear"), F.col("season").alias("SeasonLabel")).distinct()


@register("p22_event_slugs", O.with_ctes(O.RAW_MARKS, body="""
SELECT DISTINCT Event, trim(regexp_replace(Event, '[^A-Za-z0-9]+', '_', 'g'), '_') AS slug FROM raw_marks"""))
def p22_event_slugs(spark, sf):
    return raw_marks(spark, sf).select("Event", slug(F.col("Event")).alias("slug")).distinct()


# ---- 2.11 / 2.5 / 2.10: forecasting, metrics, scoring ---------------------------------------

from ..functions.events import FIELD_KEYWORDS, TIME_KEYWORDS  # noqa: E402
from ..operators import forecast as FC  # noqa: E402


def _r4(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


@register("m8_persistence_metrics", O.with_ctes(*TRAIN_CTES, body="""
SELECT Gender, event, round(avg(abs(peak_value - y)), 6) AS val_mae, count(*) AS n
FROM tset WHERE split = 'val' GROUP BY Gender, event"""))
def m8_persistence_metrics(spark, sf):
    m = FC.per_event_mae(FC.persistence(core.training(spark, sf)))
    return m.select("Gender", "event", r6("val_mae").alias("val_mae"), "n")


@register("a12_overall_mae", O.with_ctes(*TRAIN_CTES, body="""
SELECT Gender, round(coalesce(avg(CASE WHEN split = 'val' THEN abs(peak_value - y) END), CAST('nan' AS DOUBLE)), 6)
         AS overall_val_mae
FROM tset GROUP BY Gender"""))
def a12_overall_mae(spark, sf):
    o = FC.overall_mae(FC.persistence(core.training(spark, sf)))
    return o.select("Gender", r6("overall_val_mae").alias("overall_val_mae"))


from ..functions.events import FIELD_EVENTS, RUN_EVENTS  # noqa: E402

_METRIC_EVENTS = [*RUN_EVENTS, *FIELD_EVENTS]


@register("a14_wide_metrics", O.with_ctes(*TRAIN_CTES, """
per_event AS (SELECT Gender, event, avg(abs(peak_value - y)) AS val_mae FROM tset WHERE split = 'val' GROUP BY Gender, event)""", body="""
SELECT t.Gender, round(coalesce(avg(CASE WHEN split = 'val' THEN abs(peak_value - y) END), CAST('nan' AS DOUBLE)), 6) AS overall_val_mae,
       count(DISTINCT t.event) AS n_events, """ + ", ".join(
    f"""(SELECT round(p.val_mae, 6) FROM per_event p WHERE p.Gender = t.Gender AND p.event = '{e}') AS "ValMAE_{e}\"""" for e in _METRIC_EVENTS)
    + " FROM tset t GROUP BY t.Gender"))
def a14_wide_metrics(spark, sf):
    pred = FC.persistence(core.training(spark, sf))
    n_ev = pred.groupBy("Gender").agg(F.countDistinct("event").alias("n_events"))
    w = FC.wide_metrics(FC.per_event_mae(pred), FC.overall_mae(pred), n_ev, _METRIC_EVENTS)
    return w.select("Gender", r6("overall_val_mae").alias("overall_val_mae"), "n_events",
                    *(F.round(F.col(f"`ValMAE_{e}`"), 6).alias(f"ValMAE_{e}") for e in _METRIC_EVENTS))


@register("a17_task_counts", O.with_ctes(*WINDOW_CTES, body="""
SELECT event, Gender, SeasonLabel,
       count(*) FILTER (WHERE SeasonYear <= 2023) AS n_train, count(*) FILTER (WHERE SeasonYear = 2024) AS n_val,
       CAST(0 AS BIGINT) AS n_test
FROM samples GROUP BY event, Gender, SeasonLabel"""))
def a17_task_counts(spark, sf):
    from ..operators.training import task_counts, time_split
    return task_counts(time_split(core.materialize(core.samples(spark, sf, with_seq=False), "samples")), FC.TASK_KEYS)


_MODEL_CTES = TRAIN_CTES + ("""
models AS (
  SELECT event, Gender, SeasonLabel, count(*) AS n_train,
         coalesce(regr_slope(y, peak_value), 0.0) AS slope,
         coalesce(regr_intercept(y, peak_value), avg(y)) AS intercept
  FROM tset WHERE split = 'train' GROUP BY event, Gender, SeasonLabel HAVING count(*) >= 60)""",)


@register("m3_task_models", O.with_ctes(*_MODEL_CTES, body="""
SELECT event, Gender, SeasonLabel, n_train, round(slope, 4) AS slope, round(intercept, 4) AS intercept FROM models"""))
def m3_task_models(spark, sf):
    m = FC.fit_task_models(core.training(spark, sf))
    return m.select(*FC.TASK_KEYS, "n_train", _r4("slope").alias("slope"), _r4("intercept").alias("intercept"))


@register("m3_task_metrics", O.with_ctes(*_MODEL_CTES, body="""
SELECT t.event, t.Gender, t.SeasonLabel, round(avg(abs(m.intercept + m.slope * t.peak_value - t.y)), 4) AS val_mae,
       count(*) AS n
FROM tset t JOIN models m USING (event, Gender, SeasonLabel) WHERE t.split = 'val'
GROUP BY t.event, t.Gender, t.SeasonLabel"""))
def m3_task_metrics(spark, sf):
    ts = core.training(spark, sf)
    scored = FC.score_task_models(ts, FC.fit_task_models(ts))
    return (scored.filter(F.col("split") == "val").groupBy(*FC.TASK_KEYS)
            .agg(_r4(F.avg(F.abs(F.col("yhat") - F.col("y")))).alias("val_mae"), F.count(F.lit(1)).alias("n")))


def _is_time_event_sql(c: str) -> str:
    lo = f"lower({c})"
    field = " OR ".join(f"contains({lo}, '{k}')" for k in FIELD_KEYWORDS)
    time = " OR ".join(f"contains({lo}, '{k}')" for k in TIME_KEYWORDS)
    return (f"(CASE WHEN {field} THEN false WHEN {time} THEN true "
            f"ELSE coalesce(regexp_matches({lo}, '\\d+\\s*m'), false) END)")


def _fmt_sql(v: str, ev: str) -> str:
    fin = f"({v} IS NOT NULL AND NOT isnan({v}) AND abs({v}) < CAST('inf' AS DOUBLE))"
    mins = f"floor({v} / 60)"
    return (f"CASE WHEN NOT {fin} THEN 'n/a' WHEN {_is_time_event_sql(ev)} THEN "
            f"(CASE WHEN {v} >= 60 THEN printf('%d:%05.2f', CAST({mins} AS BIGINT), {v} - {mins} * 60) "
            f"ELSE printf('%.2fs', {v}) END) ELSE printf('%.2f m', {v}) END")


@register("c16_formatted_peaks", O.with_ctes(*SEASON_CTES, body=f"""
SELECT fam_key, season_key, event_used, {_fmt_sql('peak_value', 'event_used')} AS peak_text FROM seasons"""))
def c16_formatted_peaks(spark, sf):
    s = core.build_seasons(core.prepared(spark, sf), with_seq=False)
    return s.select("fam_key", "season_key", "event_used",
                    FC.format_forecast(F.col("peak_value"), F.col("event_used")).alias("peak_text"))


@register("m6_batch_forecast", O.with_ctes(*_MODEL_CTES, f"""
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY fam_key ORDER BY SeasonYear DESC, {O.LABEL_ORDER} DESC NULLS FIRST,
                                  SeasonLabel DESC) AS r
    FROM seasons) WHERE r = 1),
scored AS (
  SELECT l.fam_key, l.season_key, l.event_used AS event, m.intercept + m.slope * l.peak_value AS yhat
  FROM latest l JOIN models m ON m.event = l.event_used AND m.Gender = l.Gender AND m.SeasonLabel = l.SeasonLabel)""",
    body=f"SELECT fam_key, season_key, event, round(yhat, 4) AS yhat, {_fmt_sql('round(yhat, 4)', 'event')} "
         "AS forecast_text FROM scored"))
def m6_batch_forecast(spark, sf):
    marks = core.prepared(spark, sf)
    seasons = core.build_seasons(marks, with_seq=False)
    ts = core.training(spark, sf)
    models = FC.fit_task_models(ts)
    latest = FC.latest_seasons(seasons).withColumnRenamed("event_used", "event")
    scored = FC.score_task_models(latest, models).withColumn("yhat", _r4("yhat"))
    return scored.select("fam_key", "season_key", "event", "yhat",
                         FC.format_forecast(F.col("yhat"), F.col("event")).alias("forecast_text"))


def _submissions(spark, sf) -> DataFrame:
    r = raw_marks(spark, sf)
    sid = F.concat_ws("|", F.lower(F.trim("Athlete")), "Gender", "Event", F.col("SeasonYear").cast("string"),
                      "SeasonLabel")
    return r.select(sid.alias("submission_id"), F.col("Gender").alias("gender"),
                    F.col("SeasonLabel").alias("season_label"), F.col("Event").alias("event"),
                    F.struct(*ORDINAL_COLS).alias("mark_no"), F.col("MeetDate").alias("date_text"),
                    F.col("MarkOrTime").alias("mark"), F.col("Wind").alias("wind"))


_TIME_LIKE = r"^\s*(?:([0-9]+):)?([0-9]+)(?:\.([0-9]+))?\s*$"


def _parse_float_sql(c: str) -> str:
    t = f"replace(replace(lower({O.strip(c)}), 'm/s', ''), 'm', '')"
    return f"(CASE WHEN regexp_matches({t}, '{O.FLOAT}') THEN TRY_CAST(trim({t}) AS DOUBLE) END)"


_SUBS_SQL = f"""
subs AS (
  SELECT lower(trim(Athlete)) || '|' || Gender || '|' || Event || '|' || CAST(SeasonYear AS VARCHAR) || '|' || SeasonLabel
           AS submission_id,
         Gender AS gender, SeasonLabel AS season_label, Event AS event, ord_key, line_no, part_key, supp_key,
         {O.DATE_SQL.replace('MeetDate', 'trim(MeetDate, ' + O.WS_SQL + ')')} AS date,
         coalesce(CASE WHEN {_is_time_event_sql('Event')} AND regexp_matches(trim(MarkOrTime, {O.WS_SQL}), '{_TIME_LIKE}')
                  THEN coalesce(60.0 * TRY_CAST(nullif(regexp_extract(trim(MarkOrTime, {O.WS_SQL}), '{_TIME_LIKE}', 1), '')
                                                AS DOUBLE), 0.0)
                       + TRY_CAST(regexp_extract(trim(MarkOrTime, {O.WS_SQL}), '{_TIME_LIKE}', 2) AS DOUBLE)
                       + coalesce(TRY_CAST('0.' || nullif(regexp_extract(trim(MarkOrTime, {O.WS_SQL}), '{_TIME_LIKE}', 3), '')
                                           AS DOUBLE), 0.0) END,
                  {_parse_float_sql('MarkOrTime')}) AS value,
         CASE WHEN SeasonLabel = 'Indoors' THEN 0.0 ELSE coalesce({_parse_float_sql(
             "replace(replace(replace(" + O.strip('Wind') + ", 'm/s', ''), '(', ''), ')', '')")}, 0.0) END AS wind
  FROM raw_marks),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY submission_id ORDER BY coalesce(date, DATE '2000-01-01') DESC,
                                 ord_key DESC, line_no DESC, part_key DESC, supp_key DESC) AS rn,
         last_value(date IGNORE NULLS) OVER (PARTITION BY submission_id ORDER BY coalesce(date, DATE '2000-01-01'),
             ord_key, line_no, part_key, supp_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_dated
  FROM subs WHERE value IS NOT NULL)"""


@register("v9_scoring_blocks", O.with_ctes(O.RAW_MARKS, _SUBS_SQL, body="""
SELECT submission_id, CAST(32 - rn AS INTEGER) AS step, round(value, 6) AS value,
       CAST(CASE WHEN date IS NULL THEN 0 ELSE coalesce(greatest(date_diff('day', prev_dated, date), 0), 0) END AS DOUBLE)
         AS gap,
       round(wind, 6) AS wind
FROM ordered WHERE rn <= 32"""))
def v9_scoring_blocks(spark, sf):
    b = FC.scoring_blocks(_submissions(spark, sf))
    return b.select("submission_id", "step", r6("value").alias("value"), "gap", r6("wind").alias("wind"))


@register("v10_scoring_rejects", O.with_ctes(*TRAIN_CTES, body="""
SELECT DISTINCT lower(trim(Athlete)) || '|' || Gender || '|' || Event || '|' || CAST(SeasonYear AS VARCHAR) || '|'
         || SeasonLabel AS submission_id, Gender AS gender, Event AS event
FROM raw_marks r WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.Gender = r.Gender AND a.event = r.Event)"""))
def v10_scoring_rejects(spark, sf):
    from ..operators.training import allowed_events, time_split
    subs = _submissions(spark, sf)
    allowed = allowed_events(time_split(core.materialize(core.samples(spark, sf, with_seq=False), "samples")))
    blocks = FC.scoring_blocks(subs)
    _, rejects = FC.scoring_window(blocks, subs, allowed)
    return rejects.select("submission_id", "gender", "event")


@register("m2_gbt_forecast")
def m2_gbt_forecast(spark, sf):
    ts = core.training(spark, sf, with_seq=True)
    pred = FC.gbt_forecast(ts)
    return FC.per_event_mae(pred).select("Gender", "event", r6("val_mae").alias("val_mae"), "n")


# ---- 2.12: streaming (stream result = batch result) -----------------------------------------

from ..session import scratch_path  # noqa: E402
from ..streaming.ingest import ingest_pages, stage_files  # noqa: E402
from ..streaming.peaks import read_peaks, stream_peaks  # noqa: E402

RAW_SCHEMA_DDL = ("ord_key long, line_no int, part_key long, supp_key long, School string, Division string, "
                  "Gender string, SeasonLabel string, SeasonYear int, Event string, Athlete string, "
                  "MarkOrTime string, Wind string, Meet string, MeetDate string")


@register("st1_stream_ingest", SQL["p14_page_rows"])
def st1_stream_ingest(spark, sf):
    base = scratch_path(spark, "st1")
    pages, cat = result_pages(raw_marks(spark, sf))
    stage_files(pages.join(cat, "url"), f"{base}/in", 2000, core.PAGE_FILES)  # pages arriving as files
    ingest_pages(spark, f"{base}/in", f"{base}/out", f"{base}/chk", files_per_trigger=64).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "Division", "School", "Team", "Gender", "SeasonLabel", "SeasonYear", "Event", "Athlete", "ClassYear", "MarkOrTime",
        "Wind", "Meet", "MeetDate")


@register("st2_streaming_peaks", SQL["a3_family_season_peaks"])
def st2_streaming_peaks(spark, sf):
    base = scratch_path(spark, "st2")
    stage_files(raw_marks(spark, sf), f"{base}/in", 25_000)
    stream_peaks(spark, f"{base}/in", RAW_SCHEMA_DDL, ORDINAL_COLS, f"{base}/out", f"{base}/chk", files_per_trigger=16).awaitTermination()
    return read_peaks(spark, f"{base}/out").select("fam_key", "season_key", "SeasonYear", "SeasonLabel", "Gender", "family", "is_time",
                      r6("peak_value").alias("peak_value"))


# ---- 2.1: sources and sinks, as round trips over derived data -------------------------------

from ..sources import io as IO  # noqa: E402

CATALOGUE_COLS = ["division", "school", "gender", "year", "season", "url"]


@register("s1_catalogue_csv", _CATALOGUE_SQL)
def s1_catalogue_csv(spark, sf):
    base = scratch_path(spark, "s1")
    cat = p5_result_urls(spark, sf)
    IO.write_csv(cat.toDF(*[c.upper() for c in cat.columns]), f"{base}/catalogue")
    return IO.read_catalogue_csv(spark, f"{base}/catalogue").select(*CATALOGUE_COLS)





@register("s2_npy_roundtrip", SQL["s4_typed_layout"])
def s2_npy_roundtrip(spark, sf):
    base = scratch_path(spark, "s2")
    written = IO.write_npy(raw_marks(spark, sf), f"{base}/npy").collect()  # one summary row per file
    return IO.read_npy(spark, f"{base}/npy/*.npy")


@register("s6_saved_table", "SELECT * REPLACE (CAST(line_no AS BIGINT) AS line_no) FROM (" + SQL["f1_prepared_marks"] + ")")
def s6_saved_table(spark, sf):
    base = scratch_path(spark, "s6")
    IO.save_table(f1_prepared_marks(spark, sf), f"{base}/marks_prepared")
    t = IO.load_table(spark, f"{base}/marks_prepared")
    return t.select("ord_key", "line_no", "part_key", "supp_key", "fam_key", "season_key", "Event", "family", "date", "value",
                    "is_time")


@register("s9_model_metadata", O.with_ctes(*TRAIN_CTES, body="""
SELECT i.Gender AS gender, i.event, i.event_id, round(st.mu, 6) AS mu, round(st.sd, 6) AS sd
FROM ids i JOIN stats st USING (Gender, event)"""))
def s9_model_metadata(spark, sf):
    base = scratch_path(spark, "s9")
    ts = core.training(spark, sf)
    stats = ts.select("Gender", "event", "event_id", "mu", "sd").distinct()
    pred = FC.persistence(ts)
    IO.write_metadata(IO.build_metadata(stats, FC.per_event_mae(pred), FC.overall_mae(pred)), f"{base}/models")
    st = IO.metadata_event_stats(IO.read_metadata(spark, f"{base}/models"))
    return st.select("gender", "event", "event_id", r6("mu").alias("mu"), r6("sd").alias("sd"))


# ---- older per-event variant, event lookup, catalogue head ---------------------------------

from ..operators.lookup import resolve_events  # noqa: E402

_BETA_CTES = (O.RAW_MARKS, O.PREPARED_BETA)


@register("c9_event_level_targets", O.with_ctes(*_BETA_CTES, f"""
firsts AS (
  SELECT * FROM (SELECT key, season_key, SeasonYear, SeasonLabel, Event, Gender, is_time,
                        row_number() OVER (PARTITION BY key, season_key ORDER BY {O.ORD}) AS rn FROM marks)
  WHERE rn = 1),
agg AS (SELECT key, season_key, min(value) AS mn, max(value) AS mx FROM marks GROUP BY key, season_key),
peaks AS (
  SELECT f.key, f.season_key, f.SeasonYear, f.SeasonLabel, f.Event, f.Gender,
         CASE WHEN f.is_time THEN a.mn ELSE a.mx END AS peak_value
  FROM firsts f JOIN agg a USING (key, season_key))""", body="""
SELECT a.key, a.season_key, a.Event, round(a.peak_value, 6) AS peak_value, round(b.peak_value, 6) AS y_next
FROM peaks a JOIN peaks b ON b.key = a.key AND b.SeasonLabel = a.SeasonLabel AND b.SeasonYear = a.SeasonYear + 1"""))
def c9_event_level_targets(spark, sf):
    m = core.prepared(spark, sf, variant="event")
    p = family_season_peaks(m, key="key", attrs=("SeasonYear", "SeasonLabel", "Event", "Gender"))
    t = next_season_targets_join(p, key="key")
    return t.select("key", "season_key", "Event", r6("peak_value").alias("peak_value"), r6("y_next").alias("y_next"))


@register("c24_event_lookup", O.with_ctes(*TRAIN_CTES, """
req AS (
  SELECT DISTINCT gender, text FROM (
    SELECT Gender AS gender, Event AS text FROM raw_marks
    UNION ALL SELECT Gender, split_part(Event, ' ', 1) FROM raw_marks
    UNION ALL SELECT Gender, CAST(part_key % 30 AS VARCHAR) FROM raw_marks)),
pos AS (SELECT r.gender, r.text, i.event FROM req r JOIN ids i ON i.Gender = r.gender
          AND regexp_matches(r.text, '^[0-9]+$') AND TRY_CAST(r.text AS BIGINT) - 1 = i.event_id),
nam AS (SELECT r.gender, r.text, i.event FROM req r JOIN ids i ON i.Gender = r.gender AND r.text = i.event),
sub AS (SELECT r.gender, r.text, count(*) AS n, min(i.event) AS ev1 FROM req r JOIN ids i
          ON i.Gender = r.gender AND contains(lower(i.event), lower(r.text)) GROUP BY r.gender, r.text)""", body="""
SELECT r.gender, r.text, coalesce(p.event, n.event, CASE WHEN s.n = 1 THEN s.ev1 END) AS event,
       CASE WHEN coalesce(p.event, n.event, CASE WHEN s.n = 1 THEN s.ev1 END) IS NOT NULL THEN 'ok'
            WHEN s.n > 1 THEN 'ambiguous' ELSE 'not_found' END AS status
FROM req r LEFT JOIN pos p USING (gender, text) LEFT JOIN nam n USING (gender, text) LEFT JOIN sub s USING (gender, text)"""))
def c24_event_lookup(spark, sf):
    from ..operators.training import allowed_events, event_ids
    r = raw_marks(spark, sf)
    req = (r.select(F.col("Gender").alias("gender"), F.col("Event").alias("text"))
           .unionByName(r.select(F.col("Gender").alias("gender"), F.split("Event", " ").getItem(0).alias("text")))
           .unionByName(r.select(F.col("Gender").alias("gender"),
                                 F.pmod(F.col("part_key"), F.lit(30)).cast("string").alias("text"))))
    ts = core.materialize(core.samples(spark, sf, with_seq=False), "samples")
    ids = event_ids(allowed_events(time_split(ts)))
    return resolve_events(req, ids)


@register("o1_catalogue_head", "SELECT * FROM (" + _CATALOGUE_SQL + ") c "
          "ORDER BY division, school, gender, year DESC, season, url LIMIT 12")
def o1_catalogue_head(spark, sf):
    cat = p5_result_urls(spark, sf)
    return cat.orderBy("division", "school", "gender", F.col("year").desc(), "season", "url").limit(12)


@register("f8_partition_pruned_seasons", O.with_ctes(*SEASON_CTES, body="""
SELECT fam_key, season_key, Gender, SeasonYear, SeasonLabel, round(peak_value, 6) AS peak_value, length, event_used
FROM seasons WHERE Gender = 'Men' AND SeasonYear = 2022"""))
def f8_partition_pruned_seasons(spark, sf):
    """The season table persisted partitioned by (Gender, SeasonYear); a per-gender, per-year slice
    then reads only its partition folders (PartitionFilters on the scan)."""
    base = scratch_path(spark, "f8")
    seasons = core.build_seasons(core.prepared(spark, sf), with_seq=False)
    IO.save_table(seasons, f"{base}/seasons", partition_by=["Gender", "SeasonYear"])
    t = IO.load_table(spark, f"{base}/seasons").filter((F.col("Gender") == "Men") & (F.col("SeasonYear") == 2022))
    return t.select("fam_key", "season_key", "Gender", F.col("SeasonYear").cast("int").alias("SeasonYear"),
                    "SeasonLabel", r6("peak_value").alias("peak_value"), F.col("length").cast("int").alias("length"),
                    "event_used")


@register("w9_fallback_split_sizes", O.with_ctes(*WINDOW_CTES, body="""
SELECT Gender, split, count(*) AS n FROM (
  SELECT Gender, CASE WHEN r < floor(0.8 * n) THEN 'train' ELSE 'val' END AS split FROM (
    SELECT Gender, row_number() OVER (PARTITION BY Gender ORDER BY fam_key, season_key) - 1 AS r,
           count(*) OVER (PARTITION BY Gender) AS n
    FROM samples))
GROUP BY Gender, split"""))
def w9_fallback_split_sizes(spark, sf):
    """The no-training-year fallback (every sample year is past the training cut): exact 80 / 20
    sizes per gender from the seeded shuffle. Which rows land where is hash-chosen, the sizes are
    exact, so the oracle checks the sizes."""
    s = time_split(core.materialize(core.samples(spark, sf, with_seq=False), "samples"), train_max_year=1900, valid_year=1901)
    return s.groupBy("Gender", "split").agg(F.count(F.lit(1)).alias("n"))


@register("m3_event_task_metrics", O.with_ctes(*_BETA_CTES, f"""
firsts AS (
  SELECT * FROM (SELECT key, season_key, SeasonYear, SeasonLabel, Event, Gender, is_time,
                        row_number() OVER (PARTITION BY key, season_key ORDER BY {O.ORD}) AS rn FROM marks)
  WHERE rn = 1),
agg AS (SELECT key, season_key, min(value) AS mn, max(value) AS mx FROM marks GROUP BY key, season_key),
peaks AS (
  SELECT f.key, f.season_key, f.SeasonYear, f.SeasonLabel, f.Event, f.Gender,
         CASE WHEN f.is_time THEN a.mn ELSE a.mx END AS peak_value
  FROM firsts f JOIN agg a USING (key, season_key)),
targets AS (
  SELECT a.key, a.season_key, a.SeasonYear, a.SeasonLabel, a.Event AS event, a.Gender, a.peak_value, b.peak_value AS y,
         CASE WHEN a.SeasonYear <= 2023 THEN 'train' WHEN a.SeasonYear = 2024 THEN 'val' WHEN a.SeasonYear >= 2025
              THEN 'test' END AS split
  FROM peaks a JOIN peaks b ON b.key = a.key AND b.SeasonLabel = a.SeasonLabel AND b.SeasonYear = a.SeasonYear + 1),
models AS (
  SELECT event, Gender, SeasonLabel, coalesce(regr_slope(y, peak_value), 0.0) AS slope,
         coalesce(regr_intercept(y, peak_value), avg(y)) AS intercept
  FROM targets WHERE split = 'train' GROUP BY event, Gender, SeasonLabel HAVING count(*) >= 60)""", body="""
SELECT t.event, t.Gender, t.SeasonLabel, round(avg(abs(m.intercept + m.slope * t.peak_value - t.y)), 4) AS val_mae,
       count(*) AS n
FROM targets t JOIN models m USING (event, Gender, SeasonLabel) WHERE t.split = 'val'
GROUP BY t.event, t.Gender, t.SeasonLabel"""))
def m3_event_task_metrics(spark, sf):
    """Per-event models: event-level targets, per-task split (random fallback for thin tasks),
    one regression per (event, gender, season label), validation MAE per task."""
    from ..operators.training import task_split
    m = core.prepared(spark, sf, variant="event")
    p = family_season_peaks(m, key="key", attrs=("SeasonYear", "SeasonLabel", "Event", "Gender"))
    t = (next_season_targets_join(core.materialize(p, "event_peaks"), key="key").withColumnRenamed("y_next", "y")
         .withColumnRenamed("Event", "event"))
    # The split reads the targets several times, the join the peaks twice: each is computed and written once.
    t = core.materialize(task_split(core.materialize(t, "event_targets"), FC.TASK_KEYS, min_train=60), "event_split")
    scored = FC.score_task_models(t, FC.fit_task_models(t))
    return (scored.filter(F.col("split") == "val").groupBy(*FC.TASK_KEYS)
            .agg(_r4(F.avg(F.abs(F.col("yhat") - F.col("y")))).alias("val_mae"), F.count(F.lit(1)).alias("n")))
