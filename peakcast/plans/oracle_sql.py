"""Independent DuckDB SQL for the correctness gate.

Each query in the registry has an SQL twin built from the CTE fragments
below; the twin is written from the semantics (window ``row_number``,
``EXISTS``, range self-joins), not generated from the Spark plan.
Doubles are rounded to 6 decimals and dates rendered as text in both engines.
"""

from __future__ import annotations

from ..functions.events import EVENT_ALIASES, FIELD_EVENTS, RUN_EVENTS, SAME_NAME_FAMILIES
from ..functions.text import PY_WHITESPACE

# Character references that occur in the pages (decoded in order, the ampersand last).
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", chr(160)), ("&amp;", "&"))

NUM = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
TIME2 = rf"^\s*([+-]?[0-9]+)\s*:\s*({NUM})\s*$"
TIME3 = rf"^\s*([+-]?[0-9]+)\s*:\s*([+-]?[0-9]+)\s*:\s*({NUM})\s*$"
FLOAT = rf"^\s*{NUM}\s*$"
FTIN = r"^([0-9]{1,3})-([0-9]{1,2}(?:\.[0-9]+)?)$"
METRES = rf"^\s*({NUM})\s*m?$"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


# Python's whitespace set as a DuckDB expression (control characters spelled with chr()).
WS_SQL = "(" + " || ".join(f"chr({ord(ch)})" for ch in PY_WHITESPACE) + ")"


def strip(c: str) -> str:
    return f"trim({c}, {WS_SQL})"


RAW_MARKS = r"""
raw_l AS (
  SELECT l_orderkey ok, l_linenumber ln, l_partkey pk, l_suppkey sk, l_shipdate d,
         CAST(l_quantity AS bigint) qty,
         (l_partkey * 7919 + l_orderkey * 104729 + l_linenumber * 31) % 1000 AS h
  FROM lineitem),
raw_b AS (
  SELECT *, CAST(year(d) + 24 AS int) AS y, CAST(month(d) AS int) AS m, CAST(day(d) AS int) AS dd,
         pk % 16 AS ev, CASE WHEN sk % 2 = 0 THEN 'Men' ELSE 'Women' END AS g FROM raw_l),
raw_e AS (
  SELECT *, CASE WHEN m <= 3 THEN 'Indoors' ELSE 'Outdoors' END AS lab FROM raw_b),
raw_marks AS (
SELECT CAST(ok AS bigint) AS ord_key, CAST(ln AS int) AS line_no, CAST(pk AS bigint) AS part_key, CAST(sk AS bigint) AS supp_key,
  concat('School ', CAST(sk % 7 AS varchar(64))) AS School,
  CASE sk % 3 WHEN 0 THEN 'NCAA Division I' WHEN 1 THEN 'NCAA Division II' ELSE 'NCAA Division III' END AS Division,
  g AS Gender, lab AS SeasonLabel, y AS SeasonYear,
  CASE WHEN ev < 9 THEN (CASE WHEN lab = 'Indoors' THEN (CASE WHEN h % 5 = 0 THEN '60m' ELSE '60 Meters' END) ELSE '100 Meters' END)
       WHEN ev = 9 THEN (CASE WHEN lab = 'Indoors' THEN '60 Hurdles' WHEN g = 'Men' THEN '110h' ELSE '100 Hurdles' END)
       WHEN ev = 10 THEN (CASE WHEN lab = 'Indoors' THEN 'Mile' ELSE '1500 Meters' END)
       WHEN ev = 11 THEN '300 Meters' WHEN ev = 12 THEN '10,000 Meters'
       WHEN ev = 13 THEN 'High Jump' WHEN ev = 14 THEN 'Triple Jump' ELSE 'Shot Put' END AS Event,
  concat(CASE WHEN h % 2 = 0 THEN 'Athlete ' ELSE ' athlete ' END, CAST(sk AS varchar(64))) AS Athlete,
  CASE WHEN h % 97 = 0 THEN 'DNF' WHEN h % 89 = 0 THEN 'NM' WHEN h % 83 = 0 THEN ''
       WHEN ev < 9 THEN concat(CASE WHEN lab = 'Indoors' THEN '7.' ELSE '11.' END, lpad(CAST(h % 100 AS varchar(64)), 2, '0'))
       WHEN ev = 9 THEN concat('14.', lpad(CAST(h % 100 AS varchar(64)), 2, '0'))
       WHEN ev = 10 THEN concat('4:', lpad(CAST(h % 60 AS varchar(64)), 2, '0'), '.', lpad(CAST(qty AS varchar(64)), 2, '0'))
       WHEN ev = 11 THEN concat(CAST(34 + h % 9 AS varchar(64)), '.', lpad(CAST(qty AS varchar(64)), 2, '0'))
       WHEN ev = 12 THEN concat(CAST(31 + h % 5 AS varchar(64)), ':', lpad(CAST(h % 60 AS varchar(64)), 2, '0'), '.5')
       WHEN ev = 13 THEN concat(CAST(5 + h % 2 AS varchar(64)), '-', lpad(CAST(h % 12 AS varchar(64)), 2, '0'), '.25')
       WHEN ev = 14 THEN concat('13.', lpad(CAST(h % 100 AS varchar(64)), 2, '0'), 'm')
       ELSE concat('15.', lpad(CAST(h % 100 AS varchar(64)), 2, '0'), 'M') END AS MarkOrTime,
  CASE h % 6 WHEN 0 THEN concat('+', CAST(h % 3 AS varchar(64)), '.', CAST(h % 10 AS varchar(64)))
             WHEN 1 THEN concat('-0.', CAST(h % 10 AS varchar(64))) WHEN 2 THEN concat('1.', CAST(h % 10 AS varchar(64)), 'm/s')
             WHEN 3 THEN 'NWI' ELSE '' END AS Wind,
  concat('Meet ', CAST(ok % 50 AS varchar(64))) AS Meet,
  CASE WHEN h % 101 = 0 THEN 'TBD'
       WHEN h % 4 = 0 THEN concat(CAST(y AS varchar(64)), '-', lpad(CAST(m AS varchar(64)), 2, '0'), '-', lpad(CAST(dd AS varchar(64)), 2, '0'))
       WHEN h % 4 = 1 THEN concat(lpad(CAST(m AS varchar(64)), 2, '0'), '/', lpad(CAST(dd AS varchar(64)), 2, '0'), '/', CAST(y AS varchar(64)))
       WHEN h % 4 = 2 THEN concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', m * 3 - 2, 3), ' ', CAST(dd AS varchar(64)), ', ', CAST(y AS varchar(64)))
       ELSE concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', m * 3 - 2, 3), ' ', CAST(dd AS varchar(64)), ' ', CAST(y AS varchar(64))) END AS MeetDate
FROM raw_e)"""


def _alias_case(col: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in EVENT_ALIASES.items())
    return f"CASE lower({strip(col)}) {whens} END"


def _time(col: str) -> str:
    ns = f"replace({col}, ' ', '')"
    return f"""CASE WHEN {col} IS NULL OR {col} = '' THEN NULL
     WHEN lower({col}) IN ('dnf','dq','fs','nt','ns') THEN NULL
     WHEN regexp_matches({ns}, '{TIME2}') THEN TRY_CAST(regexp_extract({ns}, '{TIME2}', 1) AS BIGINT) * 60
          + TRY_CAST(regexp_extract({ns}, '{TIME2}', 2) AS DOUBLE)
     WHEN regexp_matches({ns}, '{TIME3}') THEN TRY_CAST(regexp_extract({ns}, '{TIME3}', 1) AS BIGINT) * 3600
          + TRY_CAST(regexp_extract({ns}, '{TIME3}', 2) AS BIGINT) * 60 + TRY_CAST(regexp_extract({ns}, '{TIME3}', 3) AS DOUBLE)
     WHEN NOT contains({ns}, ':') AND regexp_matches({ns}, '{FLOAT}') THEN TRY_CAST({ns} AS DOUBLE) END"""


def _dist(col: str) -> str:
    lo = f"lower({col})"
    return f"""CASE WHEN {col} IS NULL OR {col} = '' THEN NULL
     WHEN {lo} = 'nm' THEN NULL
     WHEN regexp_matches({lo}, '{FTIN}') THEN (TRY_CAST(regexp_extract({lo}, '{FTIN}', 1) AS BIGINT) * 12
          + TRY_CAST(regexp_extract({lo}, '{FTIN}', 2) AS DOUBLE)) * CAST(0.0254 AS DOUBLE)
     WHEN regexp_matches({lo}, '{METRES}') THEN TRY_CAST(regexp_extract({lo}, '{METRES}', 1) AS DOUBLE) END"""


def decode_sql(col: str) -> str:
    for ent, ch in HTML_ENTITIES:
        col = f"replace({col}, {_q(ent)}, {_q(ch)})"
    return col


def node_text_sql(col: str) -> str:
    """Text nodes stripped, empties dropped, joined by one space, entities decoded (SQL twin)."""
    dec = "x"
    for ent, ch in HTML_ENTITIES:
        dec = f"replace({dec}, {_q(ent)}, {_q(ch)})"
    return (f"array_to_string(list_filter(list_transform(string_split(regexp_replace({col}, '<[^>]*>', chr(1), 'g'), "
            f"chr(1)), lambda x: trim({dec}, {WS_SQL})), lambda x: x <> ''), ' ')")


def wind_sql(col: str) -> str:
    w = f"replace(replace({col}, '+', ''), 'm/s', '')"
    return f"coalesce(CASE WHEN regexp_matches({w}, '{FLOAT}') THEN TRY_CAST(trim({w}) AS DOUBLE) END, 0.0)"


DATE_SQL = ("CAST(coalesce(try_strptime(MeetDate, '%Y-%m-%d'), try_strptime(MeetDate, '%m/%d/%Y'), "
            "try_strptime(MeetDate, '%b %d, %Y'), try_strptime(MeetDate, '%b %d %Y')) AS DATE)")

STR_COLS = ["Division", "School", "Gender", "SeasonLabel", "Event", "Athlete", "MarkOrTime", "Wind", "Meet", "MeetDate"]
KNOWN = tuple(RUN_EVENTS) + tuple(FIELD_EVENTS)

def prepared_sql(beta: bool = False) -> str:
    """Cleaning in SQL; ``beta`` = the older variant (shorter run set and alias table, per-event key)."""
    from ..functions.events import EVENT_ALIASES_BETA, RUN_EVENTS_BETA
    run = RUN_EVENTS_BETA if beta else RUN_EVENTS
    aliases = EVENT_ALIASES_BETA if beta else EVENT_ALIASES
    known = tuple(run) + tuple(FIELD_EVENTS)
    alias_case = "CASE lower(" + strip("Event") + ") " + " ".join(
        f"WHEN {_q(k)} THEN {_q(v)}" for k, v in aliases.items()) + " END"
    keys = ("lower(Athlete) || '||' || lower(Event) || '||' || Gender AS key" if beta else
            "lower(Athlete) || '||' || Gender AS ath_key")
    family = "" if beta else f"""
         CASE WHEN Event IN {_in(SAME_NAME_FAMILIES)} THEN Event
              WHEN Event IN ('60 Meters', '100 Meters') THEN 'short_sprint'
              WHEN Event IN ('Mile', '1500 Meters') THEN 'metric_mile'
              WHEN Event = '60 Hurdles' THEN 'short_hurdles'
              WHEN Event = '110 Hurdles' AND starts_with(lower(Gender), 'men') THEN 'short_hurdles'
              WHEN Event = '100 Hurdles' AND starts_with(lower(Gender), 'women') THEN 'short_hurdles'
              ELSE Event END AS family,"""
    marks = ("""marks AS (
  SELECT *, row_number() OVER (ORDER BY ord_key, line_no, part_key, supp_key) AS gpos FROM prepared)""" if beta else
             """marks AS (
  SELECT *, ath_key || '||' || family AS fam_key,
         row_number() OVER (ORDER BY ord_key, line_no, part_key, supp_key) AS gpos
  FROM prepared)""")
    return f"""
p0 AS (
  SELECT ord_key, line_no, part_key, supp_key, CAST(SeasonYear AS INTEGER) AS SeasonYear,
         {", ".join(f"{strip(c)} AS {c}" for c in STR_COLS)}
  FROM raw_marks),
p1 AS (
  SELECT * REPLACE (CASE WHEN Event IN {_in(known)} THEN Event ELSE coalesce({alias_case}, Event) END AS Event)
  FROM p0),
p2 AS (
  SELECT *, {DATE_SQL} AS date, {_time('MarkOrTime')} AS _t, {_dist('MarkOrTime')} AS _d,
         Event IN {_in(run)} AS _run, Event IN {_in(FIELD_EVENTS)} AS _field
  FROM p1),
p3 AS (
  SELECT *,
    CASE WHEN _run THEN _t WHEN _field THEN _d
         WHEN _t IS NOT NULL AND (contains(coalesce(MarkOrTime, ''), ':') OR _t < 30) THEN _t ELSE _d END AS value,
    CASE WHEN _run THEN true WHEN _field THEN false
         WHEN _t IS NOT NULL AND (contains(coalesce(MarkOrTime, ''), ':') OR _t < 30) THEN true ELSE _d IS NULL END AS is_time
  FROM p2),
prepared AS (
  SELECT ord_key, line_no, part_key, supp_key, SeasonYear, Division, School, Gender, SeasonLabel, Event, Athlete,
         MarkOrTime, Wind, Meet, MeetDate, date, value, is_time,{family}
         {keys},
         CAST(SeasonYear AS VARCHAR) || '-' || SeasonLabel AS season_key
  FROM p3
  WHERE value IS NOT NULL AND NOT isnan(value) AND date IS NOT NULL AND Event IS NOT NULL
    AND Athlete IS NOT NULL AND SeasonLabel IS NOT NULL AND SeasonYear IS NOT NULL),
{marks}"""


PREPARED = prepared_sql(False)
PREPARED_BETA = prepared_sql(True)

ORD = "ord_key, line_no, part_key, supp_key"
ORD_DESC = "ord_key DESC, line_no DESC, part_key DESC, supp_key DESC"
LABEL_ORDER = "CASE SeasonLabel WHEN 'Indoors' THEN 0 WHEN 'Outdoors' THEN 1 END"
LABEL_ID = "coalesce(CASE SeasonLabel WHEN 'Indoors' THEN 0 WHEN 'Outdoors' THEN 1 END, 0)"

SEASONS = f"""
firsts AS (
  SELECT * FROM (
    SELECT fam_key, season_key, SeasonYear, SeasonLabel, Gender, family, is_time,
           row_number() OVER (PARTITION BY fam_key, season_key ORDER BY {ORD}) AS rn
    FROM marks) WHERE rn = 1),
ev_counts AS (
  SELECT fam_key, season_key, Event, count(*) AS n, min(gpos) AS first_pos
  FROM marks GROUP BY fam_key, season_key, Event),
modal AS (
  SELECT fam_key, season_key, Event AS event_used FROM (
    SELECT *, row_number() OVER (PARTITION BY fam_key, season_key ORDER BY n DESC, first_pos, Event) AS r
    FROM ev_counts) WHERE r = 1),
agg AS (
  SELECT fam_key, season_key, min(value) AS mn, max(value) AS mx, count(*) AS n_marks
  FROM marks GROUP BY fam_key, season_key),
seasons AS (
  SELECT f.fam_key, f.season_key, f.SeasonYear, f.SeasonLabel, f.Gender, f.family, f.is_time,
         CASE WHEN f.is_time THEN a.mn ELSE a.mx END AS peak_value,
         CAST(a.n_marks AS BIGINT) AS n_marks, CAST(least(a.n_marks, 32) AS INTEGER) AS length, m.event_used
  FROM firsts f JOIN agg a USING (fam_key, season_key) JOIN modal m USING (fam_key, season_key))"""

WINDOWS = f"""
idx AS (
  SELECT *, row_number() OVER (PARTITION BY fam_key ORDER BY SeasonYear, {LABEL_ORDER} NULLS LAST, SeasonLabel) AS i
  FROM seasons),
targets AS (
  SELECT a.*, b.peak_value AS y FROM idx a JOIN idx b
    ON b.fam_key = a.fam_key AND b.SeasonLabel = a.SeasonLabel AND b.SeasonYear = a.SeasonYear + 1),
samples AS (
  SELECT fam_key, season_key, SeasonYear, SeasonLabel, Gender, family, event_used AS event, peak_value, y,
         CAST(least(i, 4) AS INTEGER) AS n_seasons, i
  FROM targets)"""

TRAINING = f"""
split0 AS (
  SELECT *, CASE WHEN SeasonYear <= 2023 THEN 'train' WHEN SeasonYear = 2024 THEN 'val' END AS split FROM samples),
allowed AS (
  SELECT Gender, event, count(*) FILTER (WHERE split = 'train') AS n_train
  FROM split0 GROUP BY Gender, event HAVING count(*) FILTER (WHERE split = 'train') >= 60),
ids AS (
  SELECT Gender, event, CAST(row_number() OVER (PARTITION BY Gender ORDER BY event) - 1 AS INTEGER) AS event_id FROM allowed),
kept AS (SELECT s.* FROM split0 s WHERE EXISTS (SELECT 1 FROM allowed a WHERE a.Gender = s.Gender AND a.event = s.event)),
stats AS (
  SELECT Gender, event,
         CASE WHEN count(*) FILTER (WHERE split = 'train') > 0 THEN avg(y) FILTER (WHERE split = 'train') ELSE 0.0 END AS mu,
         CASE WHEN count(*) FILTER (WHERE split = 'train') = 0 THEN 1.0
              WHEN stddev_pop(y) FILTER (WHERE split = 'train') < 1e-6 THEN 1.0
              ELSE stddev_pop(y) FILTER (WHERE split = 'train') END AS sd
  FROM kept GROUP BY Gender, event),
tset AS (
  SELECT k.*, i.event_id, st.mu, st.sd, (k.y - st.mu) / st.sd AS z
  FROM kept k JOIN ids i USING (Gender, event) JOIN stats st USING (Gender, event))"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n" + body
