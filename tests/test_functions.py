"""Golden cases for the scalar functions (worked by hand from the rules in FIXTURES.md §4)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from peakcast.functions import (canonical_event, division_from_text, event_to_family, fmt_dist, fmt_time,
                                is_time_event, mark_to_numeric, parse_date, parse_distance_to_meters,
                                parse_float, parse_time_like, parse_time_to_seconds, slug,
                                team_and_gender_from_title, url_has_required_query, wind_mps)
from peakcast.functions.events import normalise_season_label, window_label_id
from peakcast.functions.marks import submitted_mark, submitted_wind
from peakcast.operators.catalogue import result_url

from .conftest import one_col


def approx(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_time_parse(spark):
    cases = {"1:50.32": 110.32, "1:02:03.5": 3723.5, "4:05 .2": 245.2, "10.55": 10.55, "DNF": None, "": None,
             "10.5h": None, "1:2:3:4": None, "dq": None, "1.5f": None, "1e1": 10.0, None: None}
    got = one_col(spark, list(cases), parse_time_to_seconds)
    for (k, v), g in zip(cases.items(), got):
        assert approx(g, v), (k, g, v)


def test_distance_parse(spark):
    cases = {"13.31m": 13.31, "15.2M": 15.2, "6-02.5": (72 + 2.5) * 0.0254, "NM": None, "FOUL": None,
             "6-2-1": None, "13.31 m": 13.31, "5mm": None, "-5": -5.0}
    got = one_col(spark, list(cases), parse_distance_to_meters)
    for (k, v), g in zip(cases.items(), got):
        assert approx(g, v), (k, g, v)
    assert abs(got[2] - 1.8923) < 1e-4


def test_mark_to_numeric(spark):
    cases = [("300 Meters", "37.09", 37.09, False), ("300 Meters", "1:02.00", 62.0, True),
             ("55 Meters", "6.84", 6.84, True), ("Decathlon", "5432", 5432.0, False),
             ("Decathlon", "DNF", None, True), ("Shot Put", "DNF", None, False),
             ("100 Meters", "10.55", 10.55, True), ("Long Jump", "7-01", (84 + 1) * 0.0254, False)]
    df = spark.createDataFrame([(i, e, m) for i, (e, m, _, _) in enumerate(cases)], "i int, e string, m string")
    v, t = mark_to_numeric(F.col("e"), F.col("m"))
    got = df.orderBy("i").select(v.alias("v"), t.alias("t")).collect()
    for (e, m, ev, et), r in zip(cases, got):
        assert approx(r.v, ev) and r.t == et, (e, m, r)


def test_canonical_event_and_family(spark):
    assert one_col(spark, ["100m", " 5K ", "110h", "Decathlon", "10,000 Meters", "Mile"], canonical_event) == [
        "100 Meters", "5000 Meters", "110 Hurdles", "Decathlon", "10,000 Meters", "Mile"]
    beta = one_col(spark, ["110h", "100m"], lambda c: canonical_event(c, beta=True))
    assert beta == ["110h", "100 Meters"]
    cases = [("110 Hurdles", "Men", "short_hurdles"), ("110 Hurdles", "Women", "110 Hurdles"),
             ("100h", "Women", "short_hurdles"), ("4x1", "Men", "4 x 100 Relay"), ("Mile", "Men", "metric_mile"),
             ("1500 Meters", "Women", "metric_mile"), ("60m", "Men", "short_sprint"), ("DMR", "Men", "DMR")]
    df = spark.createDataFrame([(i, e, g) for i, (e, g, _) in enumerate(cases)], "i int, e string, g string")
    got = [r[0] for r in df.orderBy("i").select(event_to_family(F.col("e"), F.col("g"))).collect()]
    assert got == [c[2] for c in cases]


def test_wind_and_date(spark):
    assert one_col(spark, ["+1.2", "0.4m/s", "-0.3", "NWI", ""], wind_mps) == [1.2, 0.4, -0.3, 0.0, 0.0]
    d = dt.date(2025, 4, 5)
    assert one_col(spark, ["2025-04-05", "04/05/2025", "Apr 5, 2025", "Apr 5 2025", "TBD", "2025-4-5"],
                   parse_date) == [d, d, d, d, None, d]


def test_time_event_keywords(spark):
    assert one_col(spark, ["Weight Throw", "3000 Steeplechase", "60m", "Decathlon", "4 x 400 Relay"],
                   is_time_event) == [False, True, True, False, True]


def test_formatting(spark):
    assert one_col(spark, [110.32, 125.0, 9.5, 59.999, float("nan"), None], fmt_time, "double") == [
        "1:50.32", "2:05.00", "9.50s", "60.00s", "n/a", "n/a"]
    assert one_col(spark, [13.536, float("inf")], fmt_dist, "double") == ["13.54 m", "n/a"]


def test_slug_and_urls(spark):
    assert one_col(spark, ["4 x 100-Relay!"], slug) == ["4_x_100_Relay"]
    team = "https://www.tfrrs.org/teams/tf/NC_college_m_Duke.html"
    got = one_col(spark, [team, "https://www.tfrrs.org/teams/xc/NC_college_m_Duke.html"],
                  lambda c: result_url(c, F.lit(5027), F.lit(681)))
    assert got == ["https://www.tfrrs.org/all_performances/NC_college_m_Duke.html?list_hnd=5027&season_hnd=681", ""]
    urls = ["https://x.org/a.html?list_hnd=5027&season_hnd=681", "https://x.org/a.html?list_hnd=abc&season_hnd=1",
            "https://x.org/a.html?season_hnd=1"]
    assert one_col(spark, urls, url_has_required_query) == [True, False, False]


def test_title_and_division(spark):
    titles = ["U. of Chicago Men's Track & Field All Performances & Rankings",
              "Duke Track & Field All Performances", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string")
    team, gender = team_and_gender_from_title(F.col("t"))
    got = [tuple(r) for r in df.orderBy("i").select(team, gender).collect()]
    assert got == [("U. of Chicago", "Men"), ("Duke", "Unknown"), ("Unknown Team", "Unknown")]
    assert one_col(spark, ["x ncaa division iii y", "NCAA D2", "naia", "NCAAD1", "nothing"], division_from_text) == [
        "NCAA Division III", "NCAA Division II", "NAIA", "Ncaad1", "Unknown"]


def test_submission_parsers(spark):
    assert one_col(spark, ["1:50.32", "10.55", "-1:00", "1:2:3"], parse_time_like) == [110.32, 10.55, None, None]
    assert one_col(spark, ["13.72m", "1.2 m/s", "x"], parse_float) == [13.72, 1.2, None]
    df = spark.createDataFrame([(0, "1:50.32", True), (1, "13.72m", False), (2, "10.5m", True)],
                               "i int, m string, t boolean")
    got = [r[0] for r in df.orderBy("i").select(submitted_mark(F.col("m"), F.col("t"))).collect()]
    assert got == [110.32, 13.72, 10.5]
    df = spark.createDataFrame([(0, "(+1.2)", "Outdoors"), (1, "+1.2", "Indoors"), (2, "", "Outdoors")],
                               "i int, w string, s string")
    got = [r[0] for r in df.orderBy("i").select(submitted_wind(F.col("w"), F.col("s"))).collect()]
    assert got == [1.2, 0.0, 0.0]


def test_labels(spark):
    assert one_col(spark, [" indoors", "OUTDOORS", "summer"], normalise_season_label) == ["Indoors", "Outdoors", None]
    assert one_col(spark, ["Indoors", "PAD"], lambda c: window_label_id(c, 2)) == [0, 0]
    assert one_col(spark, ["Indoors", "Outdoors", "PAD"], lambda c: window_label_id(c, 3)) == [1, 2, 0]


@pytest.mark.parametrize("seconds", [9.5, 59.99, 61.25, 245.2, 3599.5])
def test_format_parse_roundtrip(spark, seconds):
    # fmt_time then the submission time parser gives the value back (to the printed precision)
    txt = one_col(spark, [seconds], fmt_time, "double")[0].rstrip("s")
    back = one_col(spark, [txt], parse_time_like)[0]
    assert math.isclose(back, round(seconds, 2), abs_tol=1e-9)
