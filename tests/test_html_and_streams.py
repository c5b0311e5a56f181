"""Markup as other writers put it, tolerant URLs, null groups, and streams that arrive in any order."""

import html as pyhtml
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from peakcast.functions import url_query_param
from peakcast.functions.text import decode_entities
from peakcast.operators.catalogue import anchors
from peakcast.operators.clean import prepare_marks
from peakcast.operators.forecast import scoring_blocks
from peakcast.operators.pages import page_rows, pages_without_rows
from peakcast.operators.seasons import family_season_peaks
from peakcast.operators.training import task_split, time_split
from peakcast.streaming.peaks import merge_batch, read_peaks, streaming_peak_state

from .conftest import one_col

PAGE = """<html><body><h3 class='big panel-title'>Acme
 Men's Track &amp; Field</h3><p>NCAA Division II</p>
<div id="x" class="row col-lg-12"><h3
 class="a">Shot
 Put</h3></div>
<div class='odd performance-list-row'><div class="col-athlete x">
 <a href='#'>Jos&eacute; &#78;u&#xF1;ez</a>
</div><div
  data-label='Mark'>15.20m
</div><div data-label="Wind"></div><div class="col-meet">M &lt;1&gt;</div><div data-label='Meet Date'>Jan 2, 2022</div></div>
<div class="performance-list-row last"><div data-label="Mark">9.9</div></div></body></html>"""


def pages(spark, *htmls):
    return spark.createDataFrame([(i, f"https://x/a_m_b.html?list_hnd=1&season_hnd=2&p={i}", h) for i, h in enumerate(htmls)],
                                 "page_id long, url string, html string")


def test_rows_of_unlike_markup(spark):
    r = page_rows(pages(spark, PAGE), meta_cols=False).orderBy("row_no").collect()
    assert [(x.Event, x.Athlete, x.MarkOrTime, x.Meet, x.MeetDate) for x in r] == [
        ("Shot\n Put", "José Nuñez", "15.20m", "M <1>", "Jan 2, 2022"), ("Shot\n Put", "", "9.9", "", "")]
    assert r[0].School == "Acme" and r[0].Gender == "Men" and r[0].Division == "NCAA Division II"


def test_dropped_rows_are_counted(spark):
    seen = Observation("rows")
    kept = page_rows(pages(spark, PAGE), mode="csv", meta_cols=False, dropped=seen).collect()
    assert len(kept) == 1 and seen.get == {"rows": 2, "dropped": 1}


def test_two_captures_of_one_url_are_judged_apart(spark):
    p = pages(spark, PAGE, "<html></html>", None).withColumn("url", F.lit("same"))
    assert sorted(r.page_id for r in pages_without_rows(p).collect()) == [1, 2]


def test_anchors_of_unlike_markup(spark):
    h = """<a class=x href='/t?a=1&amp;b=2'>One
 two</a><A href="#">no</A><a
 href="/u"> <b>B</b>&#8212;<i>C</i> </a><a href="/v"></a>"""
    got = [(r.href, r.text) for r in anchors(pages(spark, h)).orderBy("pos").collect()]
    assert got == [("/t?a=1&b=2", "One\n two"), ("/u", "B — C")]


ENTITIES = ["&eacute;", "&#233;", "&#x27;", "&#X1F600;", "&amp;lt;", "&nosuch;", "& x", "&;", "a&b;c", "&lt", "&#0;", "&#xD800;", "&#1114112;", "&nbsp;x&nbsp;",
            "&NotEqualTilde;", "no", ""]


def test_entities_like_the_standard_library(spark):
    want = [pyhtml.unescape(e) for e in ENTITIES]
    assert one_col(spark, ENTITIES, decode_entities) == want


@pytest.mark.parametrize("url", ["http://x/a?list_hnd=3&season_hnd=4", "http://x/a b|c?list_hnd=3&n=a%20b+c", "x?list_hnd=&list_hnd=7#list_hnd=9", "http://x/%zz?n=%41",
                                 "http://x/", "", "?n=%E9%80"])
def test_url_parameters_like_the_standard_library(spark, url):
    for name in ("list_hnd", "n"):
        want = parse_qs(urlparse(url).query).get(name, [""])[0]
        if "�" not in want:
            assert one_col(spark, [url], lambda c: url_query_param(c, name)) == [want]


def test_split_keeps_null_groups_whatever_other_groups_hold(spark):
    rows = [("Men", f"m{i}", 2022) for i in range(10)] + [("Women", f"w{i}", 2025) for i in range(10)] + [(None, f"n{i}", 2026) for i in range(10)]
    s = spark.createDataFrame([(g, k, "s", y) for g, k, y in rows], "Gender string, fam_key string, season_key string, SeasonYear int")
    for part in (s, s.filter("Gender is null or Gender = 'Men'"), s.filter("Gender is null")):
        got = {(r.Gender, r.split): r.n for r in time_split(part).groupBy("Gender", "split").agg(F.count("*").alias("n")).collect()}
        assert got[None, "train"] == 8 and got[None, "val"] == 2
        assert sum(got.values()) == part.count()
    t = task_split(s.withColumnRenamed("fam_key", "key"), ["Gender"], min_train=2)
    assert {r.Gender for r in t.collect()} == {"Men", "Women", None} and t.count() == 30


def test_gap_looks_past_any_number_of_undated_marks(spark):
    marks = [(1, "2021-01-01"), (2, "2022-09-04")] + [(n, "") for n in range(3, 60)] + [(60, "1999-12-31")]
    subs = spark.createDataFrame([("a", "Outdoors", "Shot Put", n, d, "10.0", "") for n, d in marks],
                                 "submission_id string, season_label string, event string, mark_no int, date_text string, mark string, wind string")
    got = {r.step: r.gap for r in scoring_blocks(subs, undated_gap_days=3).collect()}
    assert len(got) == 32 and got[31] == 611.0 and got[0] == 3.0
    # The second newest mark's predecessor, dated 1999, lies behind 57 undated ones.
    assert got[30] == 7672.0


RAW = "pos long, Division string, School string, Gender string, SeasonLabel string, SeasonYear int, Event string, Athlete string, MarkOrTime string, Wind string, " \
      "Meet string, MeetDate string"


def test_stream_equals_batch_on_mixed_seasons_in_any_order(spark, tmp_path):
    """The first row (by position) decides a season's orientation though it arrives in the last batch."""
    marks = [(0, "300 Meters", "37.10"), (1, "300 Meters", "29.50"), (2, "300 Meters", "41.0m"), (3, "300 Meters", "35.00")]
    rows = [(p, "D", "S", "Men", "Outdoors", 2022, e, f"A{a}", m if a % 2 else (m if p else "44.10"), "", "M", "2022-05-01") for a in range(20) for p, e, m in marks]
    raw = spark.createDataFrame(rows, RAW)
    for batch, part in enumerate(([3], [1, 2], [0])):
        raw.filter(F.col("pos").isin(part)).coalesce(1).write.parquet(f"{tmp_path}/in/{batch}")
    want = family_season_peaks(prepare_marks(raw, ["pos"])).select("fam_key", "season_key", "is_time", "peak_value", "Gender")
    src = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = (streaming_peak_state(prepare_marks(src, ["pos"])).writeStream.outputMode("update").foreachBatch(merge_batch(f"{tmp_path}/out", 4))
         .option("checkpointLocation", f"{tmp_path}/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    got = read_peaks(spark, f"{tmp_path}/out").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("kind", range(5))
def test_variants_of_a_page_have_the_same_rows(spark, kind):
    from peakcast.sources.rendered import markup_variant
    plain = PAGE.replace("'", '"').replace("&eacute;", "e").replace("col-athlete x", "col-athlete")
    p = pages(spark, plain)
    rows = lambda df: sorted(tuple(r) for r in page_rows(df, meta_cols=False).select("Athlete", "MarkOrTime", "Meet", "Division").collect())
    assert rows(p.withColumn("html", markup_variant(F.col("html"), F.lit(kind)))) == rows(p)


def test_balanced_markup(spark):
    """Nested divs, comments, scripts, bare values, references without a semicolon, cells outside rows."""
    row = '<div class="performance-list-row"><div class="col-athlete">Nobody</div><div data-label="Time">1.0</div></div>'
    html = (f'<div class="col-lg-12"><div><h3>Mile</h3></div></div><h3>No heading</h3><!-- {row} --><script>"{row}"</script>'
            '<div class=performance-list-row id=x><div data-label="Time"><div></div><span>4:10.0</span></div><DIV data-label=Wind>1.0</DIV>'
            '<div class="a col-athlete b"><div><div>B</div></div>&amp C&#146;s &copy &unknown &notin;</div><div data-label="Meet &#68;ate">d</div></div>'
            f'<div data-label="Year">stray</div><style>{row}</style><!-- open {row}')
    got = [tuple(r) for r in page_rows(pages(spark, html)).select("Event", "Athlete", "MarkOrTime", "Wind", "MeetDate", "ClassYear").collect()]
    assert got == [("Mile", "B& C\u2019s \u00a9 &unknown \u2209", "4:10.0", "1.0", "d", "")]


def test_heading_is_that_of_its_own_div(spark):
    html = ('<div class="col-lg-12"></div><h3>Outside</h3><div class="performance-list-row"><div class="col-athlete">A</div></div>'
            '<div class="col-lg-12"><h3>Inside</h3></div><div class="performance-list-row"><div data-label="Time">2</div></div>')
    assert [r.Event for r in page_rows(pages(spark, html)).orderBy("block_no").collect()] == ["Unknown Event", "Inside"]
    kept = page_rows(pages(spark, html), mode="csv").collect()
    assert kept == []  # the first has no heading, the second no athlete
