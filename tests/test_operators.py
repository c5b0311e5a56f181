"""Golden and property tests for the table operators."""

import datetime as dt

from pyspark.sql import functions as F

from peakcast.operators.catalogue import anchors, build_catalogue, dedupe_last
from peakcast.operators.clean import ORD
from peakcast.operators.forecast import scoring_blocks, weighted_mean_loss
from peakcast.operators.pages import page_rows
from peakcast.operators.seasons import (family_season_peaks, next_season_targets_frame,
                                        next_season_targets_join, season_aggregate)
from peakcast.operators.sequences import last_marks, pad_left, season_sequences
from peakcast.operators.training import event_stats, time_split
from peakcast.operators.windows import explode_window, history_windows
from peakcast.plans import core

from .conftest import SF0001


def _seasons(spark, rows):
    return spark.createDataFrame(rows, "fam_key string, season_key string, SeasonYear int, SeasonLabel string, "
                                       "Gender string, family string, is_time boolean, peak_value double, "
                                       "length int, event_used string")


def test_window_k4_golden(spark):
    rows = [("a", f"{y}-{lab}", y, lab, "Men", "f", True, p, 1, "e")
            for y, lab, p in [(2021, "Indoors", 10.0), (2021, "Outdoors", 11.0), (2023, "Outdoors", 12.0),
                              (2024, "Outdoors", 13.0)]]
    s = history_windows(_seasons(spark, rows), with_seq=False).collect()
    assert len(s) == 1
    r = s[0]
    assert r.season_key == "2023-Outdoors" and r.y == 13.0 and r.n_seasons == 3
    assert [w.season_key for w in r.window] == [None, "2021-Indoors", "2021-Outdoors", "2023-Outdoors"]
    assert [w.label_id for w in r.window] == [0, 0, 1, 1] and [w.length for w in r.window] == [0, 1, 1, 1]


def test_z_golden(spark):
    df = spark.createDataFrame([("M", "e", "train", 10.0), ("M", "e", "train", 12.0), ("M", "f", "train", 5.0),
                                ("M", "f", "train", 5.0), ("M", "g", "val", 7.0)],
                               "Gender string, event string, split string, y double")
    st = {(r.event): (r.mu, r.sd) for r in event_stats(df).collect()}
    assert st["e"] == (11.0, 1.0) and st["f"] == (5.0, 1.0) and st["g"] == (0.0, 1.0)


def test_page_fragment_golden(spark):
    html = ('<div class="panel-heading"><h3 class="panel-title">School 1 Men\'s Track &amp; Field All Performances '
            '&amp; Rankings</h3></div><p>NCAA Division II</p>'
            '<div class="performance-list-row"><div class="col-athlete"><a>Early</a></div></div>'
            '<div class="col-lg-12"><h3>Triple Jump</h3></div>'
            '<div class="performance-list-row"><div class="col-athlete"><a>Athlete 4</a></div><div data-label="Year">'
            'SR-4</div><div data-label="Mark">13.31m</div><div data-label="Wind">+0.2</div><div class="col-meet">Meet 9'
            '</div><div data-label="Meet Date">Mar 29, 2025</div></div>'
            '<div class="performance-list-row"><div class="col-athlete"><a> Athlete 5 </a></div><div data-label="Time">'
            '</div><div data-label="Mark">12.80m</div><div data-label="Wind/Aid">+2.2</div><div data-label="Date">'
            'Apr 17, 2025</div></div>'
            '<div class="performance-list-row"><div data-label="Mark">12.00m</div></div>')
    pages = spark.createDataFrame([("https://x.org/all_performances/a.html?list_hnd=5027&season_hnd=681", html)],
                                  "url string, html string")
    npy = page_rows(pages, meta_cols=False).orderBy("block_no", "row_no").collect()
    assert [r.Event for r in npy] == ["Unknown Event", "Triple Jump", "Triple Jump", "Triple Jump"]
    r = npy[1]
    assert (r.Athlete, r.ClassYear, r.MarkOrTime, r.Wind, r.Meet, r.MeetDate, r.Team, r.School, r.Gender,
            r.Division, r.ListHnd, r.SeasonHnd) == ("Athlete 4", "SR-4", "13.31m", "+0.2", "Meet 9", "Mar 29, 2025",
                                                     "School 1", "School 1", "Men", "NCAA Division II", 5027, 681)
    assert (npy[2].Athlete, npy[2].MarkOrTime, npy[2].Wind, npy[2].MeetDate) == ("Athlete 5", "12.80m", "+2.2",
                                                                                  "Apr 17, 2025")
    assert npy[3].Athlete == ""
    csv = page_rows(pages, mode="csv", meta_cols=False).orderBy("block_no", "row_no").collect()
    # CSV mode: first *present* mark cell (an empty Time), and the row without athlete is dropped
    assert [r.Athlete for r in csv] == ["Early", "Athlete 4", "Athlete 5"]
    assert csv[2].MarkOrTime == ""


def test_catalogue_dedupe_last_and_skips(spark):
    html = ('<a href="/teams/tf/NC_college_m_Duke.html">Duke</a><a href="/teams/tf/NC_college_m_Duke.html">Duke Men</a>'
            '<a href="https://www.tfrrs.org/teams/tf/NC_college_w_Duke.html">Duke</a>'
            '<a href="/teams/xc/NC_college_m_Duke.html">Duke XC</a><a href="/teams/tf/NC_college_f_X.html"> </a>'
            '<a href="/teams/tf/nc_college_m_Low.html">Low</a>')
    pages = spark.createDataFrame([(1, "NCAA Division I", html)], "page_id long, division string, html string")
    assert anchors(pages).count() == 5
    cat = build_catalogue(pages).collect()
    assert len(cat) == 20
    assert {(r.school, r.gender) for r in cat} == {("Duke Men", "Men"), ("Duke", "Women")}
    # sorted by division, school, gender, year descending, season ascending
    assert (cat[0].school, cat[0].gender, cat[0].year, cat[0].season) == ("Duke", "Women", 2025, "Indoors")
    assert cat[0].url.endswith("NC_college_w_Duke.html?list_hnd=4874&season_hnd=661")
    assert cat[1].season == "Outdoors" and cat[1].url.endswith("?list_hnd=5027&season_hnd=681")
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "k string, pos int, v string")
    assert sorted(tuple(r) for r in dedupe_last(df, ["k"], ["pos"]).collect()) == [("j", 1, "c"), ("k", 2, "b")]


def test_scoring_block_readme_example(spark):
    subs = spark.createDataFrame(
        [("s", "Outdoors", "Triple Jump", i, d, m, w) for i, (d, m, w) in enumerate(
            [("2025-03-29", "13.31", "+0.2"), ("2025-04-17", "12.80", "+2.2"), ("2025-04-26", "12.77", "+2.6"),
             ("2025-05-09", "13.25", "+3.3")])],
        "submission_id string, season_label string, event string, mark_no int, date_text string, mark string, "
        "wind string")
    b = scoring_blocks(subs).orderBy("step").collect()
    assert [r.step for r in b] == [28, 29, 30, 31]  # length 4, left pad 28
    assert [r.gap for r in b] == [0.0, 19.0, 9.0, 13.0]
    assert [r.value for r in b] == [13.31, 12.80, 12.77, 13.25] and [r.wind for r in b] == [0.2, 2.2, 2.6, 3.3]
    indoor = scoring_blocks(subs.withColumn("season_label", F.lit("Indoors"))).collect()
    assert all(r.wind == 0.0 for r in indoor)


def test_pad_left(spark):
    df = spark.createDataFrame([(list(range(1, 41)),), ([1, 2],)], "a array<int>")
    df = df.select(F.transform("a", lambda x: F.struct(x.cast("double").alias("value"), F.lit(0.0).alias("gap"),
                                                        F.lit(0.0).alias("wind"))).alias("s"))
    got = df.select(pad_left(F.col("s"), 32).alias("p")).collect()
    assert [len(r.p) for r in got] == [32, 32]
    assert got[0].p[0].value == 9.0 and got[0].p[-1].value == 40.0
    assert got[1].p[29].value == 0.0 and got[1].p[30].value == 1.0


def test_weighted_mean_loss(spark):
    df = spark.createDataFrame([(1.0, 2), (4.0, 1)], "loss double, n int")
    assert abs(weighted_mean_loss(df).first()[0] - 2.0) < 1e-12


# ---- properties on the driver fixture ---------------------------------------------------------

def test_sequence_properties(spark):
    marks = core.prepared(spark, SF0001)
    rows = last_marks(marks)
    bad = rows.filter((F.col("gap") < 0) | (F.col("step") < 0) | (F.col("step") > 31)).count()
    assert bad == 0
    seqs = season_sequences(marks)
    assert seqs.filter(F.size("seq") > 32).count() == 0
    # the oldest mark of a season that fits entirely has gap 0
    agg = season_aggregate(marks)
    first = (seqs.join(agg.filter(F.col("n_marks") <= 32), ["fam_key", "season_key"])
             .filter(F.col("seq")[0]["gap"] != 0).count())
    assert first == 0


def test_join_equals_frame(spark):
    peaks = family_season_peaks(core.prepared(spark, SF0001))
    a = next_season_targets_join(peaks).select("fam_key", "season_key", "y_next")
    b = next_season_targets_frame(peaks).select("fam_key", "season_key", "y_next")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_covers_each_sample_once(spark):
    s = core.samples(spark, SF0001, with_seq=False)
    t = time_split(s)
    assert t.count() == s.count()
    assert t.groupBy("fam_key", "season_key").count().filter("count > 1").count() == 0
    # the fallback hash split (no training year at all) is reproducible and complete
    f = time_split(s, train_max_year=1900, valid_year=1901)
    assert f.filter(F.col("split").isNull()).count() == 0
    assert sorted(f.groupBy("split").count().collect()) == sorted(
        time_split(s.repartition(3), train_max_year=1900, valid_year=1901).groupBy("split").count().collect())


def test_z_inverse_identity(spark):
    t = core.training(spark, SF0001, min_train=1)
    assert t.filter(F.abs(F.col("z") * F.col("sd") + F.col("mu") - F.col("y")) > 1e-9).count() == 0


def test_window_explode_slots(spark):
    s = core.samples(spark, SF0001, with_seq=False)
    e = explode_window(s)
    assert e.filter((F.col("slot") < 0) | (F.col("slot") > 3)).count() == 0
    assert e.filter(F.col("slot") == 3).count() == s.count()


def test_task_split_fallback_sizes(spark):
    from peakcast.operators.training import task_split
    rows = []
    for task, n in (("a", 100), ("b", 70), ("c", 50), ("d", 80)):
        for i in range(n):
            year = 2024 if task != "d" else (2022 if i < 65 else 2024)  # d has 65 training rows by year
            rows.append((task, f"k{i}", f"{year}-Outdoors", year))
    df = spark.createDataFrame(rows, "event string, key string, season_key string, SeasonYear int")
    out = task_split(df, ["event"], min_train=60)
    got = {(r.event, r.split): r["count"] for r in out.groupBy("event", "split").count().collect()}
    assert (got[("a", "train")], got[("a", "val")], got[("a", "test")]) == (70, 15, 15)
    assert (got[("b", "train")], got.get(("b", "val"), 0), got[("b", "test")]) == (60, 0, 10)
    assert not any(k[0] == "c" for k in got)
    assert (got[("d", "train")], got[("d", "val")]) == (65, 15)


def test_page_cells_tolerate_extra_classes_and_attributes(spark):
    html = ('<div class="panel-heading"><h3 class="big panel-title" id="t">Duke Women\'s Track &amp; Field</h3></div>'
            '<div class="col-lg-12"><h3>Mile</h3></div>'
            '<div class="performance-list-row"><div class="col-athlete wide" id="a1"><a href="/x">Runner</a></div>'
            '<div class="tight" data-label="Time">4:40.10</div><div id="m" class="col-meet">Meet 1</div></div>')
    pages = spark.createDataFrame([("https://x.org/p.html", html, "Unknown")], "url string, html string, gender string")
    r = page_rows(pages).collect()[0]
    assert (r.Athlete, r.MarkOrTime, r.Meet, r.Event) == ("Runner", "4:40.10", "Meet 1", "Mile")
    # a catalogue gender of "Unknown" is replaced by the title's
    assert (r.School, r.Gender) == ("Duke", "Women")


def test_anchor_text_nodes(spark):
    html = ('<a href="/teams/tf/TX_college_m_A_M.html"> Texas <b>A&amp;M</b>  </a>'
            '<a class="x" href="/y">Duke   Univ</a><a href="/z"><img src="i.png"/></a>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.href, r.text) for r in anchors(pages).orderBy("pos").collect()]
    assert got == [("/teams/tf/TX_college_m_A_M.html", "Texas A&M"), ("/y", "Duke   Univ")]
