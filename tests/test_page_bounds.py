"""Pages at size: bounded row groups, and no step of the parser done twice."""
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from peakcast.functions.text import element_body, row_body
from peakcast.operators.pages import page_rows
from peakcast.plans import core


def test_row_groups_of_page_tables_are_bounded(spark):
    """A reader takes up to 4,096 rows of a row group at once, so its bytes must be few, however well they compress."""
    pages = spark.range(0, 400, 1, 1).select("id", F.repeat(F.lit("<div data-label=\"Time\">1.00</div>"), 6000).alias("html"), F.uuid().alias("u"))
    pages = pages.select("id", F.concat("u", "html", "u").alias("html"))
    path = core.materialize(pages, "bounded-pages", core.PAGE_FILES).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").removeprefix("//")
    groups = [m.row_group(i).total_byte_size for m in (pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*.parquet")) for i in range(m.num_row_groups)]
    assert sum(groups) > 50 << 20 and max(groups) < 24 << 20


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def few(spark):
    return spark.createDataFrame([(1, "u", "<p>NCAA Division III</p>")], "page_id long, url string, html string")


def test_dropping_rows_does_not_read_their_cells_again(few):
    npy, csv = _plan(page_rows(few)), _plan(page_rows(few, mode="csv"))
    assert csv.count("regexp_instr") == npy.count("regexp_instr") > 0


def test_a_page_is_searched_for_its_division_once(few):
    rows = page_rows(few, meta_cols=False)
    assert _plan(rows).count("NCAA\\s*D[123]") == 1


@pytest.mark.parametrize("rest", ["</div>", "a</div>b</div>", "", "no end", "<div>x</div></div>y", "<a><div class='q'>x<b>y</b></div ></a> z</DIV>t",
                                  "<div><div>n</div></div>m</div>q", "<div/>a</div>b</div>c", "<divider>x</div>y", "<div>open", "</div", "<div>é</div>ü</div>ß",
                                  "<DIV\n>a</Div\n>b</div\t>c", " </div>", "\x00<</div>>", "<div>a</div>" * 3000 + "</div>z"])
def test_row_body_is_what_balanced_reading_gives(spark, rest):
    import re
    depth, at = 1, len(rest)
    for m in re.finditer(r"(?i)<(/?)div[\s/>]", rest):
        depth += -1 if m[1] else 1
        if not depth:
            at = m.start()
            break
    got = spark.createDataFrame([(rest,)], "x string").select(row_body(F.col("x")), element_body(F.col("x"))).head()
    assert tuple(got) == (rest[:at], rest[:at])


def test_pages_are_joined_without_looking_for_null_urls_in_every_row(spark):
    """Spark would infer a null test of the URL and push it, slugs and all, below the grouping of the rows."""
    from peakcast.sources.fixture import raw_marks_from_lineitem
    from peakcast.sources.rendered import result_pages
    lines = spark.range(1).selectExpr("nullif(id, -1) id").selectExpr("id l_orderkey", "int(id) l_linenumber", "id l_partkey", "id l_suppkey", "double(id) l_quantity",
                                                                      "timestamp '1996-03-13' + make_interval(0, int(id)) l_shipdate")
    pages, catalogue = result_pages(raw_marks_from_lineitem(lines))
    plan = _plan(pages.join(catalogue, "url"))
    assert "regexp_replace" in plan and not [line for line in plan.splitlines() if ("Filter" in line or "Join" in line) and "regexp_replace" in line]


FLAT = ['<div data-label="Time">7.11</div><div class="col-athlete"><a> Ann </a></div>', "<div\n  class='cell  col-athlete x' title=a>Ann</div><DIV data-label = Time >7.11</DIV >",
        '<div class="col-athlete"><div class="icon"><div></div></div><a>&#65;nn</a></div><div data-label="T&#105;me"><div>7.11</div></div>',
        '<div data-label=Time id="x">7.11</div> stray <b <div class="cell" data-label="Wind">1.0</div><div class="col-athlete">Ann&nbsp;</div>']
OTHERWISE = ['<div class="col-athlete">Ann</div><div class="wrap"><div data-label="Time">7.11</div></div>', '<div DATA-LABEL="x" data-label="Time">0</div><div class="col-athlete">Ann</div>',
             '<div class="col-athlete">Ann<div><div><div></div></div></div></div><div data-label="Time">7.11</div>', '<div class="col-athlete">Ann</div><div title="a<b" data-label="Time">7.11</div>',
             '<div class="col-athlete">Ann</div><div data-label="Time">7.11</div><div class="a&amp;b"></div>', '<div class="col-athlete">Ann</div><div data-label="Time&nbsp;">7.11</div>',
             '<div class="col-athlete">Ann</div><div data-label="Time">7.11</div><p>\u0001</p>']


@pytest.mark.parametrize("cells, flat", [*((c, True) for c in FLAT), *((c, False) for c in OTHERWISE)])
def test_usual_rows_are_cut_in_one_match_a_cell_and_read_alike(spark, cells, flat):
    from peakcast.operators import pages as P
    frag = cells + "</div>\n<div data-label='Time'>9.9</div><div class='col-athlete'>Nobody</div>"
    one = spark.createDataFrame([(1, "u", f'<div class="col-lg-12"><h3>Mile</h3></div><div class="{P.ROW_CLASS}">{frag}', frag)], "page_id long, url string, html string, frag string")
    rewritten = F.regexp_replace("frag", P.FLAT_ROW_RE, P.FLAT_ROW)
    assert one.select(P._is_flat(F.col("frag"), rewritten)).head()[0] is flat
    mark = "" if "DATA-LABEL" in cells else "7.11"  # the first attribute of that name counts, however it is written
    assert [tuple(r) for r in page_rows(one).select("Event", "Athlete", "MarkOrTime").collect()] == [("Mile", "Ann", mark)]


@pytest.mark.parametrize("ref, text", [("&colon;", ":"), ("&amp", "&"), ("&Aacute;", "Á"), ("&zwj;", "‍"), ("&nosuch;", "&nosuch;"), ("&NotEqualTilde;", "≂̸"), ("&z;", "&z;")])
def test_named_references_are_found_by_their_first_letter(spark, ref, text):
    from peakcast.functions.text import decode_entities
    assert spark.createDataFrame([(f"a{ref} b",)], "x string").select(decode_entities(F.col("x"))).head()[0] == f"a{text} b"


def test_a_reference_is_looked_up_in_a_short_text():
    from peakcast.functions import text
    names = [text._NAMES] if isinstance(text._NAMES, str) else text._NAMES
    assert max(map(len, names)) < 5000  # all names together have some 35,000 characters
