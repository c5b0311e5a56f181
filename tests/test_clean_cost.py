"""Cleaning: the cheap strip equals the full one, and neither filters on keys nor the packed position go through its steps."""

import re

from pyspark.sql import functions as F

from peakcast.functions.text import PY_WHITESPACE, pystrip, pystrip_edges
from peakcast.operators.clean import ORD, prepare_marks
from peakcast.sources.fixture import ORDINAL_COLS, ORDINAL_DIGITS, raw_marks

from .conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stripped_edges_equal_full_strip(spark):
    texts = [None, "", " ", "a", "ab", "a b", " a", "a ", "\x7f", "a\x7f", "!", "~ ~", "\x00a\x00", "é", "aé", "é ",
             "\U0001f3c3", "\U0001f3c3 x", *(ch + "x y" + ch for ch in PY_WHITESPACE), *("x" + ch for ch in PY_WHITESPACE),
             *(ch + "x" for ch in PY_WHITESPACE), *PY_WHITESPACE]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", pystrip_edges(F.col("x")).alias("a"), pystrip(F.col("x")).alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] == [None if r.x is None else r.x.strip() for r in rows]


def test_filters_on_keys_stay_above_the_generator(spark):
    """What joins infer of a key (that it is not null) is not carried through the strip and the event names."""
    for variant, key in (("family", "fam_key"), ("event", "key")):
        marks = prepare_marks(raw_marks(spark, SF0001), ORDINAL_COLS, variant=variant, ordinal_digits=ORDINAL_DIGITS)
        plan = _plan(marks.join(marks.groupBy(key).agg(F.max("value").alias("best")), key))
        for below in plan.split("Generate inline")[1:]:
            below = below[:below.index("Relation")]  # of this branch
            for cond in re.findall(r"Filter (.*)", below):
                assert "trim(" not in cond and "CASE WHEN" not in cond


def test_position_is_packed_after_the_drop(spark):
    marks = prepare_marks(raw_marks(spark, SF0001), ORDINAL_COLS, ordinal_digits=ORDINAL_DIGITS).select("fam_key", ORD)
    above, below = _plan(marks).split("Generate inline")
    assert "decimal(38,0)" in above and "decimal" not in below
