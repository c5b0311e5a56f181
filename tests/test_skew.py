"""A key holding a third of all rows: results stay exact and whole, plans keep their pre-shuffle steps."""

import pandas as pd
from pyspark.sql import functions as F

from peakcast.operators.clean import prepare_marks
from peakcast.operators.seasons import family_season_peaks
from peakcast.operators.sequences import last_marks
from peakcast.sources.fixture import ORDINAL_COLS, ORDINAL_DIGITS, raw_marks

from .conftest import SF0001


def _skewed(spark):
    raw = raw_marks(spark, SF0001)
    hot = F.col("part_key") % 3 == 0
    return raw.withColumn("Athlete", F.when(hot, F.lit("Hot Athlete")).otherwise(F.col("Athlete")))


def test_hot_key_peaks_and_sequences_exact(spark):
    marks = prepare_marks(_skewed(spark), ORDINAL_COLS, ordinal_digits=ORDINAL_DIGITS)
    pdf = marks.select("fam_key", "season_key", "date", *ORDINAL_COLS, "value", "is_time").toPandas()
    hot_share = (pdf["fam_key"].str.startswith("hot athlete")).mean()
    assert hot_share > 0.3

    # brute force: first row (source order) orientation, min / max, last 32 by (date, position) desc
    pdf = pdf.sort_values(ORDINAL_COLS, kind="mergesort")
    exp = {}
    for (k, s), g in pdf.groupby(["fam_key", "season_key"], sort=False):
        first = bool(g["is_time"].iloc[0])
        exp[(k, s)] = g["value"].min() if first else g["value"].max()
    got = {(r.fam_key, r.season_key): r.peak_value for r in family_season_peaks(marks).collect()}
    assert got == exp

    tail = (pdf.sort_values(["date", *ORDINAL_COLS], ascending=False, kind="mergesort")
            .groupby(["fam_key", "season_key"], sort=False).head(32))
    exp_tail = sorted(zip(tail["fam_key"], tail["season_key"], tail["value"]))
    rows = last_marks(marks).select("fam_key", "season_key", "value").collect()
    assert sorted((r.fam_key, r.season_key, r.value) for r in rows) == exp_tail


def test_hot_key_plan_keeps_partial_steps(spark):
    marks = prepare_marks(_skewed(spark), ORDINAL_COLS, ordinal_digits=ORDINAL_DIGITS)
    plan = last_marks(marks)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = family_season_peaks(marks)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "HashAggregate" in plan
    assert pd.__version__  # pandas only used for the brute force
