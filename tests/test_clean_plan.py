"""Cleaning: what is interpreted row by row stays small."""

import re

from peakcast.operators.clean import prepare_marks
from peakcast.sources.fixture import ORDINAL_COLS, ORDINAL_DIGITS, raw_marks

from .conftest import SF0001


def test_generator_input_is_columns_only(spark):
    """Spark interprets a generator's input, so values and conditions are computed in the (compiled) projection below."""
    for variant in ("family", "event"):
        marks = prepare_marks(raw_marks(spark, SF0001), ORDINAL_COLS, variant=variant, ordinal_digits=ORDINAL_DIGITS)
        plan = marks._jdf.queryExecution().optimizedPlan().toString()
        inputs = re.findall(r"Generate inline\(CASE WHEN (.*?) THEN", plan)
        assert len(inputs) == 1 and re.fullmatch(r"_keep#\d+", inputs[0])
        assert "Filter" not in plan  # none inferred from the generator, with the parsers inside
