"""Sources/sinks round trips, event lookup, flat features and the forecaster options."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakcast.operators import forecast as FC
from peakcast.operators.inspect import mark_filters
from peakcast.operators.lookup import resolve_events
from peakcast.operators.windows import flat_features
from peakcast.plans import core
from peakcast.session import scratch_path
from peakcast.sources import io as IO
from peakcast.sources.fixture import raw_marks
from peakcast.sources.layout import RAW_COLUMNS

from .conftest import SF0001


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_append_and_exports(spark):
    base = scratch_path(spark, "t-csv")
    raw = raw_marks(spark, SF0001)
    part = mark_filters(raw, year=2022)
    IO.write_csv(part, f"{base}/marks", mode="append")
    IO.write_csv(part, f"{base}/marks", mode="append")  # a re-crawl appends again (no de-duplication)
    back = spark.read.option("header", True).csv(f"{base}/marks")
    assert back.count() == 2 * part.count()
    IO.write_csv(part, f"{base}/single", single_file=True)
    assert len([f for f in os.listdir(_local(f"{base}/single")) if f.endswith(".csv")]) == 1


def test_catalogue_missing_column(spark):
    base = scratch_path(spark, "t-cat")
    spark.createDataFrame([("a", "b")], "Division string, School string").write.option("header", True).csv(base)
    with pytest.raises(IO.MissingColumn):
        IO.read_catalogue_csv(spark, base)


def test_npy_roundtrip_and_empty(spark):
    base = scratch_path(spark, "t-npy")
    os.makedirs(_local(base), exist_ok=True)
    empty = np.empty(0, dtype=[(c, "<i4") if c in ("SeasonYear", "ListHnd", "SeasonHnd") else (c, "<U1")
                               for c in RAW_COLUMNS])
    np.save(os.path.join(_local(base), "empty.npy"), empty)
    arr = np.array([("NCAA Division I", "Duke", "Men", "Outdoors", 2024, 5027, -1, "u", "Duke", "Mile",
                     "A B", "SR-4", "4:01.00", "", "Meet", "Apr 5, 2025")],
                   dtype=[(c, "<i4") if c in ("SeasonYear", "ListHnd", "SeasonHnd") else (c, "<U20")
                          for c in RAW_COLUMNS])
    np.save(os.path.join(_local(base), "one.npy"), arr)
    rows = IO.read_npy(spark, f"{base}/*.npy").collect()
    assert len(rows) == 1 and rows[0].SeasonYear == 2024 and rows[0].SeasonHnd == -1 and rows[0].Athlete == "A B"
    pos = IO.read_npy(spark, f"{base}/*.npy", with_position=True).collect()
    assert pos[0].row_in_file == 0 and pos[0].source_file.endswith("one.npy")
    out = f"{base}/written"
    written = IO.write_npy(raw_marks(spark, SF0001), out).collect()
    assert sum(r.rows for r in written) == 6000 or sum(r.rows for r in written) == raw_marks(spark, SF0001).count()
    one = np.load(_local(written[0].file))
    assert one.dtype["SeasonYear"] == np.dtype("<i4") and one.dtype["Athlete"].kind == "U"


def test_saved_table_requires_presence(spark):
    with pytest.raises(FileNotFoundError):
        IO.load_table(spark, scratch_path(spark, "t-missing"))


def test_metadata_alternative_fields(spark):
    base = scratch_path(spark, "t-meta")
    os.makedirs(_local(base), exist_ok=True)
    doc = {"gender": "Men", "events": ["100 Meters", "Mile"], "event2id": {"100 Meters": 0, "Mile": 1},
           "mu_by_event": {"100 Meters": 11.3, "Mile": 271.0}, "sd_by_event": {"100 Meters": 0.6, "Mile": 20.7},
           "seqlen": 16, "per_event_val_metrics": [{"event": "Mile", "val_mae": 8.5, "n": 10}],
           "test_mae_overall": None}
    with open(os.path.join(_local(base), "meta.json"), "w") as f:
        json.dump(doc, f, indent=2)
    m = IO.read_metadata(spark, base).first()
    assert m.seqlen == 16 and m.k_seasons == 4
    st = {r.event: (r.event_id, r.mu, r.sd) for r in IO.metadata_event_stats(IO.read_metadata(spark, base)).collect()}
    assert st["Mile"] == (1, 271.0, 20.7)


def test_single_page_layout(spark):
    df = spark.createDataFrame([("T", "D", "Men", "Mile", "A", "SR", "4:00", "", "M", "d")],
                               "Team string, Division string, Gender string, Event string, Athlete string, "
                               "ClassYear string, MarkOrTime string, Wind string, Meet string, MeetDate string")
    assert IO.single_page_layout(df).columns == ["Team", "Division", "Gender", "Event", "Athlete", "Year",
                                                 "Mark/Time", "Wind", "Meet", "Date"]


def test_resolve_events_golden(spark):
    ev = spark.createDataFrame([("Men", "100 Meters", 0), ("Men", "110 Hurdles", 1), ("Men", "Mile", 2)],
                               "Gender string, event string, event_id int")
    req = spark.createDataFrame([("Men", "2"), ("Men", "Mile"), ("Men", "hurd"), ("Men", "1"), ("Men", "x"),
                                 ("Men", "10"), ("Men", "99")], "gender string, text string")
    got = {r.text: (r.event, r.status) for r in resolve_events(req, ev).collect()}
    assert got == {"2": ("110 Hurdles", "ok"), "Mile": ("Mile", "ok"), "hurd": ("110 Hurdles", "ok"),
                   "1": ("100 Meters", "ok"), "x": (None, "not_found"), "10": (None, "ambiguous"),
                   "99": (None, "not_found")}


def test_flat_features_dense(spark):
    s = core.samples(spark, SF0001, with_seq=True)
    sizes = {r[0] for r in flat_features(s).select(F.size("x")).distinct().collect()}
    assert sizes == {4 * 32 * 3}


def test_gbt_variants_run_and_save(spark):
    ts = core.training(spark, SF0001, with_seq=True, min_train=5)
    root = scratch_path(spark, "t-models")
    pred = FC.gbt_forecast(ts, max_iter=3, group_keys=("Gender", "SeasonLabel"), early_stop=True, save_root=root)
    m = FC.per_event_mae(pred).collect()
    assert len(m) > 0 and all(r.val_mae >= 0 for r in m)
    assert len(os.listdir(_local(root))) >= 2


def test_pipeline_from_npy_files_matches_table_path(spark):
    """The README path: NPY checkpoints -> prepared marks (position = file, row) -> seasons ->
    windows -> training set -> metrics; counts equal the lineitem-keyed path."""
    from peakcast.operators.clean import prepare_marks
    from peakcast.operators.training import training_set
    from peakcast.operators.windows import history_windows

    base = scratch_path(spark, "t-pipe")
    IO.write_npy(raw_marks(spark, SF0001), f"{base}/npy").collect()
    raw = IO.read_npy(spark, f"{base}/npy/*.npy", with_position=True)
    marks = prepare_marks(raw, ["source_file", "row_in_file"])
    seasons = core.build_seasons(marks)
    samples = history_windows(seasons, k=4)
    ts = training_set(core.materialize(samples, "samples"), min_train=5)
    metrics = FC.per_event_mae(FC.score_task_models(ts, FC.fit_task_models(ts, min_train=5)))

    ref_marks = core.prepared(spark, SF0001)
    assert marks.count() == ref_marks.count()
    ref_seasons = core.build_seasons(ref_marks, with_seq=False)
    assert seasons.count() == ref_seasons.count()
    peaks = {(r.fam_key, r.season_key): r.peak_value for r in seasons.select("fam_key", "season_key", "peak_value").collect()}
    ref = {(r.fam_key, r.season_key): r.peak_value for r in ref_seasons.select("fam_key", "season_key", "peak_value").collect()}
    assert peaks == ref
    assert samples.count() == core.samples(spark, SF0001, with_seq=False).count()
    assert metrics.count() >= 1
