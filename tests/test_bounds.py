"""Bounds on what a task holds and how often a step reads its input."""

import os

import numpy as np
import pandas as pd

from peakcast.operators import training
from peakcast.session import scratch_path
from peakcast.sources import fixture
from peakcast.sources import io as IO
from peakcast.sources.layout import INT_COLUMNS, RAW_COLUMNS


def _local(path):
    return path.removeprefix("file:")


def test_partition_is_saved_as_files_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(IO, "NPY_ROWS", 40)
    rows = spark.range(100).selectExpr("concat('A', id) as Athlete", "cast(id as int) as SeasonYear").coalesce(1)
    out = scratch_path(spark, "t-npy-bounded")
    os.makedirs(_local(out))
    np.save(f"{_local(out)}/part-00000-00003.npy", np.zeros(5, [("Athlete", "<U1")]))  # left by an earlier attempt
    written = IO.write_npy(rows, out).collect()
    assert [r.rows for r in written] == [40, 40, 20] and {r.part for r in written} == {0}
    back = IO.read_npy(spark, f"{out}/*.npy", with_position=True).collect()
    assert sorted(r.SeasonYear for r in back) == list(range(100))
    assert all(r.Athlete == f"A{r.SeasonYear}" and r.row_in_file == r.SeasonYear % 40 for r in back)


def test_one_long_value_does_not_widen_a_whole_file(monkeypatch):
    monkeypatch.setattr(IO, "NPY_BYTES", 20_000)
    pdf = pd.DataFrame({c: [1] * 64 if c in INT_COLUMNS else ["x" * (1000 if i == 7 else 1) for i in range(64)] for c in RAW_COLUMNS})
    arrays = list(IO._npy_records(pdf))
    assert sum(map(len, arrays)) == 64 and all(a.nbytes <= 20_000 or len(a) == 1 for a in arrays)


def test_only_thin_tasks_are_ranked(spark, monkeypatch):
    ranked = []
    rank = training.seeded_rank
    monkeypatch.setattr(training, "seeded_rank", lambda df, *a: (ranked.append(df.count()), rank(df, *a))[1])
    rows = [(e, f"k{i}", "s", 2020 if e == "big" or i < 3 else 2024) for e, n in (("big", 200), ("thin", 100), ("tiny", 10), (None, 80)) for i in range(n)]
    df = spark.createDataFrame(rows, "event string, key string, season_key string, SeasonYear int")
    out = {(r.event, r.split): r["count"] for r in training.task_split(df, ["event"], min_train=60).groupBy("event", "split").count().collect()}
    assert ranked == [180]
    assert out == {("big", "train"): 200, ("thin", "train"): 70, ("thin", "val"): 15, ("thin", "test"): 15,
                   (None, "train"): 60, (None, "val"): 8, (None, "test"): 12}


def test_generated_methods_stay_compilable(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    fixture.raw_marks(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
