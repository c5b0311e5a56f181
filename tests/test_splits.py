"""Seeded shuffle: exact places whatever the partitioning, groups of any kind, bounded windows."""

import hashlib

import pytest

from peakcast.operators import training as T


def rows_of(n, groups=("a", "b", None)):
    return [(groups[i % len(groups)], f"k{i}", "2024-Indoors", 2024) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "Gender string, fam_key string, season_key string, SeasonYear int")


@pytest.mark.parametrize("per_bucket", [4096, 7, 1])
def test_rank_is_the_place_in_the_shuffle(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(T, "ROWS_PER_BUCKET", per_bucket)
    rows = rows_of(500) + [("hot", f"h{i}", "2024-Indoors", 2024) for i in range(300)]
    want = {}
    for g in {r[0] for r in rows}:
        order = sorted((hashlib.md5(f"{k}:{s}:42".encode()).hexdigest(), k) for h, k, s, _ in rows if h == g)
        want |= {(g, k): (i, len(order)) for i, (_, k) in enumerate(order)}
    for parts in (1, 5):
        got = T.seeded_rank(frame(spark, rows).repartition(parts), ["Gender"], ["fam_key", "season_key"], 42)
        assert {(r.Gender, r.fam_key): (r._rank, r._n) for r in got.collect()} == want


def test_repeated_keys_and_empty_tables(spark):
    rows = [("a", "same", "s", 2024)] * 20
    got = T.seeded_rank(frame(spark, rows), ["Gender"], ["fam_key", "season_key"], 42)
    assert sorted(r._rank for r in got.collect()) == list(range(20))
    assert T.seeded_rank(frame(spark, []), ["Gender"], ["fam_key"], 42).count() == 0
    assert T.time_split(frame(spark, [])).count() == 0


def test_split_by_year_needs_no_exchange(spark):
    rows = [(g, f"k{i}", "s", y) for i, (g, y) in enumerate([("a", 2022), ("a", 2024), (None, 2020), (None, 2026)])]
    split = T.time_split(frame(spark, rows))
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    assert {(r.Gender, r.SeasonYear, r.split) for r in split.collect()} == {
        ("a", 2022, "train"), ("a", 2024, "val"), (None, 2020, "train"), (None, 2026, None)}


def test_many_groups_are_joined_like_few(spark, monkeypatch):
    rows = [(g, f"{g}{i}", "s", 2022 if g == "a" and i < 3 else 2025) for g in ("a", "b", "c", None) for i in range(20)]
    few = sorted(map(tuple, T.time_split(frame(spark, rows)).collect()), key=repr)
    monkeypatch.setattr(T, "LISTED_GROUPS", 1)
    assert sorted(map(tuple, T.time_split(frame(spark, rows)).collect()), key=repr) == few
    assert sum(r[-1] == "train" for r in few) == 3 + 3 * 16


def test_groups_of_two_columns(spark):
    rows = [(g, f"{g}{s}{i}", s, 2022 if (g, s) != ("b", "x") else 2026) for g in "ab" for s in "xy" for i in range(20)]
    got = T.time_split(frame(spark, rows), group=("Gender", "season_key"), fallback=(0.7, 0.85))
    n = {(r.Gender, r.season_key, r.split): r["count"] for r in got.groupBy("Gender", "season_key", "split").count().collect()}
    assert n == {("a", "x", "train"): 20, ("a", "y", "train"): 20, ("b", "y", "train"): 20,
                 ("b", "x", "train"): 14, ("b", "x", "val"): 3, ("b", "x", "test"): 3}


def test_inverse_z(spark):
    got = spark.sql("SELECT 2.0D AS z, 10.0D AS mu, 0.5D AS sd").select(T.inverse_z("z", "mu", "sd").alias("y")).head().y
    assert got == 11.0
