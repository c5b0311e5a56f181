"""Forecasters from aggregated sums, the stopping rule and the model store."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakcast.operators import forecast, lad
from peakcast.operators.lookup import resolve_events
from peakcast.sources import versions
from peakcast.streaming import peaks

UNIT = ["Gender"]


def signal(spark, n=1500, seed=2):
    """Targets that follow the athlete's peak at half its size, with some wild outliers."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g, e = rng.choice("MW"), rng.choice(["100 Meters", "Shot Put", "Mile"])
        base = {"100 Meters": 11.0, "Shot Put": 15.0, "Mile": 260.0}[e]
        peak = base + rng.gauss(0, 1)
        y = base + 0.5 * (peak - base) + rng.gauss(0, 0.1) + (rng.choice([-40, 40]) if rng.random() < 0.03 else 0)
        rows.append((g, e, "Outdoors" if i % 2 else "Indoors", "train" if i % 4 else "val", peak, y, base, 1.0, (y - base)))
    return spark.createDataFrame(rows, "Gender string, event string, SeasonLabel string, split string, peak_value double, y double, mu double, sd double, z double")


def brute_lad(rows, passes):
    """The same passes in numpy, for one unit."""
    tr = [r for r in rows if r["split"] == "train"]
    events = sorted({r["event"] for r in tr})
    x = np.array([[r["peak_value"] - r["mu"], float(r["SeasonLabel"] == "Outdoors"), *(float(r["event"] == e) for e in events)] for r in tr])
    z, w, b = np.array([r["z"] for r in tr]), np.ones(len(tr)), None
    for _ in range(passes):
        s = np.sqrt(w)[:, None]
        b = np.linalg.lstsq(x * s, z * s[:, 0], rcond=None)[0]
        w = 1 / np.maximum(np.abs(z - x @ b), lad.LEAST_RESIDUAL)
    return b, events


def test_lad_matches_weighted_least_squares_and_beats_persistence(spark):
    ts = lad.features(signal(spark))
    params, losses = lad.fit(ts, UNIT, passes=4)
    rows = [r.asDict() for r in ts.collect()]
    for g in "MW":
        b, events = brute_lad([r for r in rows if r["Gender"] == g], 4)
        got = {r["event"]: r for r in params.filter((F.col("Gender") == g) & (F.col("pass") == 4)).collect()}
        assert np.allclose([got[events[0]]["b1"], got[events[0]]["b2"], *(got[e]["a"] for e in events)], b, atol=1e-6)
        assert abs(b[0] - 0.5) < 0.02
    pred = lad.score(ts, lad.best_parameters(params, lad.best_passes(losses, UNIT), UNIT), UNIT)
    mae = lambda df: {r[0]: r[1] for r in forecast.overall_mae(df).collect()}
    ours, persistence = mae(pred), mae(forecast.persistence(ts))
    assert all(ours[g] < persistence[g] for g in "MW")


def walk(spark, values):
    df = spark.createDataFrame([("u", i + 1, 1.0, None if v is None else float(v)) for i, v in enumerate(values)], "Gender string, pass int, train_loss double, val_loss double")
    rows = sorted(lad.best_passes(df.repartition(3), UNIT).collect(), key=lambda r: r["pass"])
    return [r["pass"] for r in rows if r["is_best"]], [r["pass"] for r in rows if r["stopped"]], [r["pass"] for r in rows if r["improved"]]


def test_best_pass_rule(spark):
    assert walk(spark, [5, 4, 3, 2]) == ([4], [], [1, 2, 3, 4])
    assert walk(spark, [5, 5, 5, 5, 5, 5, 1]) == ([1], [7], [1])  # ties never improve; five of them stop
    assert walk(spark, [5, 4.9995, 4.9985]) == ([3], [], [1, 3])  # less than the least improvement counts from the best
    assert walk(spark, [None, None, 3, None]) == ([3], [], [3])
    assert walk(spark, [None] * 7) == ([], [6, 7], [])  # nothing ever improves
    assert walk(spark, [float("nan"), 2.0]) == ([2], [], [2])


def test_units_use_their_own_statistics(spark):
    s = signal(spark).filter("SeasonLabel = 'Indoors' OR Gender = 'M'")
    thin = s.filter("Gender = 'W'").limit(20)
    s = s.filter("Gender = 'M'").unionByName(thin)
    unit = ["Gender", "SeasonLabel"]
    models = lad.fit_units(s, unit)
    assert {tuple(r) for r in models.select(*unit).distinct().collect()} == {("M", "Indoors"), ("M", "Outdoors")}  # W is thin
    rows = [r for r in s.filter("Gender = 'M' AND SeasonLabel = 'Indoors' AND split = 'train'").collect()]
    num = den = 0.0
    for e in {r["event"] for r in rows}:
        x, y = (np.array([r[c] for r in rows if r["event"] == e]) for c in ("peak_value", "y"))
        num, den = num + ((x - x.mean()) * (y - y.mean())).sum() / y.var(), den + ((x - x.mean()) ** 2).sum() / y.var()
    got = models.filter("SeasonLabel = 'Indoors'").select("slope").distinct().collect()
    assert len(got) == 1 and abs(got[0]["slope"] - num / den) < 1e-9
    assert lad.fit_units(s.limit(0), unit).count() == 0


def test_model_store(spark, tmp_path):
    root = str(tmp_path / "store")
    models = spark.createDataFrame([("Men", "100 Meters", 1.5), ("Women", "4 x 800 Relay", 2.5)], "Gender string, event string, slope double")
    with pytest.raises(FileNotFoundError):
        versions.load_models(spark, root)
    assert versions.publish_models(models, root, ["Gender", "event"]) == 1
    assert versions.publish_models(models.withColumn("slope", F.col("slope") * 2), root, ["Gender", "event"]) == 2
    one = versions.load_models(spark, root, units=["Women__4_x_800_Relay"]).collect()
    assert [(r["unit"], r["slope"]) for r in one] == [("Women__4_x_800_Relay", 5.0)]
    assert versions.load_models(spark, root, version=1).agg(F.sum("slope")).head()[0] == 4.0
    clash = spark.createDataFrame([("Men", "4x100 m", 1.0), ("Men", "4x100_m", 2.0)], "Gender string, event string, slope double")
    with pytest.raises(ValueError, match="Men__4x100_m"):
        versions.publish_models(clash, root, ["Gender", "event"])
    assert versions.pointers(spark, root) == [1, 2]
    assert not versions.point(spark, root, 2, "elsewhere") and versions.newest(spark, root)[0] == 2  # a taken number stays


# ---- the streaming table --------------------------------------------------------------------

PEAKS = "fam_key string, season_key string, SeasonYear int, SeasonLabel string, Gender string, family string, is_time boolean, peak_value double, n_marks long"


def batch(spark, athletes, value):
    return spark.createDataFrame([(a, "2024|Outdoors", 2024, "Outdoors", "Men", "sprints", True, value, 1) for a in athletes], PEAKS)


def table(spark, root, version=None):
    return sorted((r["fam_key"], r["peak_value"]) for r in peaks.read_peaks(spark, root, version).collect())


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    merge = peaks.merge_batch(root, 8)
    merge(batch(spark, [f"a{i}" for i in range(200)], 1.0), 0)
    before = {p: p.stat().st_mtime_ns for p in Path(root, "data").rglob("*.parquet")}
    merge(batch(spark, ["a7"], 2.0), 1)
    after = {p: p.stat().st_mtime_ns for p in Path(root, "data").rglob("*.parquet")}
    assert len(after) == len(before) + 1 and all(after[p] == t for p, t in before.items())  # one bucket, one file
    want = sorted((f"a{i}", 2.0 if i == 7 else 1.0) for i in range(200))
    assert table(spark, root) == want and table(spark, root, 1) == sorted((f"a{i}", 1.0) for i in range(200))
    merge(batch(spark, ["a7"], 9.0), 1)  # replayed: already there
    assert table(spark, root) == want and versions.pointers(spark, root) == [1, 2]
    peaks.merge_batch(root, 8, source="other")(batch(spark, ["new"], 5.0), 0)  # another stream's batch 0 is no replay
    assert table(spark, root) == sorted([*want, ("new", 5.0)])
    assert peaks.vacuum(spark, root, keep=1) >= 1 and table(spark, root) == sorted([*want, ("new", 5.0)])


def test_killed_before_publishing_then_replayed(spark, tmp_path):
    root = str(tmp_path / "t")
    peaks.merge_batch(root, 4)(batch(spark, ["a", "b"], 1.0), 0)

    def die():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        peaks.merge_batch(root, 4, before_publish=die)(batch(spark, ["b", "c"], 2.0), 1)
    assert table(spark, root) == [("a", 1.0), ("b", 1.0)]
    peaks.merge_batch(root, 4)(batch(spark, ["b", "c"], 2.0), 1)
    assert table(spark, root) == [("a", 1.0), ("b", 2.0), ("c", 2.0)]


def test_buckets_follow_the_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    merge = peaks.merge_batch(root, 2, rows_per_bucket=10)
    for i in range(4):
        merge(batch(spark, [f"a{j}" for j in range(i * 20, i * 20 + 25)], float(i)), i)
    want = {f"a{j}": float(i) for i in range(4) for j in range(i * 20, i * 20 + 25)}
    assert table(spark, root) == sorted(want.items())
    assert peaks._table(spark, root, 2)["buckets"] == 8 and sum(peaks._table(spark, root, 2)["rows"].values()) == len(want)
    merge(batch(spark, [], 0.0), 4)
    assert table(spark, root) == sorted(want.items())


# ---- event lookup and wide metrics ----------------------------------------------------------

def test_lookup_matches_all_pairs(spark):
    rng = random.Random(8)
    events = [("M", e, i) for i, e in enumerate(["100 Meters", "110 Hurdles", "Mile", "aXa", "AxA b", "\u00c9t\u00e9", "Shot  Put"])] + [("W", "Mile", 0)]
    texts = ["", " ", "1", "7", "8", "0", "mile", "Mile", "MILE ", "m", "me", "hur", "x", "axa", "\u00e9t", "  put", "t  p", "zzz", "99999999999999999999"]
    texts += ["".join(rng.choice("axA b10") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    req = [(g, t) for g in ("M", "W", "X", None) for t in texts] + [("M", None)]
    got = {(r[0], r[1]): (r[2], r[3]) for r in resolve_events(spark.createDataFrame(req, "gender string, text string"),
                                                              spark.createDataFrame(events, "Gender string, event string, event_id int")).collect()}
    for g, t in set(req):
        own = [(e, i) for x, e, i in events if x == g] if t is not None else []
        raw = (t or "").strip()
        at = [e for e, i in own if raw.isdigit() and int(raw) - 1 == i]
        sub = [e for e, _ in own if raw.lower() in e.lower()]
        want = at[0] if at else raw if any(e == raw for e, _ in own) else sub[0] if len(sub) == 1 else None
        assert got[g, t] == (want, "ok" if want else "ambiguous" if len(sub) > 1 else "not_found"), (g, t)


def test_no_event_is_lost_from_the_wide_row(spark):
    per = spark.createDataFrame([("Men", "Mile", 1.0, 9), ("Men", "Heptathlon", 2.0, 3), ("Women", "4 x 800 Relay", 3.0, 2), ("Women", "Mile", 4.0, 1)],
                                "Gender string, event string, val_mae double, n long")
    events = forecast.metric_events(per, 1)
    assert events == ["Mile"] and forecast.metric_events(per) == ["4 x 800 Relay", "Heptathlon", "Mile"]
    got = {r[0]: r[1] for r in forecast.other_metrics(per, events).collect()}
    assert got == {"Men": {"Heptathlon": 2.0}, "Women": {"4 x 800 Relay": 3.0}}
