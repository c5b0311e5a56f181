"""Forecasting, re-aimed as Spark jobs: baselines, per-task models, a GBT forecaster, metrics, scoring.

* Persistence control: forecast = the current season's peak.
* Per-task linear models (one per event x gender x season label): fitted from
  sufficient statistics with ``regr_slope`` / ``regr_intercept`` — an ordinary
  grouped aggregation with map-side partial sums, so no task's samples are ever
  gathered in one place, however many there are.
* A per-gender gradient-boosted forecaster (``pyspark.ml``) with absolute-error
  loss on z-scored targets, features built from the history window.
* Metrics: per-event MAE with n, overall MAE, and the wide per-gender table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (fmt_dist, fmt_time, is_time_event, parse_date, submitted_mark, submitted_wind,
                         window_label_id)
from .sequences import SEQ_FIELDS

TASK_KEYS = ["event", "Gender", "SeasonLabel"]


# ---- metrics ----------------------------------------------------------------------------

def per_event_mae(pred: DataFrame, yhat: str = "yhat", group: str = "Gender", split: str = "val") -> DataFrame:
    """(gender, event, val_mae, n) over the chosen split; events without rows are absent."""
    return (pred.filter(F.col("split") == split)
            .groupBy(group, "event")
            .agg(F.avg(F.abs(F.col(yhat) - F.col("y"))).alias("val_mae"), F.count(F.lit(1)).alias("n")))


def overall_mae(pred: DataFrame, yhat: str = "yhat", group: str = "Gender", split: str = "val") -> DataFrame:
    """Overall MAE in native units per gender (NaN when a gender has no rows of the split)."""
    return (pred.groupBy(group)
            .agg(F.coalesce(F.avg(F.when(F.col("split") == split, F.abs(F.col(yhat) - F.col("y")))),
                            F.lit(float("nan"))).alias("overall_val_mae")))


def weighted_mean_loss(per_batch: DataFrame, loss: str = "loss", n: str = "n") -> DataFrame:
    """Sample-weighted mean of per-batch losses: sum(l * n) / max(sum(n), 1)."""
    return per_batch.agg((F.sum(F.col(loss) * F.col(n)) / F.greatest(F.sum(n), F.lit(1))).alias("mean_loss"))


def wide_metrics(per_event: DataFrame, overall: DataFrame, n_events: DataFrame, events: list[str],
                 group: str = "Gender") -> DataFrame:
    """One row per gender: overall_val_mae, n_events and a ``ValMAE_<event>`` column for each of ``events`` (null
    where the gender has no value). The list fixes the columns, so no job looks for pivot values."""
    if not events:  # nothing was valued, so there is no column to add
        return overall.join(n_events, group, "left")
    wide = per_event.groupBy(group).agg(*(F.max(F.when(F.col("event") == e, F.col("val_mae"))).alias(f"ValMAE_{e}")
                                          for e in events))
    return overall.join(n_events, group, "left").join(wide, group, "left")


#: Events that get a column of their own, at most.
MAX_EVENT_COLUMNS = 200


def metric_events(per_event: DataFrame, most: int = MAX_EVENT_COLUMNS) -> list[str]:
    """Events for the columns of ``wide_metrics``, by name: the ``most`` events with the most rows in all groups (ties:
    by name). The driver gets that many names, however many events there are."""
    rows = per_event.groupBy("event").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "event").limit(most).collect()
    return sorted(r["event"] for r in rows if r["event"] is not None)


def other_metrics(per_event: DataFrame, events: list[str], group: str = "Gender") -> DataFrame:
    """(group, other_val_mae): a map with the values of all events that have no column of their own. With
    ``wide_metrics`` of the same ``events``, no event's value is lost."""
    rest = per_event.filter(~F.col("event").isin(events) & F.col("val_mae").isNotNull() & F.col("event").isNotNull())
    return rest.groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event", "val_mae")))).alias("other_val_mae"))


# ---- persistence control ----------------------------------------------------------------

def persistence(ts: DataFrame) -> DataFrame:
    """Forecast next season's peak as this season's peak."""
    return ts.withColumn("yhat", F.col("peak_value"))


# ---- per-task linear models from sufficient statistics ------------------------------------

def fit_task_models(ts: DataFrame, min_train: int = 60, keys: list[str] = TASK_KEYS) -> DataFrame:
    """y ~ a + b * peak_value per task on training rows; tasks with fewer rows are skipped.

    A task whose peaks are all equal gets slope 0 and the training mean as intercept.
    """
    tr = ts.filter(F.col("split") == "train")
    m = tr.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.regr_slope(F.col("y"), F.col("peak_value")).alias("_b"),
        F.regr_intercept(F.col("y"), F.col("peak_value")).alias("_a"),
        F.avg("y").alias("_mean"))
    return (m.filter(F.col("n_train") >= min_train)
            .select(*keys, "n_train",
                    F.coalesce(F.col("_b"), F.lit(0.0)).alias("slope"),
                    F.coalesce(F.col("_a"), F.col("_mean")).alias("intercept")))


def score_task_models(samples: DataFrame, models: DataFrame, keys: list[str] = TASK_KEYS) -> DataFrame:
    """Apply the task models: one model row per (event, gender, label); AQE broadcasts them where they are small."""
    return (samples.join(models, keys, "inner")
            .withColumn("yhat", F.col("intercept") + F.col("slope") * F.col("peak_value")))


def latest_seasons(seasons: DataFrame, key: str = "fam_key") -> DataFrame:
    """Newest season of every key (year, then label order); one window over the season table."""
    from .windows import season_order
    w = season_order(key).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (seasons.withColumn("_last", F.last("season_key").over(w))
            .filter(F.col("season_key") == F.col("_last")).drop("_last"))


def format_forecast(value: Column, event: Column) -> Column:
    """``m:ss.ff`` / ``ss.ffs`` for time events, ``x.xx m`` otherwise; ``n/a`` if not finite."""
    return F.when(is_time_event(event), fmt_time(value)).otherwise(fmt_dist(value))


# ---- gradient-boosted forecaster (rows-only check) ---------------------------------------

def window_features(samples: DataFrame, k: int = 4) -> DataFrame:
    """Numeric features of a history window, standardised with the event's training mu / sd.

    Peaks of the last K seasons (z, 0 for padding), and for the newest season: best, last, mean,
    std, count, mean gap, mean wind; plus the season-label id.
    """
    last = F.element_at("window", -1)
    vals = F.transform(last["seq"], lambda m: m["value"])
    z = lambda c: (c - F.col("mu")) / F.col("sd")
    n = F.size(vals)
    mean = F.aggregate(vals, F.lit(0.0), lambda a, x: a + x) / F.greatest(n, F.lit(1))
    sq = F.aggregate(vals, F.lit(0.0), lambda a, x: a + x * x) / F.greatest(n, F.lit(1))
    gaps = F.transform(last["seq"], lambda m: m["gap"])
    winds = F.transform(last["seq"], lambda m: m["wind"])
    best = F.when(F.col("is_time_ev"), F.array_min(vals)).otherwise(F.array_max(vals))
    feats = [z(best), z(F.element_at(vals, -1)), z(mean),
             F.sqrt(F.greatest(sq - mean * mean, F.lit(0.0))) / F.col("sd"), n.cast("double"),
             F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x) / F.greatest(n, F.lit(1)),
             F.aggregate(winds, F.lit(0.0), lambda a, x: a + x) / F.greatest(n, F.lit(1)),
             last["label_id"].cast("double")]
    hist = [F.when(F.col("_hpeaks")[i].isNull(), F.lit(0.0)).otherwise(z(F.col("_hpeaks")[i])) for i in range(k)]
    return samples.withColumn("is_time_ev", is_time_event(F.col("event"))).withColumn(
        "features_arr", F.array(*[f.cast("double") for f in feats + hist]))


def gbt_forecast(ts_with_windows: DataFrame, k: int = 4, max_iter: int = 10, seed: int = 1,
                 group_keys: tuple[str, ...] = ("Gender",), early_stop: bool = False,
                 save_root: str | None = None) -> DataFrame:
    """One forecaster per group (gender; or gender x season label for the per-label variant).

    Fits on train rows (z target, absolute loss); with ``early_stop`` the validation rows are
    the stopping set (tolerance 1e-3). Predicts validation rows in native units. With
    ``save_root`` each model is saved under ``<root>/<slug of group>``.
    """
    import re

    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor

    df = window_features(ts_with_windows.withColumn("_hpeaks", F.transform("window", lambda x: x["peak"])), k)
    # Iterative fitting re-reads its input many times: cut the lineage with a reliable
    # checkpoint of the narrow feature table (in the session's shared checkpoint folder).
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    df = (df.select("fam_key", "season_key", *[g for g in group_keys if g != "Gender"], "Gender", "event",
                    "event_id", "split", "y", "z", "mu", "sd", "features_arr").checkpoint(eager=True))
    df = df.withColumn("x", array_to_vector("features_arr")).withColumn("event_id_d", F.col("event_id").cast("double"))
    enc = OneHotEncoder(inputCols=["event_id_d"], outputCols=["event_vec"], handleInvalid="keep")
    asm = VectorAssembler(inputCols=["x", "event_vec"], outputCol="features")
    extra = {"validationIndicatorCol": "is_val", "validationTol": 1e-3} if early_stop else {}
    gbt = GBTRegressor(featuresCol="features", labelCol="z", lossType="absolute", maxIter=max_iter, seed=seed,
                       **extra)
    if early_stop:
        df = df.withColumn("is_val", F.col("split") == "val")
    out = []
    groups = [tuple(r) for r in df.select(*group_keys).distinct().collect()]  # a handful of model units
    for g in groups:
        cond = F.lit(True)
        for c, v in zip(group_keys, g):
            cond = cond & (F.col(c) == F.lit(v))
        part = df.filter(cond)
        fit_on = part.filter(F.col("split").isin("train", "val") if early_stop else F.col("split") == "train")
        model = Pipeline(stages=[enc, asm, gbt]).fit(fit_on)
        if save_root:
            name = re.sub(r"[^A-Za-z0-9]+", "_", "_".join(str(v) for v in g)).strip("_")
            model.write().overwrite().save(f"{save_root}/{name}")
        out.append(model.transform(part.filter(F.col("split") == "val")))
    if not out:
        return df.limit(0).withColumn("yhat", F.lit(None).cast("double"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res.withColumn("yhat", F.col("prediction") * F.col("sd") + F.col("mu"))


# ---- one-season scoring blocks ------------------------------------------------------------

def scoring_blocks(subs: DataFrame, seqlen: int = 32, undated_gap_days: int = 0) -> DataFrame:
    """Submissions ``(submission_id, season_label, event, mark_no, date_text, mark, wind)`` -> steps.

    Marks parse as for a submitted form (time pattern for time events, else a number); a
    submission with any date is ordered by date with undated marks as 2000-01-01 (stable by
    mark_no). Gap: first 0; dated marks count days since the previous dated mark (clipped at 0);
    undated marks get 0 before any dated mark, else ``undated_gap_days``. Indoor wind is 0. Only
    the last ``seqlen`` marks are kept; ``step`` is the position in the left-padded block.

    Three limited ranks run before the shuffle: the newest ``seqlen`` marks, the newest ``seqlen + 1`` dated ones
    (the predecessor of any kept dated mark is among them, however many undated marks lie between) and the
    oldest dated one (whether a dated mark precedes an undated one).
    """
    d = parse_date(F.col("date_text"))
    s = subs.select("submission_id", "season_label", "event", "mark_no", d.alias("date"),
                    submitted_mark(F.col("mark"), is_time_event(F.col("event"))).alias("value"),
                    submitted_wind(F.col("wind"), F.col("season_label")).alias("wind"))
    # Three branches read the parsed marks: parsed and written once.
    from ..plans.core import materialize
    # The drop is a 0-or-1 element generator: a Filter would be pushed below the parsers and run them twice.
    one = F.array(F.struct(F.col("value").alias("value")))
    s = s.select("submission_id", "mark_no", "date", "wind", F.inline(F.when(F.col("value").isNotNull(), one)))
    s = materialize(s, "submissions")
    order = [F.coalesce(F.col("date"), F.to_date(F.lit("2000-01-01"))), F.col("mark_no")]
    w_desc = Window.partitionBy("submission_id").orderBy(*[o.desc() for o in order])
    rank = F.row_number().over(w_desc)
    dated = s.filter(F.col("date").isNotNull())
    newest = s.withColumn("_rn_desc", rank).filter(F.col("_rn_desc") <= seqlen)
    before = dated.withColumn("_r", rank).filter(F.col("_r") <= seqlen + 1).drop("_r")
    oldest = (dated.withColumn("_r", F.row_number().over(Window.partitionBy("submission_id").orderBy(*order)))
              .filter(F.col("_r") <= 1).drop("_r"))
    no_rank = F.lit(None).cast("int").alias("_rn_desc")
    s = (newest.unionByName(before.select("*", no_rank)).unionByName(oldest.select("*", no_rank))
         .groupBy("submission_id", "mark_no").agg(F.first("date").alias("date"), F.first("value").alias("value"),
                                                  F.first("wind").alias("wind"), F.max("_rn_desc").alias("_rn_desc")))
    w = Window.partitionBy("submission_id").orderBy(*order)
    prev_dated = F.last("date", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    gap = (F.when(F.col("date").isNull(), F.when(prev_dated.isNull(), F.lit(0)).otherwise(F.lit(undated_gap_days)))
           .otherwise(F.coalesce(F.greatest(F.datediff(F.col("date"), prev_dated), F.lit(0)), F.lit(0))))
    return (s.withColumn("gap", gap.cast("double"))
            .filter(F.col("_rn_desc") <= seqlen)
            .select("submission_id", (F.lit(seqlen) - F.col("_rn_desc")).alias("step"), "value", "gap", "wind"))


def scoring_window(blocks: DataFrame, subs_meta: DataFrame, events: DataFrame, k: int = 4,
                   vocab: int = 2) -> tuple[DataFrame, DataFrame]:
    """K-1 empty seasons + the submitted one; unknown events go to a rejects table.

    Returns (windows(submission_id, event, label_ids array, lengths array, n_seasons), rejects).
    """
    meta = subs_meta.select("submission_id", "season_label", "event", "gender").distinct()
    known = meta.join(events.select(F.col("Gender").alias("gender"), "event"), ["gender", "event"], "left_semi")
    rejects = meta.join(events.select(F.col("Gender").alias("gender"), "event"), ["gender", "event"], "left_anti")
    lens = blocks.groupBy("submission_id").agg(F.count(F.lit(1)).cast("int").alias("length"))
    pad_id = window_label_id(F.lit("PAD"), vocab)
    win = known.join(lens, "submission_id", "left").select(
        "submission_id", "gender", "event",
        F.concat(F.array_repeat(pad_id, k - 1), F.array(window_label_id(F.col("season_label"), vocab))).alias("label_ids"),
        F.concat(F.array_repeat(F.lit(0), k - 1), F.array(F.coalesce(F.col("length"), F.lit(0)))).alias("lengths"),
        F.lit(1).alias("n_seasons"))
    return win, rejects


__all__ = ["per_event_mae", "overall_mae", "wide_metrics", "persistence", "fit_task_models", "score_task_models",
           "latest_seasons", "format_forecast", "gbt_forecast", "scoring_blocks", "scoring_window",
           "weighted_mean_loss", "metric_events", "other_metrics", "SEQ_FIELDS"]
