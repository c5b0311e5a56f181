"""Queries of the per-unit forecasters, their stopping rule and their store."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import lad
from ..operators.training import time_split
from ..session import scratch_path
from ..sources import versions
from . import core
from . import oracle_sql as O
from .registry import SQL, TRAIN_CTES, WINDOW_CTES, _r4, register

_UNIT = ["Gender"]


def _lad_ctes(passes: int = lad.PASSES) -> list[str]:
    """The passes of ``lad.fit`` for genders, one after another."""
    out = ["lad_f AS (SELECT Gender, event, split, y, mu, sd, z, (peak_value - mu) / sd AS x1, "
           "CASE WHEN SeasonLabel = 'Outdoors' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x2 FROM tset)"]
    for t in range(passes + 1):
        if t == 0:
            rows = "(SELECT *, 0.0::DOUBLE AS r, 1.0::DOUBLE AS w FROM lad_f)"
        else:
            rows = (f"(SELECT *, 1.0 / greatest(r, {lad.LEAST_RESIDUAL}) AS w FROM "
                    f"(SELECT lad_f.*, abs(z - (a + b1 * x1 + b2 * x2)) AS r FROM lad_f JOIN lad_p{t} USING (Gender, event)))")
        tr = "FILTER (WHERE split = 'train')"
        out.append(f"""lad_s{t} AS MATERIALIZED (
  SELECT Gender, event, sum(w) {tr} AS s0, sum(w * x1) {tr} AS s1, sum(w * x2) {tr} AS s2, sum(w * z) {tr} AS sz,
         sum(w * x1 * x1) {tr} AS s11, sum(w * x1 * x2) {tr} AS s12, sum(w * x2 * x2) {tr} AS s22, sum(w * x1 * z) {tr} AS s1z,
         sum(w * x2 * z) {tr} AS s2z, sum(r) {tr} AS l_train, count(*) {tr} AS n_train,
         sum(r) FILTER (WHERE split = 'val') AS l_val, count(*) FILTER (WHERE split = 'val') AS n_val
  FROM {rows} GROUP BY Gender, event)""")
        if t < passes:
            out.append(f"""lad_p{t + 1} AS MATERIALIZED (
  SELECT Gender, event, (sz - b1 * s1 - b2 * s2) / s0 AS a, b1, b2 FROM lad_s{t} JOIN (
    SELECT Gender, CASE WHEN det > 1e-9 * c11 * c22 THEN (c1z * c22 - c2z * c12) / det WHEN c11 > 1e-9 THEN c1z / c11 ELSE 0.0 END AS b1,
           CASE WHEN det > 1e-9 * c11 * c22 THEN (c2z * c11 - c1z * c12) / det ELSE 0.0 END AS b2
    FROM (SELECT *, c11 * c22 - c12 * c12 AS det FROM (
      SELECT Gender, sum(s11 - s1 * s1 / s0) AS c11, sum(s12 - s1 * s2 / s0) AS c12, sum(s22 - s2 * s2 / s0) AS c22,
             sum(s1z - s1 * sz / s0) AS c1z, sum(s2z - s2 * sz / s0) AS c2z FROM lad_s{t} WHERE s0 > 0 GROUP BY Gender))) USING (Gender)
  WHERE s0 > 0)""")
    out.append("losses AS (" + " UNION ALL ".join(
        f"SELECT Gender, {t} AS pass, sum(l_train) / sum(n_train) AS train_loss, sum(l_val) / nullif(sum(n_val), 0) AS val_loss "
        f"FROM lad_s{t} WHERE s0 > 0 GROUP BY Gender" for t in range(1, passes + 1)) + ")")
    out.append("params AS (" + " UNION ALL ".join(f"SELECT {t} AS pass, * FROM lad_p{t}" for t in range(1, passes + 1)) + ")")
    out.append(f"""walk(Gender, pass, train_loss, val_loss, improved, stopped, best, bad) AS (
  SELECT Gender, 0, NULL::DOUBLE, NULL::DOUBLE, false, false, 'inf'::DOUBLE, 0 FROM (SELECT DISTINCT Gender FROM losses)
  UNION ALL
  SELECT Gender, l.pass, l.train_loss, l.val_loss, ok, w.bad >= {lad.PATIENCE}, CASE WHEN ok THEN l.val_loss ELSE w.best END,
         CASE WHEN ok THEN 0 ELSE w.bad + 1 END
  FROM (SELECT w.Gender, w.pass AS before, w.best, w.bad FROM walk w) w JOIN (SELECT * FROM losses) l USING (Gender),
       LATERAL (SELECT w.bad < {lad.PATIENCE} AND coalesce(l.val_loss < w.best - {lad.MIN_IMPROVEMENT}, false) AS ok)
  WHERE l.pass = w.before + 1),
passes AS (
  SELECT *, pass IS NOT DISTINCT FROM max(pass) FILTER (WHERE improved) OVER (PARTITION BY Gender) AS is_best FROM walk WHERE pass > 0)""")
    return out


def _recursive(*parts: str, body: str) -> str:
    return O.with_ctes(*parts, body=body).replace("WITH ", "WITH RECURSIVE ", 1)


def _fitted(spark, sf):
    ts = core.materialize(lad.features(core.training(spark, sf)), "lad-training")
    params, losses = lad.fit(ts, _UNIT)
    return ts, params, core.materialize(lad.best_passes(losses, _UNIT), "lad-passes")


@register("m5_best_pass", _recursive(*TRAIN_CTES, *_lad_ctes(), body="""
SELECT Gender, pass, round(train_loss, 4) AS train_loss, round(val_loss, 4) AS val_loss, improved, is_best, stopped FROM passes"""))
def m5_best_pass(spark, sf):
    return _fitted(spark, sf)[2].select("Gender", "pass", _r4("train_loss").alias("train_loss"), _r4("val_loss").alias("val_loss"),
                                        "improved", "is_best", "stopped")


@register("m2_lad_forecast", _recursive(*TRAIN_CTES, *_lad_ctes(), body="""
SELECT Gender, event, round(avg(abs((a + b1 * x1 + b2 * x2) * sd + mu - y)), 4) AS val_mae, count(*) AS n
FROM lad_f JOIN params USING (Gender, event) JOIN passes USING (Gender, pass) WHERE is_best AND split = 'val' GROUP BY Gender, event"""))
def m2_lad_forecast(spark, sf):
    ts, params, passes = _fitted(spark, sf)
    pred = lad.score(ts, lad.best_parameters(params, passes, _UNIT), _UNIT)
    return FC.per_event_mae(pred).select("Gender", "event", _r4("val_mae").alias("val_mae"), "n")


_LABEL_UNIT = ["Gender", "SeasonLabel"]
_UNIT_CTES = (*WINDOW_CTES, """
split0 AS (
  SELECT *, CASE WHEN SeasonYear <= 2023 THEN 'train' WHEN SeasonYear = 2024 THEN 'val' END AS split FROM samples),
unit_events AS (
  SELECT Gender, SeasonLabel, event, count(*) AS n, avg(y) AS mu, avg(peak_value) AS mu_x, covar_pop(y, peak_value) AS cov,
         var_pop(peak_value) AS var, CASE WHEN stddev_pop(y) < 1e-6 THEN 1.0 ELSE stddev_pop(y) END AS sd
  FROM split0 WHERE split = 'train' GROUP BY ALL),
units AS (
  SELECT Gender, SeasonLabel, CAST(sum(n) AS BIGINT) AS n_unit,
         CASE WHEN sum(var * n / (sd * sd)) > 1e-12 THEN sum(cov * n / (sd * sd)) / sum(var * n / (sd * sd)) ELSE 0.0 END AS slope
  FROM unit_events GROUP BY ALL HAVING sum(n) >= 60),
unit_scores AS (
  SELECT s.Gender, s.SeasonLabel, s.event, s.y, s.split, u.n_unit, u.slope, e.mu + u.slope * (s.peak_value - e.mu_x) AS yhat
  FROM split0 s JOIN unit_events e USING (Gender, SeasonLabel, event) JOIN units u USING (Gender, SeasonLabel))""")
_UNIT_METRICS = """
SELECT Gender, SeasonLabel, n_unit, round(slope, 4) AS slope, round(avg(abs(yhat - y)), 4) AS val_mae, count(*) AS n
FROM unit_scores WHERE split = 'val' GROUP BY ALL"""


def _unit_metrics(scored):
    return (scored.filter(F.col("split") == "val").groupBy(*_LABEL_UNIT, "n_unit", "slope")
            .agg(_r4(F.avg(F.abs(F.col("yhat") - F.col("y")))).alias("val_mae"), F.count(F.lit(1)).alias("n"))
            .withColumn("slope", _r4("slope")))


def _unit_samples(spark, sf):
    return time_split(core.materialize(core.samples(spark, sf, with_seq=False), "samples"))


@register("m4_label_models", O.with_ctes(*_UNIT_CTES, body=_UNIT_METRICS))
def m4_label_models(spark, sf):
    samples = _unit_samples(spark, sf)
    return _unit_metrics(lad.score_units(samples, lad.fit_units(samples, _LABEL_UNIT), _LABEL_UNIT))


@register("m7_model_store", SQL["m4_label_models"])
def m7_model_store(spark, sf):
    """Two versions are published, the first from fewer years; the newest is loaded back and scores the samples."""
    root, samples = scratch_path(spark, "model-store"), _unit_samples(spark, sf)
    early = samples.withColumn("split", F.when(F.col("SeasonYear") <= 2020, F.col("split")))
    for training in (early, samples):
        versions.publish_models(lad.fit_units(training, _LABEL_UNIT), root, _LABEL_UNIT)
    return _unit_metrics(lad.score_units(samples, versions.load_models(spark, root).drop("unit"), _LABEL_UNIT))


@register("a14_other_metrics", O.with_ctes(*TRAIN_CTES, """
per_event AS (SELECT Gender, event, avg(abs(peak_value - y)) AS val_mae, count(*) AS n FROM tset WHERE split = 'val' GROUP BY Gender, event),
wide AS (SELECT event FROM per_event GROUP BY event ORDER BY sum(n) DESC, event LIMIT 4)""", body="""
SELECT Gender, event, round(val_mae, 6) AS val_mae, event IN (SELECT event FROM wide) AS has_column FROM per_event"""))
def a14_other_metrics(spark, sf):
    """Every trained event's value, read back from the wide row: from its column, or from the map of the others."""
    pred = core.materialize(FC.persistence(core.training(spark, sf)), "persistence")
    per_event = FC.per_event_mae(pred)
    events = FC.metric_events(per_event, 4)
    n_events = pred.groupBy("Gender").agg(F.countDistinct("event").alias("n_events"))
    row = (FC.wide_metrics(per_event, FC.overall_mae(pred), n_events, events)
           .join(FC.other_metrics(per_event, events), "Gender", "left"))
    columns = F.array(*(F.struct(F.lit(e).alias("event"), F.col(f"`ValMAE_{e}`").alias("val_mae"), F.lit(True).alias("has_column")) for e in events)).cast("array<struct<event: string, val_mae: double, has_column: boolean>>")
    rest = F.transform(F.map_entries(F.coalesce("other_val_mae", F.create_map().cast("map<string,double>"))),
                       lambda x: F.struct(x["key"].alias("event"), x["value"].alias("val_mae"), F.lit(False).alias("has_column")))
    return (row.select("Gender", F.inline(F.concat(columns, rest))).filter(F.col("val_mae").isNotNull())
            .select("Gender", "event", F.round("val_mae", 6).alias("val_mae"), "has_column"))
