"""Least-absolute-deviation forecasters as repeated aggregations: shared slopes for a model unit, a head per event.

A unit (gender; or gender and season label) predicts an event's standardised target by ``a(event) + b1 x1 + b2 x2``, with
x1 = this season's peak, standardised like the target, and x2 = 1 for outdoor seasons. Absolute error is minimised by
iteratively reweighted least squares: a pass is one aggregation of weighted sums by (unit, event), whose size does not
grow with the samples; the events' sums give the unit's slopes (within events, so heads drop out) and then the heads.
The same aggregation gives the losses of the pass before, so T passes read the samples T + 1 times and collect nothing.

``best_passes`` folds a unit's losses in order and keeps the pass of the last real improvement.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.core import materialize

PASSES = 10
#: Residuals below this count as this (weights are their inverses).
LEAST_RESIDUAL = 1e-2
MIN_IMPROVEMENT, PATIENCE = 1e-3, 5
SUMS = {"s0": lambda x1, x2, z: F.lit(1.0), "s1": lambda x1, x2, z: x1, "s2": lambda x1, x2, z: x2, "sz": lambda x1, x2, z: z,
        "s11": lambda x1, x2, z: x1 * x1, "s12": lambda x1, x2, z: x1 * x2, "s22": lambda x1, x2, z: x2 * x2,
        "s1z": lambda x1, x2, z: x1 * z, "s2z": lambda x1, x2, z: x2 * z}


def features(ts: DataFrame) -> DataFrame:
    """Adds x1 and x2 to a training set (``training.training_set``)."""
    return (ts.withColumn("x1", (F.col("peak_value") - F.col("mu")) / F.col("sd"))
            .withColumn("x2", F.when(F.col("SeasonLabel") == "Outdoors", 1.0).otherwise(0.0)))


def predicted(a: str = "a") -> Column:
    return F.col(a) + F.col("b1") * F.col("x1") + F.col("b2") * F.col("x2")


def solve(sums: DataFrame, unit: list[str]) -> DataFrame:
    """(unit, event, a, b1, b2) from the weighted sums of each event. Slopes that the unit's rows don't determine are 0."""
    within = lambda p, q, pq: F.sum(F.col(pq) - F.col(p) * F.col(q) / F.col("s0"))
    total = sums.groupBy(*unit).agg(within("s1", "s1", "s11").alias("c11"), within("s1", "s2", "s12").alias("c12"),
                                    within("s2", "s2", "s22").alias("c22"), within("s1", "sz", "s1z").alias("c1z"),
                                    within("s2", "sz", "s2z").alias("c2z"))
    c11, c12, c22, c1z, c2z = (F.col(c) for c in ("c11", "c12", "c22", "c1z", "c2z"))
    det = c11 * c22 - c12 * c12
    regular = det > 1e-9 * c11 * c22
    b1 = F.when(regular, (c1z * c22 - c2z * c12) / det).when(c11 > 1e-9, c1z / c11).otherwise(0.0)
    b2 = F.when(regular, (c2z * c11 - c1z * c12) / det).otherwise(0.0)
    slopes = total.select(*unit, b1.alias("b1"), b2.alias("b2"))
    head = (F.col("sz") - F.col("b1") * F.col("s1") - F.col("b2") * F.col("s2")) / F.col("s0")
    return sums.join(slopes, unit).select(*unit, "event", head.alias("a"), "b1", "b2")


def fit(ts: DataFrame, unit: list[str], passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """(parameters by unit, event and pass; losses by unit and pass: mean absolute error in standard units of the
    training and of the validation rows, null where there are none). The first pass is plain least squares; ``ts`` has
    the columns of ``features``. Units and events without training rows have no model."""
    rows = materialize(ts.select(*unit, "event", "split", "x1", "x2", "z"), "lad-rows")
    train = F.col("split") == "train"
    params, losses = [], []
    for t in range(passes + 1):
        if t == 0:
            scored, weight = rows, F.lit(1.0)
        else:
            scored = rows.join(params[-1].drop("pass"), [*unit, "event"])
            scored = scored.withColumn("r", F.abs(F.col("z") - predicted()))
            weight = 1.0 / F.greatest(F.col("r"), F.lit(LEAST_RESIDUAL))
        x1, x2, z = F.col("x1"), F.col("x2"), F.col("z")
        sums = [F.sum(F.when(train, weight * f(x1, x2, z))).alias(name) for name, f in SUMS.items()]
        loss = [F.sum(F.when(F.col("split") == s, F.col("r") if t else F.lit(0.0))).alias(f"l_{s}") for s in ("train", "val")]
        n = [F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val")]
        table = materialize(scored.groupBy(*unit, "event").agg(*sums, *loss, *n), f"lad-{t}").filter(F.col("s0") > 0)
        if t:
            losses.append(table.groupBy(*unit).agg((F.sum("l_train") / F.sum("n_train")).alias("train_loss"),
                                                   F.try_divide(F.sum("l_val"), F.sum("n_val")).alias("val_loss"))
                          .withColumn("pass", F.lit(t)))
        if t < passes:
            params.append(materialize(solve(table, unit).withColumn("pass", F.lit(t + 1)), f"lad-params-{t + 1}"))
    return reduce(DataFrame.unionByName, params), reduce(DataFrame.unionByName, losses)


def best_passes(losses: DataFrame, unit: list[str], min_improvement: float = MIN_IMPROVEMENT, patience: int = PATIENCE) -> DataFrame:
    """(unit, pass, train_loss, val_loss, improved, is_best, stopped): a row for each pass of a unit.

    Passes are read in order. One improves if its validation loss is less than the best so far by more than
    ``min_improvement`` (a tie or a null loss never does); after ``patience`` passes in a row that don't, training has
    stopped, and the passes after that are marked and count no more. is_best: the last improvement before, if any.
    """
    item = F.struct("pass", "train_loss", "val_loss")
    state = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("bad"),
                     F.array().cast("array<struct<pass:int,train_loss:double,val_loss:double,improved:boolean,stopped:boolean>>").alias("seen"))

    def step(s: Column, x: Column) -> Column:
        stopped = s["bad"] >= patience
        better = ~stopped & F.coalesce(x["val_loss"] < s["best"] - min_improvement, F.lit(False))
        row = F.struct(x["pass"].alias("pass"), x["train_loss"].alias("train_loss"), x["val_loss"].alias("val_loss"),
                       better.alias("improved"), stopped.alias("stopped"))
        return F.struct(F.when(better, x["val_loss"]).otherwise(s["best"]).alias("best"),
                        F.when(better, 0).otherwise(s["bad"] + 1).alias("bad"), F.concat(s["seen"], F.array(row)).alias("seen"))

    seen = losses.groupBy(*unit).agg(F.aggregate(F.array_sort(F.collect_list(item)), state, step, lambda s: s["seen"]).alias("seen"))
    last = F.array_max(F.transform(F.filter("seen", lambda x: x["improved"]), lambda x: x["pass"]))
    out = seen.withColumn("last", last).select(*unit, "last", F.inline("seen"))
    return out.select(*unit, "pass", "train_loss", "val_loss", "improved", F.col("pass").eqNullSafe(F.col("last")).alias("is_best"), "stopped")


def best_parameters(params: DataFrame, passes: DataFrame, unit: list[str]) -> DataFrame:
    """(unit, event, a, b1, b2) of each unit's best pass."""
    return params.join(passes.filter("is_best").select(*unit, "pass"), [*unit, "pass"], "left_semi").drop("pass")


def score(ts: DataFrame, params: DataFrame, unit: list[str]) -> DataFrame:
    """Rows that have a model, with yhat in the target's own units."""
    return ts.join(params, [*unit, "event"]).withColumn("yhat", predicted() * F.col("sd") + F.col("mu"))


# ---- one model for each unit, by sums within events ----------------------------------------------------------------

def fit_units(samples: DataFrame, unit: list[str], min_train: int = 60) -> DataFrame:
    """(unit, event, n_unit, mu, sd, mu_x, slope): least squares of the target on this season's peak within events, both
    standardised by the deviation that the event's targets have in this unit.

    All statistics are those of the unit's own training rows (an event whose targets deviate by less than 1e-6: 1). A
    unit with fewer than ``min_train`` training rows is skipped; one whose peaks don't differ within events has slope 0.
    """
    tr = samples.filter(F.col("split") == "train")
    st = tr.groupBy(*unit, "event").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("mu"), F.stddev_pop("y").alias("sd"), F.avg("peak_value").alias("mu_x"),
        F.covar_pop("y", "peak_value").alias("cov"), F.var_pop("peak_value").alias("var"))
    st = materialize(st.withColumn("sd", F.when(F.col("sd") < 1e-6, 1.0).otherwise(F.col("sd"))), "unit-sums")
    scale = F.col("n") / (F.col("sd") * F.col("sd"))
    total = st.groupBy(*unit).agg(F.sum("n").alias("n_unit"), F.sum(F.col("cov") * scale).alias("c"), F.sum(F.col("var") * scale).alias("v"))
    slope = F.when(F.col("v") > 1e-12, F.col("c") / F.col("v")).otherwise(0.0)
    models = total.filter(F.col("n_unit") >= min_train).select(*unit, "n_unit", slope.alias("slope"))
    return st.join(models, unit).select(*unit, "event", "n_unit", "mu", "sd", "mu_x", "slope")


def score_units(samples: DataFrame, models: DataFrame, unit: list[str]) -> DataFrame:
    """Rows whose unit and event have a model, with yhat. The deviation scales both sides, so it cancels."""
    m = models.select(*unit, "event", "n_unit", F.col("mu").alias("m_y"), F.col("mu_x").alias("m_x"), "slope")
    return samples.join(m, [*unit, "event"]).withColumn("yhat", F.col("m_y") + F.col("slope") * (F.col("peak_value") - F.col("m_x"))).drop("m_y", "m_x")
