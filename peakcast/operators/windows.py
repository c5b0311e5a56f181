"""K-season history windows labelled with next year's same-label peak.

Plan shape: the season table is hash-partitioned on the key once; the
history frame (``rowsBetween(-(K-1), 0)`` over key) and the next-season frame
(``rangeBetween(1, 1)`` over key + label) both accept that partitioning, so
the two windows cost one exchange and two sorts. Rows per key are bounded by
the number of distinct seasons, so a hot key cannot blow up a task here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import season_label_id, season_label_order
from .sequences import SEQ_FIELDS

SEQ_TYPE = T.ArrayType(T.StructType([T.StructField(f, T.DoubleType()) for f in SEQ_FIELDS]))


def season_order(key: str = "fam_key") -> Window:
    return Window.partitionBy(key).orderBy(
        F.col("SeasonYear"), season_label_order(F.col("SeasonLabel")).asc_nulls_last(), F.col("SeasonLabel"))


def history_windows(seasons: DataFrame, key: str = "fam_key", k: int = 4,
                    with_seq: bool = True) -> DataFrame:
    """One row per labelled sample (a season whose key has the same label next year).

    Output: key, season_key, SeasonYear (= sample year), SeasonLabel, Gender, family, event (modal
    event of the last season), peak_value (current peak), y (next peak), n_seasons, and
    ``window``: array of K structs (season_key, label_id, length, peak[, seq]) left-padded with
    (null, 0, 0, null[, []]).
    """
    fields = [F.col("season_key"), season_label_id(F.col("SeasonLabel")).alias("label_id"),
              F.col("length"), F.col("peak_value").alias("peak")]
    pad_fields = [F.lit(None).cast("string").alias("season_key"), F.lit(0).alias("label_id"),
                  F.lit(0).alias("length"), F.lit(None).cast("double").alias("peak")]
    if with_seq:
        fields.append(F.col("seq").cast(SEQ_TYPE).alias("seq"))
        pad_fields.append(F.array().cast(SEQ_TYPE).alias("seq"))
    w_hist = season_order(key).rowsBetween(-(k - 1), 0)
    w_next = Window.partitionBy(key, "SeasonLabel").orderBy("SeasonYear").rangeBetween(1, 1)
    s = (seasons.withColumn("_hist", F.collect_list(F.struct(*fields)).over(w_hist))
         .withColumn("y", F.first("peak_value", ignorenulls=True).over(w_next))
         .filter(F.col("y").isNotNull()))
    pad = F.struct(*pad_fields)
    window = F.concat(F.array_repeat(pad, F.lit(k) - F.size("_hist")), F.col("_hist"))
    return s.select(
        key, "season_key", "SeasonYear", "SeasonLabel", "Gender", "family",
        F.col("event_used").alias("event"), "peak_value", "y",
        F.greatest(F.size(F.filter("_hist", lambda x: x["length"] > 0)), F.lit(1)).alias("n_seasons"),
        window.alias("window"),
    )


def explode_window(samples: DataFrame, key: str = "fam_key") -> DataFrame:
    """One row per real (non-pad) history season: slot is its position in the padded window."""
    return (samples.select(key, F.col("season_key").alias("target_season_key"),
                           F.posexplode("window").alias("slot", "h"))
            .filter(F.col("h.length") > 0)
            .select(key, "target_season_key", "slot",
                    F.col("h.season_key").alias("hist_season_key"),
                    F.col("h.label_id").alias("label_id"), F.col("h.length").alias("length")))


def flat_features(samples: DataFrame, seqlen: int = 32) -> DataFrame:
    """Dense K * L * 3 vector for a learner: every window season left-padded to L, then flattened."""
    from .sequences import pad_left
    return samples.withColumn(
        "x", F.flatten(F.transform("window", lambda s: F.flatten(
            F.transform(pad_left(s["seq"], seqlen), lambda m: F.array(m["value"], m["gap"], m["wind"]))))))
