"""Training-set construction: time split, rare-event filter, event ids, per-event z-scores.

Per-gender work is a grouping key, never a driver loop and never a collect. Per-group
flags and per-(gender, event) statistics are aggregates joined back without a forced
hint: event names are free text, so their number is not bounded in advance; AQE
broadcasts the aggregate where its measured size allows and splits skewed partitions
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Defaults: the published runs used train <= 2023 / validation == 2024 (the code's own
# constants are 2024 / 2025, which cannot have labels); both are parameters.
TRAIN_MAX_YEAR = 2023
VALID_YEAR = 2024
MIN_TRAIN_PER_EVENT = 60
SPLIT_SEED = 42


ROWS_PER_BUCKET = 4096  # rows that one task ranks at a time, about
#: Groups without training rows that are named in the plan; if there are more, they are joined.
LISTED_GROUPS = 64


def same_group(left: DataFrame, right: DataFrame, cols: list[str]):
    """Null-safe equality of the columns (a null group is a group)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def shuffle_key(key_cols: list[str], seed: int) -> F.Column:
    """32 hexadecimal digits that place a row in the seeded shuffle: md5 of its key columns and the seed, with colons
    between (a null column is left out)."""
    return F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in key_cols), F.lit(str(seed))))


def seeded_rank(df: DataFrame, group_cols: list[str], key_cols: list[str], seed: int) -> DataFrame:
    """Add ``_rank`` (0-based) and ``_n``: each row's position in a seeded shuffle of its group, exactly.

    The shuffle order is (``shuffle_key``, key). No window sees a whole group, which could hold a third of all rows:
    rows are counted by (group, bucket), a bucket being the first bits of the shuffle key, and ranked inside their
    bucket only. A bucket's start is a prefix sum on two levels: buckets are summed to blocks, blocks are summed along
    their group, buckets along their block. With B buckets (ROWS_PER_BUCKET rows each, whatever the size) both of these
    windows have about the root of B rows: 16,384 each at 10^12 rows. Null groups are groups.
    Reproducible under any partitioning.
    """
    bits = min(40, max(2, (df.count() // ROWS_PER_BUCKET).bit_length()))
    first_bits = F.conv(F.substring("_h", 1, 10), 16, 10).cast("long")
    d = (df.withColumn("_h", shuffle_key(key_cols, seed)).withColumn("_b", F.shiftright(first_bits, 40 - bits)))
    counts = (d.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_block", F.shiftright("_b", bits // 2)))
    before = lambda *by, order: (
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    blocks = (counts.groupBy(*group_cols, "_block").agg(F.sum("_c").alias("_bc"))
              .withColumn("_offset", F.coalesce(F.sum("_bc").over(before(*group_cols, order="_block")), F.lit(0)))
              .withColumn("_n", F.sum("_bc").over(Window.partitionBy(*group_cols))).drop("_bc"))
    inside = counts.withColumn("_s", F.coalesce(F.sum("_c").over(before(*group_cols, "_block", order="_b")), F.lit(0)))
    starts = (inside.join(blocks, same_group(inside, blocks, group_cols) & (inside["_block"] == blocks["_block"]))
              .select(*(inside[c] for c in group_cols), inside["_b"], (inside["_s"] + blocks["_offset"]).alias("_start"),
                      blocks["_n"]))
    w_in = Window.partitionBy(*group_cols, "_b").orderBy("_h", *key_cols)
    return (d.join(starts, same_group(d, starts, group_cols) & (d["_b"] == starts["_b"]))
            .select(d["*"], starts["_start"], starts["_n"])
            .withColumn("_rank", F.col("_start") + F.row_number().over(w_in) - 1)
            .drop("_h", "_b", "_start"))


def fraction_split(rank: F.Column, n: F.Column, train_frac: float, val_frac: float,
                   min_train: int = 0) -> F.Column:
    """train = first max(min_train, floor(train_frac*n)); val up to floor(val_frac*n); test the rest.

    When the minimum pushes train past the validation cut, validation is empty (the train
    positions take precedence over test).
    """
    a = F.greatest(F.lit(min_train), F.floor(n * train_frac).cast("long"))
    b = F.floor(n * val_frac).cast("long")
    return F.when(rank < a, "train").when(rank < b, "val").otherwise("test")


def time_split(samples: DataFrame, *, train_max_year: int = TRAIN_MAX_YEAR, valid_year: int = VALID_YEAR,
               test_min_year: int | None = None, group: str | tuple[str, ...] = "Gender",
               fallback: tuple[float, float] = (0.8, 1.0), seed: int = SPLIT_SEED,
               key_cols: tuple[str, ...] = ("fam_key", "season_key")) -> DataFrame:
    """Add ``split`` (train / val / test / null) by sample year.

    A group (gender, or several columns; null is a group of its own) without any training row falls back to a seeded
    random split with exact sizes: the first floor(fallback[0] * n) rows of the shuffle are train, up to floor(fallback[1] * n)
    validation, the rest test (0.8 / 1.0 for the main model, 0.7 / 0.85 for the per-label one).

    Which groups fall back is looked up first (a job over the group and year columns). None, as usual: the split is a
    column of the samples, with no shuffle. Up to LISTED_GROUPS: they are named in a filter. More: they are joined.
    """
    cols = [group] if isinstance(group, str) else list(group)
    yr = F.col("SeasonYear")
    by_year = F.when(yr <= train_max_year, "train").when(yr == valid_year, "val")
    if test_min_year is not None:
        by_year = by_year.when(yr >= test_min_year, "test")
    bare = (samples.groupBy(*cols).agg(F.coalesce(F.max((yr <= train_max_year).cast("int")), F.lit(0)).alias("_t"))
            .filter(F.col("_t") == 0).select(*cols))
    listed = bare.limit(LISTED_GROUPS + 1).collect()
    if not listed:
        return samples.withColumn("split", by_year)
    if len(listed) <= LISTED_GROUPS:
        falls_back = F.lit(False)
        for row in listed:
            this = F.lit(True)
            for c in cols:
                this = this & F.col(c).eqNullSafe(F.lit(row[c]))
            falls_back = falls_back | this
        timed, random = samples.filter(~falls_back), samples.filter(falls_back)
    else:
        timed = samples.join(bare, same_group(samples, bare, cols), "left_anti")
        random = samples.join(bare, same_group(samples, bare, cols), "left_semi")
    ranked = seeded_rank(random, cols, list(key_cols), seed)
    random_split = fraction_split(F.col("_rank"), F.col("_n"), fallback[0], fallback[1])
    return timed.withColumn("split", by_year).unionByName(ranked.withColumn("split", random_split).drop("_rank", "_n"))


def task_split(samples: DataFrame, task_keys: list[str], *, min_train: int = MIN_TRAIN_PER_EVENT,
               train_max_year: int = TRAIN_MAX_YEAR, valid_year: int = VALID_YEAR, test_min_year: int = 2025,
               seed: int = SPLIT_SEED, key_cols: tuple[str, ...] = ("key", "season_key")) -> DataFrame:
    """Per-task split of the per-event models: by year (train / val / test); a task with fewer than
    ``min_train`` training rows is re-split at random (train = max(min_train, 70%), validation to
    85%, rest test) and dropped when that train would take every row."""
    yr = F.col("SeasonYear")
    by_year = (F.when(yr <= train_max_year, "train").when(yr == valid_year, "val")
               .when(yr >= test_min_year, "test"))
    tasks = samples.groupBy(*task_keys).agg(F.count_if(yr <= train_max_year).alias("_ntr"), F.count(F.lit(1)).alias("_all"))
    a = lambda n: F.greatest(F.lit(min_train), F.floor(n * 0.7).cast("long"))
    enough = tasks.filter(F.col("_ntr") >= min_train)
    thin = tasks.filter((F.col("_ntr") < min_train) & (a(F.col("_all")) < F.col("_all")))
    timed = samples.join(enough, same_group(samples, enough, task_keys), "left_semi")
    # Only rows of thin tasks are ranked.
    random = samples.join(thin, same_group(samples, thin, task_keys), "left_semi")
    ranked = seeded_rank(random, task_keys, list(key_cols), seed)
    random_split = fraction_split(F.col("_rank"), F.col("_n"), 0.7, 0.85, min_train)
    return timed.withColumn("split", by_year).unionByName(ranked.withColumn("split", random_split).drop("_rank", "_n"))


def allowed_events(samples: DataFrame, min_train: int = MIN_TRAIN_PER_EVENT,
                   group: str = "Gender") -> DataFrame:
    """(gender, event, n_train) for events with at least ``min_train`` training samples (HAVING)."""
    return (samples.groupBy(group, "event")
            .agg(F.count_if(F.col("split") == "train").alias("n_train"))
            .filter(F.col("n_train") >= min_train))


def event_ids(allowed: DataFrame, group: str = "Gender") -> DataFrame:
    """Dense event id by name order inside each gender (0-based)."""
    w = Window.partitionBy(group).orderBy("event")
    return allowed.select(group, "event", (F.row_number().over(w) - 1).alias("event_id"))


def inverse_z(z: F.Column | str, mu: F.Column | str, sd: F.Column | str) -> F.Column:
    """A standardised value (or a forecast of one) in its event's own unit."""
    z, mu, sd = (F.col(c) if isinstance(c, str) else c for c in (z, mu, sd))
    return z * sd + mu


def event_stats(samples: DataFrame, group: str = "Gender") -> DataFrame:
    """Per-event mean and population std of the target on training rows; (0, 1) if none; std < 1e-6 -> 1."""
    tr = F.col("split") == "train"
    st = samples.groupBy(group, "event").agg(
        F.avg(F.when(tr, F.col("y"))).alias("_mu"), F.stddev_pop(F.when(tr, F.col("y"))).alias("_sd"),
        F.count_if(tr).alias("_n"))
    mu = F.when(F.col("_n") > 0, F.col("_mu")).otherwise(F.lit(0.0))
    sd = F.when(F.col("_n") > 0, F.col("_sd")).otherwise(F.lit(1.0))
    sd = F.when(sd < 1e-6, F.lit(1.0)).otherwise(sd)
    return st.select(group, "event", mu.alias("mu"), sd.alias("sd"))


def training_set(samples: DataFrame, *, train_max_year: int = TRAIN_MAX_YEAR, valid_year: int = VALID_YEAR,
                 test_min_year: int | None = None, min_train: int = MIN_TRAIN_PER_EVENT,
                 group: str = "Gender", seed: int = SPLIT_SEED,
                 fallback: tuple[float, float] = (0.8, 1.0)) -> DataFrame:
    """Samples with split, kept only for allowed events, with event_id, mu, sd and z = (y - mu) / sd."""
    s = time_split(samples, train_max_year=train_max_year, valid_year=valid_year,
                   test_min_year=test_min_year, group=group, seed=seed, fallback=fallback)
    # One grouped pass gives the training count, mean and deviation of each event; allowed events, ids and
    # statistics all come from it, and one join brings them to the samples.
    tr = F.col("split") == "train"
    st = (s.groupBy(group, "event").agg(F.count_if(tr).alias("_n"), F.avg(F.when(tr, F.col("y"))).alias("_mu"),
                                        F.stddev_pop(F.when(tr, F.col("y"))).alias("_sd"))
          .filter(F.col("_n") >= min_train))
    mu = F.when(F.col("_n") > 0, F.col("_mu")).otherwise(F.lit(0.0))
    sd = F.when(F.col("_n") > 0, F.col("_sd")).otherwise(F.lit(1.0))
    w = Window.partitionBy(group).orderBy("event")
    st = st.select(group, "event", (F.row_number().over(w) - 1).alias("event_id"), mu.alias("mu"),
                   F.when(sd < 1e-6, F.lit(1.0)).otherwise(sd).alias("sd"))
    return s.join(st, [group, "event"]).withColumn("z", (F.col("y") - F.col("mu")) / F.col("sd"))


def task_counts(ts: DataFrame, keys: list[str]) -> DataFrame:
    """Train / validation / test counts per task."""
    return ts.groupBy(*keys).agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "val").alias("n_val"),
        F.count_if(F.col("split") == "test").alias("n_test"))
