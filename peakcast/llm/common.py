"""Shared helpers: folds, name-safe column picking, tables written under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id long, text) only: whatever other columns the table has, and however they are named, they
    cannot clash with the columns an operator adds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet under the session's shared checkpoint folder and read back: lineage is cut
    and a lost executor costs a re-read, not a re-computation."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast`` hint only when the table, already stored, is counted at no more than ``max_rows`` rows;
    beyond it the join is left to Spark (shuffled, AQE may split skewed partitions)."""
    return F.broadcast(df) if df.count() <= max_rows else df


#: Groups (languages, domains) that a model fitted on the driver may have.
MAX_GROUPS = 1000


def smallest_by_hash(df: DataFrame, group: str, key: str, limit: int, salts: int = 16) -> DataFrame:
    """(group, key): of each value of ``group``, the ``limit`` different keys of smallest hash, however often a key
    stands there. The limit is applied in each task, then in each of ``salts`` parts of a group, and only then to the
    group, so no task gets more than salts * limit rows."""
    h = F.xxhash64(key)
    first = W.partitionBy(group, "__salt").orderBy("__hash", key)
    last = W.partitionBy(group).orderBy("__hash", key)
    d = (df.select(group, key).distinct().withColumn("__hash", h)
         .withColumn("__salt", F.pmod(F.xxhash64(F.lit("salt"), key), F.lit(salts))))
    for w in (first, last):
        d = d.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= limit).drop("__rank")
    return d.drop("__hash", "__salt")


def one_text(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): one row for each key, with that of its texts whose hash is smallest (null only if it has no other), so
    that a bound on keys bounds rows as well."""
    return rows.groupBy(*keys).agg(F.min_by("text", F.when(F.col("text").isNotNull(), F.xxhash64("text"))).alias("text"))


def bounded_groups(df: DataFrame, group: str, most: int = MAX_GROUPS) -> DataFrame:
    """``df``, after a count: more than ``most`` values of ``group`` are an error, since the driver holds a row of the
    model for each."""
    n = df.select(group).distinct().limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} values of {group}: the model would not be bounded")
    return df
