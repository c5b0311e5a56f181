"""Composed plans over the driver tables: raw marks -> prepared -> seasons -> samples -> training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import prepare_marks
from ..operators.seasons import season_aggregate
from ..operators.sequences import season_sequences
from ..operators.training import training_set
from ..operators.windows import history_windows
from ..sources.fixture import ORDINAL_COLS, ORDINAL_DIGITS, raw_marks

SEQLEN = 32
K_SEASONS = 4


#: Writer options for tables of whole pages. A reader takes up to 4,096 rows of a row group at a time, and the usual row
#: group of 128 MB compressed is a gigabyte or more of repetitive markup: so a group has 64 pages and 8 MB compressed at most.
PAGE_FILES = {"parquet.block.row.count.limit": "64", "parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "10",
              "parquet.page.size.row.check.min": "10"}


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder and read it back.

    Used where one input feeds several branches of a plan: the branches then scan the
    table (with column pruning) instead of each recomputing the upstream, and the lineage
    is cut, so a lost executor never forces the upstream parse to run again.
    """
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.parquet(path)


def prepared(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    kw.setdefault("ordinal_digits", ORDINAL_DIGITS)
    return prepare_marks(raw_marks(spark, sf_dir), ORDINAL_COLS, **kw)


def build_seasons(marks: DataFrame, key: str = "fam_key", seqlen: int = SEQLEN,
                  with_seq: bool = True, materialize_marks: bool = True) -> DataFrame:
    """Season table: peak, orientation, attributes, length, modal event and (optionally) the sequence.

    With sequences the marks feed two branches (aggregate, last-L window); they are then
    written once (``materialize_marks``) rather than computed twice.
    """
    if not with_seq:
        return season_aggregate(marks, key, seqlen=seqlen)
    if materialize_marks:
        marks = materialize(marks, "marks")
    agg = season_aggregate(marks, key, seqlen=seqlen)
    seq = season_sequences(marks, key, seqlen).drop("length")
    return agg.join(seq, [key, "season_key"], "left")


def samples(spark: SparkSession, sf_dir: str, k: int = K_SEASONS, with_seq: bool = True) -> DataFrame:
    return history_windows(build_seasons(prepared(spark, sf_dir), with_seq=with_seq), k=k, with_seq=with_seq)


def training(spark: SparkSession, sf_dir: str, k: int = K_SEASONS, with_seq: bool = False, **kw) -> DataFrame:
    """Training set; the samples table feeds four branches (split flags, allowed events, ids,
    statistics), so it is written once first."""
    return training_set(materialize(samples(spark, sf_dir, k=k, with_seq=with_seq), "samples"), **kw)


def date_str(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")
