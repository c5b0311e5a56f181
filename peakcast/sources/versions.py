"""Published versions: data is written first, under a name of its own, and then a numbered pointer to it.

A pointer is created with a call that fails if the file exists, so of two publishers of one number only one succeeds;
readers take the greatest number and see either the old or the new version, whole. A writer that dies before the
pointer leaves data that nothing points to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slug
from ..session import _fs


def pointers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, rising."""
    fs, p = _fs(spark, f"{root}/versions")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()) if fs.exists(p) else []


def newest(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(number, what it points to) of the newest version."""
    found = pointers(spark, root)
    return (found[-1], read_pointer(spark, root, found[-1])) if found else None


def read_pointer(spark: SparkSession, root: str, number: int) -> str:
    return spark.read.text(f"{root}/versions/{number}", wholetext=True).head()[0]


def point(spark: SparkSession, root: str, number: int, target: str) -> bool:
    """Publish ``target`` as version ``number``; False if that number is taken."""
    fs, p = _fs(spark, f"{root}/versions/{number}")
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/versions/.{number}-{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(target.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(tmp, p):  # a rename never replaces a file
        fs.delete(tmp, False)
        return False
    return True


def publish_models(models: DataFrame, root: str, unit: list[str]) -> int:
    """Store the models of all units as the next version; returns its number.

    A unit is known by the slugs of its key values, joined by ``__``. Units that share a slug would overwrite each other
    when looked up, so they are refused, before anything is published.
    """
    spark = models.sparkSession
    name = F.concat_ws("__", *(slug(F.col(c)) for c in unit))
    target = f"{root}/data/{uuid.uuid4().hex}"
    models.withColumn("unit", name).repartitionByRange("unit").sortWithinPartitions("unit").write.parquet(target)
    stored = spark.read.parquet(target)
    clash = stored.select("unit", *unit).distinct().groupBy("unit").count().filter("count > 1").head(1)
    if clash:
        raise ValueError(f"several units are stored as {clash[0]['unit']!r}")
    number = (pointers(spark, root) or [0])[-1] + 1
    while not point(spark, root, number, target):
        number += 1
    return number


def load_models(spark: SparkSession, root: str, version: int | None = None, units: list[str] | None = None) -> DataFrame:
    """The models of a version (the newest by default), all of them or those of the named units: rows are sorted by
    unit, so a look-up reads only the row groups that may hold it."""
    if version is None:
        found = newest(spark, root)
        if found is None:
            raise FileNotFoundError(f"no version under {root}")
        version = found[0]
    models = spark.read.parquet(read_pointer(spark, root, version))
    return models if units is None else models.filter(F.col("unit").isin(*units))
