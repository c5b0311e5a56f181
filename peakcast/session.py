"""Session helpers: building a local session for tests/bench and locating the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "peakcast") -> SparkSession:
    """Session with AQE on, UTC time zone and no UI. On a cluster, pass ``master=None``.

    Shuffle partitions and driver memory are left to Spark and the submit command unless asked for."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.codegen.hugeMethodLimit", os.environ.get("PEAKCAST_HUGE_METHOD_LIMIT", "8000"))
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("PEAKCAST_DRIVER_MEMORY"):
        b = b.config("spark.driver.memory", os.environ["PEAKCAST_DRIVER_MEMORY"])
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: The JVM never compiles methods of more bytes of code than this: it interprets them, several times slower.
COMPILED_BYTES = 8000


def compiled_plans(spark: SparkSession) -> SparkSession:
    """The session, told not to join so many steps into one generated method that the JVM would leave it uncompiled (a
    limit set lower stays)."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > COMPILED_BYTES:
        spark.conf.set(limit, str(COMPILED_BYTES))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where it is unset, a local session (one machine) gets
    a scratch folder; on a cluster that would be each machine's own disk, so it is an error."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="peakcast-ckpt-", dir="/tmp")  # kept by the context; the setting itself is static
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` on whatever file system holds it (local, HDFS, object store)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
