"""ST2: season peaks kept current as marks arrive.

A stateful streaming aggregation per (key, season) keeps min, max, count and, by ``min_by`` over the source
position, the first row's orientation and attributes: all order-free, so the result equals the batch result
whatever order marks arrive in. State is sized by the number of seasons, not marks. In update mode each
trigger emits only the seasons it changed; ``foreachBatch`` merges them into a versioned table.

The table is a list of bucket folders (hash of the key) that a numbered pointer names (``sources.versions``). A batch
writes its rows of a large bucket as one more folder beside it, where a season's newest row counts; a small bucket, or one
whose later folders have come to hold as many rows as its first, is read and written anew. So a row is written a bounded
number of times on average, however many batches come. Buckets that a batch doesn't touch stay as they are. Then the list
is published with the new folders put in: readers see the table before or after a batch, whole. The list also says which
batch of which stream it holds, so a batch that is replayed after its pointer is skipped, and one that died before it
starts over from the same table. Buckets double when they hold more than ROWS_PER_BUCKET rows on average.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import ORD, prepare_marks
from ..session import _fs, list_dirs
from ..sources import versions

KEYS = ["fam_key", "season_key"]
ATTRS = ("SeasonYear", "SeasonLabel", "Gender", "family")
#: Buckets of a new table, and rows that a bucket holds on average before their number is doubled.
BUCKETS, ROWS_PER_BUCKET = 16, 500_000
#: A bucket of fewer rows is always written anew; one of more folders than that as well.
SMALL_BUCKET, MAX_FOLDERS = 10_000, 64


def streaming_peak_state(marks: DataFrame) -> DataFrame:
    agg = marks.groupBy(*KEYS).agg(
        F.min("value").alias("_mn"), F.max("value").alias("_mx"), F.count(F.lit(1)).alias("n_marks"),
        F.min_by("is_time", F.col(ORD)).alias("is_time"),
        *[F.min_by(F.col(a), F.when(F.col(a).isNotNull(), F.col(ORD))).alias(a) for a in ATTRS])
    return agg.select(*KEYS, *ATTRS, "is_time", F.when(F.col("is_time"), F.col("_mn")).otherwise(F.col("_mx")).alias("peak_value"),
                      "n_marks")


def _table(spark: SparkSession, root: str, buckets: int) -> dict:
    """The newest list: number of buckets, folder and rows of each, last batch of each stream."""
    found = versions.newest(spark, root)
    return json.loads(found[1]) | {"version": found[0]} if found else {"buckets": buckets, "paths": {}, "rows": {}, "applied": {}, "version": 0}


def _folders(table: dict, bucket: str | int) -> list[str]:
    """A bucket's folders, oldest first (older lists name one folder as a text)."""
    found = table["paths"].get(str(bucket), [])
    return [found] if isinstance(found, str) else found


def _newest_rows(spark: SparkSession, buckets: list[list[str]], schema=None) -> DataFrame:
    """The rows of some buckets (lists of folders, oldest first): of each season that of the newest folder."""
    read = spark.read.schema(schema) if schema is not None else spark.read
    single, several = [b[0] for b in buckets if len(b) == 1], [b for b in buckets if len(b) > 1]
    parts = [read.parquet(*single)] if single else []
    if several:
        layers = [read.parquet(*(b[i] for b in several if i < len(b))).withColumn("_layer", F.lit(i)) for i in range(max(map(len, several)))]
        rows = reduce(DataFrame.unionByName, layers)
        row = F.struct(*[c for c in rows.columns if c != "_layer"])
        parts.append(rows.groupBy(*KEYS).agg(F.max_by(row, "_layer").alias("_row")).select("_row.*"))
    return reduce(DataFrame.unionByName, parts)


def merge_batch(root: str, buckets: int = BUCKETS, source: str = "stream", rows_per_bucket: int = ROWS_PER_BUCKET,
                before_publish: Callable[[], None] | None = None, small_bucket: int = SMALL_BUCKET):
    """foreachBatch function that merges changed seasons into the table at ``root``. ``source`` names the stream that
    batch numbers belong to; one writer at a time (a second one fails at its pointer). ``before_publish`` is called
    between writing and publishing (tests)."""

    def _merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        t = _table(spark, root, buckets)
        if t["applied"].get(source, -1) >= batch_id:
            return
        n, total = t["buckets"], sum(t["rows"].values())
        while total > n * rows_per_bucket:
            n *= 2
        of = lambda df, k: df.withColumn("bucket", F.pmod(F.xxhash64("fam_key"), F.lit(k)).cast("int"))

        def write(df: DataFrame) -> tuple[str, dict[str, int]]:
            """A folder with the rows by bucket, and how many of them each bucket has."""
            out = f"{root}/data/{batch_id}-{uuid.uuid4().hex}"
            of(df, n).repartition("bucket").write.partitionBy("bucket").parquet(out)
            if not any(d.startswith("bucket=") for d in list_dirs(spark, out)):
                return out, {}
            return out, {str(r["bucket"]): r["count"] for r in spark.read.schema("bucket int").parquet(out).groupBy("bucket").count().collect()}  # n at most

        # The batch's rows are written at once and read from there: each use of the batch itself would run the aggregation,
        # its state stores included, again (Spark doesn't find a persisted batch in a plan that names it twice).
        out, touched = write(batch)

        def grows(b: str) -> bool:
            """Whether the batch's rows become one more folder of the bucket."""
            later = t["rows"].get(b, 0) - t.get("first", t["rows"]).get(b, 0) + touched[b]
            return (n == t["buckets"] and small_bucket <= t["rows"].get(b, 0) and later < t.get("first", t["rows"]).get(b, 0)
                    and len(_folders(t, b)) < MAX_FOLDERS)

        added = {b for b in touched if grows(b)}
        # With more buckets than before, all of them are written anew.
        anew = sorted((b for b in (set(touched) - added if n == t["buckets"] else t["paths"]) if _folders(t, b)), key=int)
        rows, paths = dict(touched), {b: f"{out}/bucket={b}" for b in touched}
        if anew:
            all_rows = _newest_rows(spark, [_folders(t, b) for b in anew], batch.schema)
            fresh = [paths[b] for b in touched if b in anew or n != t["buckets"]]
            if fresh:
                new = spark.read.schema(batch.schema).parquet(*fresh)
                all_rows = all_rows.join(new.select(*KEYS), KEYS, "left_anti").unionByName(new)
            merged, counts = write(all_rows)
            rows, paths = rows | counts, paths | {b: f"{merged}/bucket={b}" for b in counts}
            for folder in fresh:  # now part of the buckets written anew, and named by no list
                fs, p = _fs(spark, folder)
                fs.delete(p, True)
        keep = {} if n != t["buckets"] else t["paths"]
        before, first = ({b: c for b, c in x.items() if b in keep} for x in (t["rows"], t.get("first", t["rows"])))
        table = {"buckets": n, "paths": keep | {b: [*(_folders(t, b) if b in added else []), paths[b]] for b in rows},
                 "rows": before | {b: c + (before[b] if b in added else 0) for b, c in rows.items()},
                 "first": first | {b: c for b, c in rows.items() if b not in added}, "applied": t["applied"] | {source: batch_id}}
        if before_publish is not None:
            before_publish()
        if not versions.point(spark, root, t["version"] + 1, json.dumps(table)):
            raise RuntimeError(f"another writer published version {t['version'] + 1} of {root}")
    return _merge


def read_peaks(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table's newest version, or an older one by its number."""
    t = json.loads(versions.read_pointer(spark, root, version)) if version else _table(spark, root, BUCKETS)
    if not t["paths"]:
        raise FileNotFoundError(f"no version under {root}")
    return _newest_rows(spark, [_folders(t, b) for b in sorted(t["paths"], key=int)])


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete bucket folders that none of the newest ``keep`` versions (one at least) names, and older pointers. Returns
    the number of deleted folders. Not while a batch is being merged: its folders are named only at its end."""
    numbers = versions.pointers(spark, root)
    lists = [json.loads(versions.read_pointer(spark, root, v)) for v in numbers[-max(keep, 1):]]
    live = {p for t in lists for b in t["paths"] for p in _folders(t, b)}
    fs, data = _fs(spark, f"{root}/data")
    deleted = 0
    for folder in (fs.listStatus(data) if numbers and fs.exists(data) else []):
        for bucket in fs.listStatus(folder.getPath()):
            name = f"{root}/data/{folder.getPath().getName()}/{bucket.getPath().getName()}"
            if bucket.isDirectory() and name not in live:
                deleted += bool(fs.delete(bucket.getPath(), True))
    for v in numbers[:-max(keep, 1)]:
        fs.delete(_fs(spark, f"{root}/versions/{v}")[1], False)
    return deleted


def state_partitions(spark: SparkSession) -> int:
    """State stores that a new peak stream deals its seasons out to: two for each core. Each batch writes files of its own for
    every store, however few seasons it changes, so Spark's usual number costs a small cluster more than the marks do."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(BUCKETS, 2 * spark.sparkContext.defaultParallelism))


def stream_peaks(spark: SparkSession, raw_dir: str, raw_schema: str, ordinal_cols: list[str], out_root: str,
                 checkpoint: str, files_per_trigger: int = 1):
    """Start the incremental peak query over raw mark files; returns the StreamingQuery (availableNow). A checkpoint keeps
    the number of state stores that it began with."""
    src = (spark.readStream.format("parquet").schema(raw_schema)
           .option("maxFilesPerTrigger", files_per_trigger).load(raw_dir))
    state = streaming_peak_state(prepare_marks(src, ordinal_cols))
    writer = (state.writeStream.outputMode("update").foreachBatch(merge_batch(out_root))
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    setting = "spark.sql.shuffle.partitions"  # the query takes a copy of the session's settings as it starts
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(state_partitions(spark)))
    try:
        return writer.start()
    finally:
        spark.conf.set(setting, before)
