"""The streaming table at size: what batches write follows their own rows, not the table's."""
import json
import random
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from peakcast.operators.clean import prepare_marks
from peakcast.sources import versions
from peakcast.streaming import peaks

from .test_forecasters import batch, table
from .test_html_and_streams import RAW


def test_large_buckets_grow_by_what_a_batch_brings(spark, tmp_path):
    root = str(tmp_path / "t")
    merge = peaks.merge_batch(root, 2, small_bucket=50)
    want, rng = {f"a{i}": 0.0 for i in range(400)}, random.Random(3)
    merge(batch(spark, list(want), 0.0), 0)
    for i in range(1, 9):
        some = rng.sample(sorted(want), 20) + [f"b{i}"]
        merge(batch(spark, some, float(i)), i)
        want |= {x: float(i) for x in some}
        assert table(spark, root) == sorted(want.items())
    written = sum(pq.read_metadata(f).num_rows for f in Path(root, "data").rglob("*.parquet"))
    assert written <= 400 + 8 * 21  # whole buckets each time would be nine tables
    merge(batch(spark, [f"c{i}" for i in range(500)], 9.0), 9)  # as many as the first folders hold: written anew
    want |= {f"c{i}": 9.0 for i in range(500)}
    t = json.loads(versions.newest(spark, root)[1])
    assert table(spark, root) == sorted(want.items()) and all(len(p) == 1 for p in t["paths"].values())
    assert sum(t["rows"].values()) == sum(t["first"].values()) == len(want)
    assert peaks.vacuum(spark, root, keep=1) >= 1 and table(spark, root) == sorted(want.items())


def test_a_batch_is_evaluated_once(spark, tmp_path):
    """Each use of a stream's batch runs the aggregation and its state stores again."""
    for i, marks in enumerate((("11.10", "11.20", "11.30"), ("11.00", "11.40"))):
        rows = [(10 * i + j, "D", "S", "Men", "Outdoors", 2022, "100 Meters", f"A{j}", m, "", "M", "2022-05-01") for j, m in enumerate(marks)]
        spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    src = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = (peaks.streaming_peak_state(prepare_marks(src, ["pos"])).writeStream.outputMode("update").foreachBatch(peaks.merge_batch(f"{tmp_path}/out", 2))
             .option("checkpointLocation", f"{tmp_path}/chk").trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted((r["peak_value"], r["n_marks"]) for r in peaks.read_peaks(spark, f"{tmp_path}/out").collect()) == [(11.0, 2), (11.2, 2), (11.3, 1)]
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]] == [3, 2]


def test_state_stores_follow_the_cores(spark, tmp_path):
    raw = spark.createDataFrame([(0, "D", "S", "Men", "Outdoors", 2022, "100 Meters", "A", "11.10", "", "M", "2022-05-01")], RAW)
    raw.write.parquet(f"{tmp_path}/in")
    before, most = spark.conf.get("spark.sql.shuffle.partitions"), max(peaks.BUCKETS, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(most + 9))
    try:
        peaks.stream_peaks(spark, f"{tmp_path}/in", RAW, ["pos"], f"{tmp_path}/out", f"{tmp_path}/chk").awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(most + 9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len([p for p in Path(tmp_path, "chk", "state", "0").iterdir() if p.name.isdigit()]) == most
    assert [r["peak_value"] for r in peaks.read_peaks(spark, f"{tmp_path}/out").collect()] == [11.1]
