"""Streams: equal to batch, restartable, with bounded state."""

import random
import time

import pytest
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.plans.catalog import LOG_TYPES
from siftline.render import rendered
from siftline.session import folder_names
from siftline.sources.raw import read_files
from siftline.streaming.changelog import (
    read_changelog_table, read_changelog_topic, start_changelog, start_changelog_topic,
)
from siftline.streaming.dedupe import dedupe_stream
from siftline.streaming.jobs import ALL_NOW, FILES_A_BATCH, read_staged, start_parse, start_reduce

KEYED = "k string, topic string, partition int, offset long, ingest_time timestamp"


def drained(df, path, checkpoint):
    (
        df.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**ALL_NOW).start().awaitTermination()
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def test_stream_parse_equals_batch_and_resumes(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    t = LOG_TYPES[V.CISCO_LOG]
    raw = rendered(events, t.name)
    src, stage, check = (str(tmp_path / n) for n in ("raw", "stage", "check"))
    for part in (raw.filter("offset < 300"), raw.filter("offset >= 300")):
        part.write.mode("append").parquet(src)
        stream = read_files(spark, src, stream=True, max_files_per_trigger=1)
        start_parse(stream, t, stage, check, ALL_NOW).awaitTermination()
    got = spark.read.schema(t.staged(raw).schema).parquet(stage)
    want = t.staged(raw)
    columns = [c for c in want.columns if c != "headers"]
    assert got.count() == want.count()
    assert want.select(columns).exceptAll(got.select(columns)).count() == 0


def keyed(spark, data, path):
    df = spark.createDataFrame(
        [(k, "t", p, o, s) for k, p, o, s in data],
        "k string, topic string, partition int, offset long, s long",
    )
    df.withColumn("ingest_time", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode(
        "append"
    ).parquet(path)


@pytest.mark.parametrize("salts", [1, 8])
def test_dedupe_stream(spark, tmp_path, salts):
    """Inside the window one row per key, null keys too, however the arrival times jump."""
    src = str(tmp_path / "src")
    rng = random.Random(2)
    for batch in range(6):
        keyed(spark, [("hot" if rng.random() < 0.6 else rng.choice(["a", None, f"b{batch}"]), 0, 100 * batch + i,
                       rng.choice([10, 100_000, -50_000]) * batch) for i in range(60)], f"{src}/{batch:02d}")
        time.sleep(0.05)
    stream = (
        spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(src)
    )
    out = drained(
        dedupe_stream(stream, ["k"], "10 days", salts=salts), str(tmp_path / "out"), str(tmp_path / "check"),
    )
    assert out.columns == stream.columns
    kept = [r["k"] for r in out.collect()]
    assert sorted(kept, key=str) == sorted({"hot", "a", None, *(f"b{i}" for i in range(6))}, key=str)


def test_no_late_row_is_lost(spark, tmp_path):
    """A topic partition that lags by hours behind the others: its keys are kept all the same."""
    src = str(tmp_path / "src")
    rows = [("a", 0, 1, 20_000), ("b", 0, 2, 20_100), ("c", 1, 1, 9_000), ("d", 1, 2, 9_100), ("e", 0, 3, 20_200)]
    for i, row in enumerate(rows):
        keyed(spark, [row], f"{src}/{i}")
        time.sleep(0.05)
    stream = (
        spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(src)
    )
    out = drained(dedupe_stream(stream, ["k"], "1 second"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert sorted(r["k"] for r in out.collect()) == list("abcde")


def test_changelog_stream(spark, tmp_path):
    src, path, check = (str(tmp_path / n) for n in ("src", "table", "check"))
    schema = "key string, value string, offset long"
    data = [("a", "value1", 0), ("b", "other", 1), ("a", "nothing", 2), ("b", "value2", 3),
            ("c", "value3", 4), ("c", None, 5), ("d", "value4", 6)]
    seen = []
    for start in (0, 2, 4):
        spark.createDataFrame(data[start:start + (2 if start < 4 else 3)], schema).write.mode(
            "append"
        ).parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        start_changelog(stream, path, check, compact_every=2).awaitTermination()
        table = read_changelog_table(spark, path).collect()
        seen.append(sorted(tuple(r) for r in table))
    assert seen == [
        [("a", "VALUE1")], [("b", "VALUE2")], [("b", "VALUE2"), ("d", "VALUE4")],
    ]
    # two batches became the base, the third is an update to it
    assert folder_names(spark, f"{path}/base") == ["upto=1"]
    assert folder_names(spark, f"{path}/updates") == ["batch_id=2"]


def test_changelog_topic_has_tombstones(spark, tmp_path):
    """Deleted keys leave as NULL values; NULL keys don't leave; an older change that comes later changes nothing."""
    src, path, check = (str(tmp_path / n) for n in ("src", "topic", "check"))
    schema = "key string, value string, offset long"
    steps = [
        [("a", "value1", 0), ("b", "other", 1), (None, "value", 2)],
        [("a", None, 5), ("b", "value2", 6)],
        [("a", "value0", 4), ("c", "value3", 7), ("c", "value3", 7)],
    ]
    assert read_changelog_topic(spark, path, "t").count() == 0
    for rows in steps:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        start_changelog_topic(stream, "t", check, path=path).awaitTermination()
    sent = sorted((r["batch_id"], r["key"], r["value"]) for r in read_changelog_topic(spark, path, "t").collect()
                  if r["value"] is not None)
    gone = sorted((r["batch_id"], r["key"]) for r in read_changelog_topic(spark, path, "t").collect() if r["value"] is None)
    assert sent == [(0, "a", "VALUE1"), (1, "b", "VALUE2"), (2, "c", "VALUE3")]
    assert gone == [(0, "b"), (1, "a"), (2, "a")]


def test_changelog_topic_needs_one_place(spark):
    with pytest.raises(ValueError, match="broker or a path"):
        start_changelog_topic(spark.readStream.format("rate").load(), "t", "unused")


def test_reduced_batches_are_few_files(spark, tmp_path):
    """However many partitions the state has: each file is read as a part of a later batch."""
    t, work = LOG_TYPES[V.CISCO_LOG], str(tmp_path)
    rendered(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), t.name).repartition(6).write.parquet(f"{work}/raw")
    start_parse(
        read_files(spark, f"{work}/raw", stream=True), t, f"{work}/parsed/{t.name}", f"{work}/checkpoint", ALL_NOW,
    ).awaitTermination()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        start_reduce(spark, t, work, ALL_NOW, "36500 days").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    files = spark.read.parquet(f"{work}/reduced/{t.name}").inputFiles()
    assert 0 < len(files) <= FILES_A_BATCH


def test_state_has_a_partition_or_two_for_each_core(spark, tmp_path):
    """Each partition of the state commits in every batch, so the session's many are too many."""
    t = LOG_TYPES[V.CISCO_LOG]
    work = str(tmp_path)
    raw = rendered(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), t.name)
    t.staged(raw).write.partitionBy("route").parquet(f"{work}/parsed/{t.name}")
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        start_reduce(spark, t, work, ALL_NOW, "36500 days").awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "60"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    partitions = [n for n in folder_names(spark, f"{work}/checkpoints/reduce-{t.name}/state/0") if n.isdigit()]
    assert len(partitions) == max(24, 2 * spark.sparkContext.defaultParallelism)


def test_a_trigger_takes_files_of_every_route(spark, tmp_path):
    t, stage = LOG_TYPES[V.CISCO_LOG], str(tmp_path / "parsed")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rendered(events, t.name).repartition(4).write.parquet(f"{tmp_path}/raw")
    start_parse(
        read_files(spark, f"{tmp_path}/raw", stream=True), t, stage, f"{tmp_path}/checkpoint", ALL_NOW,
    ).awaitTermination()
    batches = []
    (
        read_staged(spark, stage, t, ("dedupe",), 4).writeStream
        .option("checkpointLocation", f"{tmp_path}/checkpoint-read").foreachBatch(lambda df, n: batches.append(n))
        .trigger(**ALL_NOW).start().awaitTermination()
    )
    assert len(batches) == 1
