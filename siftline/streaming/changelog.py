"""A changelog topic kept as a table of current values."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftline.operators.changelog import latest_per_key
from siftline.session import folder_names, move_folder, remove_folder
from siftline.sinks.topics import write_topic

UPDATE_SCHEMA = "key string, value string, batch_id bigint"


def latest_values(changes: DataFrame) -> DataFrame:
    """Latest value per key of ``key, value, offset``; combined before the shuffle."""
    return changes.groupBy("key").agg(F.max_by("value", "offset").alias("value"))


def current_values(latest: DataFrame, contains: str) -> DataFrame:
    """``key, value``: values with the text in upper case, NULL for a key that is deleted or lost the text."""
    value = F.when(F.col("value").contains(contains), F.upper("value"))
    return latest.select("key", value.alias("value"))


def start_changelog(
    changes: DataFrame, path: str, checkpoint: str, contains: str = "value",
    trigger: dict | None = None, compact_every: int = 100,
) -> StreamingQuery:
    """Appends each batch's updates to ``path``; a NULL value deletes the key.

    A key whose latest value is NULL or no longer contains the text is deleted.
    A batch run again replaces its own folder, so a restart repeats no update.
    After every ``compact_every`` batches their updates become the table's base, so
    that a reader meets that many update folders at most.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        current_values(batch, contains).write.mode("overwrite").parquet(f"{path}/updates/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_changelog(batch.sparkSession, path, batch_id)

    return (
        latest_values(changes)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_changelog_topic(
    changes: DataFrame, topic: str, checkpoint: str, contains: str = "value",
    bootstrap_servers: str | None = None, path: str | None = None, acks: str = "1",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Sends each batch's updates to a topic: key and current value, a NULL value as tombstone.

    A key that is deleted, or whose latest value no longer contains the text, gets a
    tombstone, so a compacted topic forgets it. Rows with a NULL key are left out: they
    name no entry of a compacted topic. In files a batch run again replaces its own
    folder; a broker gets it a second time, which leaves the same current values.
    """
    if (bootstrap_servers is None) == (path is None):
        raise ValueError("a topic needs a broker or a path")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = current_values(batch, contains)
        if path is None:
            write_topic(rows, topic, bootstrap_servers, acks=acks)
        else:
            rows.write.mode("overwrite").parquet(f"{_topic_path(path, topic)}/batch_id={batch_id}")

    return (
        latest_values(changes.filter(F.col("key").isNotNull()))
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _topic_path(path: str, topic: str) -> str:
    return f"{path.rstrip('/')}/topic={topic}"


def read_changelog_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """``key, value, batch_id`` of a changelog topic kept in files, tombstones included."""
    folder = _topic_path(path, topic)
    if not folder_names(spark, folder):
        return spark.createDataFrame([], UPDATE_SCHEMA)
    return spark.read.schema(UPDATE_SCHEMA).parquet(folder)


def _numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    prefix = f"{column}="
    return sorted(int(n[len(prefix):]) for n in folder_names(spark, path) if n.startswith(prefix))


def _current(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The last base and the updates after it (up to a batch), one row per key."""
    bases = _numbers(spark, f"{path}/base", "upto")
    after = bases[-1] if bases else -1
    rows = spark.createDataFrame([], UPDATE_SCHEMA)
    if _numbers(spark, f"{path}/updates", "batch_id"):
        updates = spark.read.schema(UPDATE_SCHEMA).parquet(f"{path}/updates").filter(F.col("batch_id") > after)
        rows = updates if upto is None else updates.filter(F.col("batch_id") <= upto)
    if bases:
        base = spark.read.schema("key string, value string").parquet(f"{path}/base/upto={after}")
        rows = rows.unionByName(base.withColumn("batch_id", F.lit(after).cast("bigint")))
    return latest_per_key(rows, ("key",), ("batch_id",)).filter(F.col("value").isNotNull()).select("key", "value")


def compact_changelog(spark: SparkSession, path: str, upto: int) -> None:
    """Makes the rows after batch ``upto`` the base and removes what it replaces.

    The new base is whole before anything goes, so a failure leaves a right table.
    Readers that began before may have to begin again.
    """
    if upto in _numbers(spark, f"{path}/base", "upto"):
        return
    building = f"{path}/building-{uuid.uuid4().hex}"
    _current(spark, path, upto).write.parquet(building)
    move_folder(spark, building, f"{path}/base/upto={upto}")
    for batch in _numbers(spark, f"{path}/updates", "batch_id"):
        if batch <= upto:
            remove_folder(spark, f"{path}/updates/batch_id={batch}")
    for base in _numbers(spark, f"{path}/base", "upto"):
        if base < upto:
            remove_folder(spark, f"{path}/base/upto={base}")


def read_changelog_table(spark: SparkSession, path: str) -> DataFrame:
    """Current rows: the last update per key, without the deleted keys."""
    return _current(spark, path)
