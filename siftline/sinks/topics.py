"""Rows onto a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def as_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON text in ``value``, with an optional text key."""
    key_column = F.lit(None) if key is None else F.col(key)
    return df.select(
        key_column.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def write_topic(
    rows: DataFrame, topic: str, bootstrap_servers: str | None = None,
    path: str | None = None, acks: str = "1", mode: str = "append",
) -> None:
    """Publishes ``key, value`` text rows; to files under ``path`` where there is no broker."""
    out = rows.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if bootstrap_servers is not None:
        (
            out.write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("kafka.acks", acks)
            .option("topic", topic)
            .save()
        )
    elif path is not None:
        out.write.mode(mode).parquet(f"{path.rstrip('/')}/topic={topic}")
    else:
        raise ValueError("a topic needs a broker or a path")


def start_topic(
    rows: DataFrame, topic: str, checkpoint: str, bootstrap_servers: str | None = None,
    path: str | None = None, acks: str = "1", trigger: dict | None = None,
) -> StreamingQuery:
    """The same for a stream of ``key, value`` text rows: each row once in files, at least once on a broker."""
    out = rows.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if bootstrap_servers is not None:
        writer = (
            out.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("kafka.acks", acks)
            .option("topic", topic)
        )
    elif path is not None:
        writer = out.withColumn("topic", F.lit(topic)).writeStream.format("parquet").partitionBy("topic").option("path", path)
    else:
        raise ValueError("a topic needs a broker or a path")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
