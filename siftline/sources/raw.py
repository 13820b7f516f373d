"""Raw topics, from the broker or from files that hold the same columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_SCHEMA = (
    "value binary, key binary, topic string, partition int, offset bigint,"
    "timestamp timestamp, headers array<struct<key:string,value:binary>>"
)
RAW_COLUMNS = ("value", "key", "topic", "partition", "offset", "timestamp", "headers")


def kafka_options(
    topics: Sequence[str],
    bootstrap_servers: str,
    stream: bool,
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
) -> dict[str, str]:
    """Reader options: all topics in one subscription, the first one naming the group.

    Positions live in the query's checkpoint; ``starting_offsets`` counts only on
    the first start. A limit per trigger keeps a backlog in bounded batches.
    """
    if not topics:
        raise ValueError("at least one topic is needed")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "groupIdPrefix": topics[0],
        "startingOffsets": starting_offsets,
        "includeHeaders": "true",
    }
    if stream:
        if max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    else:
        options["endingOffsets"] = ending_offsets
    return options


def read_topics(
    spark: SparkSession, topics: Sequence[str], bootstrap_servers: str,
    stream: bool = False, **limits,
) -> DataFrame:
    options = kafka_options(topics, bootstrap_servers, stream, **limits)
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load().select(*RAW_COLUMNS)


def read_files(
    spark: SparkSession, path: str, topics: Sequence[str] = (),
    stream: bool = False, max_files_per_trigger: int | None = None,
    offsets: tuple[int, int] | None = None,
) -> DataFrame:
    """Parquet files with the raw columns, all topics or the named ones.

    ``offsets`` bounds them in each partition: the first, and the one after the last.
    """
    if stream:
        reader = spark.readStream.schema(RAW_SCHEMA)
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read.schema(RAW_SCHEMA)
    raw = reader.parquet(path)
    if offsets is not None:
        raw = raw.filter((F.col("offset") >= offsets[0]) & (F.col("offset") < offsets[1]))
    return raw.filter(F.col("topic").isin(*topics)) if topics else raw


def from_topic_json(raw: DataFrame, schema: str) -> DataFrame:
    """Events another job put on a topic as JSON, typed by ``schema``."""
    event = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(event.alias("event")).select("event.*")
