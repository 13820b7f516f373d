"""Raw messages to text, and the split into typed rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V

BOOKKEEPING = ("ingest_time", *V.BROKER_METADATA, "reject_reason", "raw_value")

NOT_UTF8 = "not_utf8"
NO_MATCH = "no_match"


def decoded(raw: DataFrame, log_type: str) -> DataFrame:
    """UTF-8 text of each message (NULL for invalid bytes) beside the broker metadata."""
    return raw.select(
        F.lit(log_type).alias("log_type"),
        F.try_validate_utf8(F.col("value").cast("string")).alias("message"),
        F.col("timestamp").alias("ingest_time"),
        F.col("key").alias("message_key"),
        "offset",
        "partition",
        "topic",
        F.lit("kafka").alias("source_type"),
        "headers",
        F.col("value").alias("raw_value"),
    )


def with_bookkeeping(df: DataFrame, fields: list[Column], reject_reason: Column) -> DataFrame:
    """Typed columns, then ingest time, metadata, reject reason and the rejected bytes.

    A rejected row keeps its bytes; an accepted one does not carry them twice.
    """
    return df.select(
        "log_type",
        *fields,
        "ingest_time",
        *V.BROKER_METADATA,
        reject_reason.alias("reject_reason"),
        F.when(reject_reason.isNotNull(), F.col("raw_value")).alias("raw_value"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows that parsed, without the reject columns."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_value")


def rejects(parsed: DataFrame) -> DataFrame:
    """The reject table: every row that did not parse, with its bytes, reason and position."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "log_type",
        F.col("raw_value").alias("value"),
        F.col("reject_reason").alias("reason"),
        "topic",
        "partition",
        "offset",
        "ingest_time",
    )
