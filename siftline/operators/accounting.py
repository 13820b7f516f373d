"""Counts of what came in, was rejected, kept and flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siftline.functions.times import utc_minute


def _minute(time: str) -> Column:
    return utc_minute(F.col(time).cast("timestamp")).alias("minute")


def reduction_stats(staged: DataFrame, kept: DataFrame) -> DataFrame:
    """Events in, rejected, kept and flagged per log type, route and minute of arrival.

    ``staged`` is the parsed table with routes and rejects, ``kept`` the reduced
    table, enriched or not. Each is aggregated on its own and the counts added,
    so no event is joined to another.
    """
    by = ("log_type", "route", _minute("ingest_time"))
    zero = F.lit(0).cast("bigint")
    flagged = F.count_if("threat_ip") if "threat_ip" in kept.columns else F.sum(zero)
    came = staged.groupBy(*by).agg(
        F.count("*").alias("events_in"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        F.sum(zero).alias("kept"),
        F.sum(zero).alias("threat_hits"),
    )
    went = kept.groupBy(*by).agg(
        F.sum(zero).alias("events_in"),
        F.sum(zero).alias("rejected"),
        F.count("*").alias("kept"),
        flagged.alias("threat_hits"),
    )
    return came.unionByName(went).groupBy("log_type", "route", "minute").agg(
        *[F.sum(m).alias(m) for m in ("events_in", "rejected", "kept", "threat_hits")]
    )


def received(raw: DataFrame) -> DataFrame:
    """Events and message bytes received per topic and minute."""
    return raw.groupBy("topic", _minute("timestamp")).agg(
        F.count("*").alias("events"),
        F.sum(F.octet_length("value")).alias("bytes"),
    )


def component_metric(metrics: DataFrame, component_type: str, name: str) -> DataFrame:
    """Metric rows of one component type and name; the type is nested under ``tags``."""
    return metrics.filter(
        (F.col("tags.component_type") == component_type) & (F.col("name") == name)
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table with its rows, and threat hits if it has the flag, counted as it is written."""
    seen = Observation(name)
    measures = [F.count(F.lit(1)).alias("events")]
    if "threat_ip" in df.columns:
        measures.append(F.count_if("threat_ip").alias("threat_hits"))
    return df.observe(seen, *measures), seen
