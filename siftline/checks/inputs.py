"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.operators.enrichment import GeoLookup, ThreatLookup, prepare_geo, prepare_threat
from siftline.plans.catalog import LOG_TYPES
from siftline.render import THREAT_ADDRESSES, pick, rendered, text
from siftline.session import written

PIPELINE_TYPES = (V.ACCESS_LOG, V.ERROR_LOG, V.CISCO_LOG, V.WINDOW_LOG)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    """Rendered lines, read as the table lies."""
    return rendered(table(spark, sf_dir, "events"), log_type)


def staged(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    """Parsed and routed, in one plan; for queries with a single reader."""
    return LOG_TYPES[log_type].staged(raw(spark, sf_dir, log_type))


def parsed(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    return staged(spark, sf_dir, log_type).filter(F.col("reject_reason").isNull())


def staged_table(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    """Parsed and routed, written once, one folder per route."""
    return written(
        staged(spark, sf_dir, log_type), f"parsed-{log_type}", partition_by=("route",)
    )


def reduced(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    stage = staged_table(spark, sf_dir, log_type)
    return LOG_TYPES[log_type].reduced(stage)


# ---- lookups -----------------------------------------------------------------
SUPPLIER_ADDRESS = (
    f"{text('1 + s_suppkey % 223')} || '.' || {text('s_suppkey * 7 % 256')} || '.' || "
    f"{text('s_suppkey * 13 % 256')} || '.' || {text('1 + s_suppkey % 254')}"
)
# table, network, country, latitude, longitude; the networks nest and repeat
NETWORKS = (
    (
        "nation",
        f"{text('1 + n_nationkey * 9')} || '.0.0.0/8'",
        "n_name",
        "CAST(n_nationkey AS DOUBLE) + 0.5",
        "CAST(0 - n_nationkey AS DOUBLE)",
    ),
    (
        "supplier",
        f"{text('1 + s_nationkey * 9')} || '.' || {text('s_suppkey * 7 % 256')} || '.0.0/' || "
        f"{text('9 + s_suppkey % 8')}",
        f"'S' || {text('s_suppkey')}",
        "CAST(s_suppkey % 90 AS DOUBLE) + 0.25",
        "CAST(s_suppkey % 180 AS DOUBLE)",
    ),
    (
        "customer",
        f"{text('1 + c_nationkey * 9')} || '.' || {text('c_custkey * 7 % 256')} || '.' || "
        f"{text('c_custkey * 13 % 256')} || '.' || {text('c_custkey % 256')} || '/' || "
        f"{text('17 + c_custkey % 16')}",
        f"CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'C' || {text('c_custkey')} END",
        "CAST(c_custkey % 90 AS DOUBLE) + 0.75",
        "CAST(c_custkey % 180 AS DOUBLE)",
    ),
    # the ranges the listed addresses are in
    (
        "region",
        pick("192.0.2.0/24|198.51.100.0/24|203.0.113.0/24|192.0.2.128/25|198.51.100.64/26", "r_regionkey"),
        "r_name",
        "CAST(r_regionkey AS DOUBLE)",
        "CAST(r_regionkey AS DOUBLE) + 0.5",
    ),
)


def threat_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed addresses, every one of them twice."""
    listed = spark.range(1).select(
        F.explode(F.array(*[F.lit(a) for a in THREAT_ADDRESSES])).alias("ip")
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.expr(SUPPLIER_ADDRESS).alias("ip"))
    once = listed.unionByName(suppliers)
    return once.unionByName(once)


def geo_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        table(spark, sf_dir, name).selectExpr(
            f"{network} AS network", f"{country} AS country",
            f"{latitude} AS latitude", f"{longitude} AS longitude",
        )
        for name, network, country, latitude, longitude in NETWORKS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_prepared: dict[tuple, tuple[ThreatLookup, GeoLookup]] = {}


def lookups(spark: SparkSession, sf_dir: str) -> tuple[ThreatLookup, GeoLookup]:
    """Both lookups, prepared once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _prepared:
        _prepared[key] = (
            prepare_threat(threat_list(spark, sf_dir)),
            prepare_geo(geo_networks(spark, sf_dir)),
        )
    return _prepared[key]
