"""Threat list and geographic networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GEO_SCHEMA = "network string, country string, latitude double, longitude double"


def read_threat_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV list with a header row and a column ``ip``."""
    return spark.read.option("header", True).csv(path).select("ip")


def read_geo_networks(spark: SparkSession, path: str) -> DataFrame:
    """Networks as CIDR text with country and position; CSV with header, or Parquet."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return spark.read.schema(GEO_SCHEMA).option("header", True).csv(path)
    return spark.read.schema(GEO_SCHEMA).parquet(path)
