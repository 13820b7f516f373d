"""Connected components of large sparse graphs, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.session import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) can reach.

    Large-star and small-star rounds: every edge is hung on the smallest neighbour of one
    of its ends, until all hang on the smallest of their component. Smallest neighbours are
    found by aggregation, so a node with many edges never meets them in one task. Each
    round is written to the shared folder, which cuts the lineage.
    """
    star = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-edges",
    )
    before = None
    while True:
        both = star.unionAll(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), f"{name}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        star = written(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .unionAll(least.select("a", F.col("m").alias("b"))).distinct(),
            f"{name}-small",
        )
        now = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    hung = star.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return hung.unionAll(hung.select("component", "component").distinct().toDF("node", "component"))
