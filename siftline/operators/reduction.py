"""Sampling, deduplication and the fan-in of the three routes (batch)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.operators.routing import DEDUPE, REJECT, SAMPLE

POSITION = ("topic", "partition", "offset")
ARRIVAL = ("ingest_time", "topic", "partition", "offset")


def sampled(key: Column, ratio: float = V.SAMPLE_RATIO) -> Column:
    """Whether the row with this key is in the sample.

    The first 32 bits of the key's MD5, as a fraction, are below the ratio; on
    fixed-width hex text that is a string comparison. The same rows are kept in
    batch, in a stream and on a retry.
    """
    if not 0.0 <= ratio <= 1.0:
        raise ValueError(f"ratio must be in [0, 1], got {ratio}")
    bound = math.ceil(ratio * 2**32)
    if bound >= 2**32:
        return F.lit(True)
    return F.substring(F.md5(key.cast("binary")), 1, 8) < F.lit(f"{bound:08x}")


def position_key() -> Column:
    """The row's place in its topic: the sampling key."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in POSITION])


def hash_sample(df: DataFrame, ratio: float = V.SAMPLE_RATIO, key: Column | None = None) -> DataFrame:
    return df.filter(sampled(position_key() if key is None else key, ratio))


def dedupe_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """First row per key in a total order; NULL keys are equal.

    The rank limit is applied before the shuffle too, so a key holding a large
    part of the rows sends one row per map task.
    """
    rank = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(rank))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedupe_gap(
    df: DataFrame,
    keys: Sequence[str],
    gap_seconds: int,
    time: str = "ingest_time",
    order: Sequence[str] = ARRIVAL,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Rows whose previous row of the same key is absent or more than the gap older.

    ``seen`` has the last times of keys before these rows, as ``remembered`` gives them: they
    count as rows of their keys.

    Two rows of a key in one gap-wide slice of time are never more than the gap
    apart, so only the first row of a slice can be kept. First and last time of
    each (key, slice) are aggregated before the shuffle; the look back then walks
    slices, of which even a hot key has few, not rows. The first rows themselves
    are found by rank, limited before the shuffle too.
    """
    if gap_seconds <= 0:
        raise ValueError("the gap must be positive")
    gap = F.lit(gap_seconds * 1_000_000)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    timed = df.withColumn("_at", at).withColumn("_slice", F.floor(at / gap))
    ends = timed.groupBy(*keys, "_slice").agg(F.min("_at").alias("_start"), F.max("_at").alias("_end"))
    walk = ["_slice"]
    if seen is not None:
        last = F.col(LAST)
        ends = ends.unionByName(seen.select(
            *keys, F.floor(last / gap).alias("_slice"), F.lit(None).cast("long").alias("_start"), last.alias("_end")))
        walk.append("_start")  # in one slice what was seen before comes first
    previous_end = F.lag("_end").over(Window.partitionBy(*keys).orderBy(*walk))
    kept = ends.withColumn("_previous_end", previous_end).filter(
        F.col("_start").isNotNull()
        & (F.col("_previous_end").isNull() | (F.col("_start") - F.col("_previous_end") > gap))
    ).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_of"))
    first = dedupe_first(timed, (*keys, "_slice"), order)
    same = F.col("_slice") == F.col("_of")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return first.join(kept, same, "left_semi").select(*df.columns)


LAST = "last_micros"


def remembered(
    df: DataFrame, keys: Sequence[str], gap_seconds: int, seen: DataFrame | None = None, time: str = "ingest_time"
) -> DataFrame:
    """(keys, last_micros): the last time of each key in ``df`` and in what was ``seen`` before.

    Keys whose last time lies more than the gap before the newest of all are forgotten: no row
    from then on can be near them. So the table is as large as the keys of one gap, not of the
    whole past. Times are aggregated before the shuffle.
    """
    last = df.groupBy(*keys).agg(F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias(LAST))
    if seen is not None:
        last = last.unionByName(seen).groupBy(*keys).agg(F.max(LAST).alias(LAST))
    newest = last.agg(F.max(LAST)).scalar()
    return last.filter(F.col(LAST) >= newest - gap_seconds * 1_000_000)


def reduce_events(
    routed: DataFrame,
    dedupe_keys: Sequence[str],
    ratio: float = V.SAMPLE_RATIO,
    gap_seconds: int | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Fan-in of the thinned sample, all dangerous rows and the deduplicated rest.

    ``seen``: what earlier runs remember of dedupe keys, for ``gap_seconds``.

    One narrow pass keeps the dangerous rows and the sample; only the dedupe
    rows shuffle. Give it a written table partitioned by ``route``, so that the
    two branches read disjoint files and nothing is parsed twice.
    """
    route = F.col("route")
    straight = routed.filter(
        (route != DEDUPE)
        & (route != REJECT)
        & ((route != SAMPLE) | sampled(position_key(), ratio))
    )
    repeated = routed.filter(route == DEDUPE)
    if gap_seconds is None:
        repeated = dedupe_first(repeated, dedupe_keys)
    else:
        repeated = dedupe_gap(repeated, dedupe_keys, gap_seconds, seen=seen)
    return straight.unionByName(repeated)
