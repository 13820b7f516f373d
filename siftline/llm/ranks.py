"""Row numbers inside groups of any size, without a group ever meeting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.session import written


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], rank: str, name: str) -> DataFrame:
    """``df`` with the column ``rank``: 0, 1, ... inside each group (nulls are a group), by ``order``.

    Rows are sorted over the whole table by range, so that a group may lie in many tasks,
    and written once. Only one count for each piece of a group in a task is then put in
    order. Rows that tie in ``order`` get neighbouring ranks in the order they are read in.
    """
    tie, at = f"{rank}_tie", f"{rank}_at"
    keys = [*group, *order, tie]
    placed = written(
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(at, F.monotonically_increasing_id())
        .drop(tie), name,
    )
    part = F.shiftright(at, 33)
    pieces = placed.groupBy(*group, part.alias("piece")).agg(
        F.min(at).alias("first_at"), F.count("*").alias("n")
    )
    before = Window.partitionBy(*group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        *[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], "piece", "first_at",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"),
    )
    same = part == F.col("piece")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"g{i}"))
    return placed.join(starts, same).select(
        *df.columns, (F.col(at) - F.col("first_at") + F.col("ranks_before")).alias(rank)
    )
