"""A keyed changelog as a table: the latest value per key; NULL deletes the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    changes: DataFrame, keys: Sequence[str] = ("key",), order: Sequence[str] = ("offset",)
) -> DataFrame:
    """Last row per key; the rank limit is applied before the shuffle."""
    rank = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        changes.withColumn("_rank", F.row_number().over(rank))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def changelog_table(
    changes: DataFrame, contains: str = "value", keys: Sequence[str] = ("key",),
    order: Sequence[str] = ("offset",),
) -> DataFrame:
    """Current values that contain the text, in upper case.

    The latest value is taken first: filtering first would bring back an older
    value of a key that has since been deleted or changed.
    """
    return (
        latest_per_key(changes, keys, order)
        .filter(F.col("value").contains(contains))
        .select(*keys, F.upper("value").alias("value"))
    )
