"""Deduplication with bounded state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.operators.reduction import POSITION


SEEN = "_seen_at"


def dedupe_stream(
    df: DataFrame, keys: Sequence[str], window: str = "10 minutes", salts: int = 16
) -> DataFrame:
    """One row per null-safe key within the window; state is dropped behind the watermark.

    Time is when this query sees a row: the start of the micro-batch, which its
    checkpoint keeps, so a batch run again has the same. No row is ever late, however
    far behind its topic partition is: each is kept, or a row of its key was kept within
    the window before. A key is forgotten when the watermark, which trails the batches by
    the window, has passed the window after its kept row: after one to two windows.

    A first step keeps one row per key and salt, so that a key with a large part
    of the rows is worked on by many tasks; the second step then sees at most
    ``salts`` rows of it per window. ``salts=1`` leaves the first step out.
    """
    marked = df.withColumn(SEEN, F.current_timestamp()).withWatermark(SEEN, window)
    if salts > 1:
        salt = F.pmod(F.xxhash64(*POSITION), F.lit(salts))
        marked = (
            marked.withColumn("_salt", salt)
            .dropDuplicatesWithinWatermark([*keys, "_salt"])
            .drop("_salt")
        )
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop(SEEN)
