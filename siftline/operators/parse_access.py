"""Web access lines to nine text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.captures import captures, complete, computed_once, slot
from siftline.operators.decoding import NO_MATCH, NOT_UTF8, decoded, with_bookkeeping


def parse_access(raw: DataFrame) -> DataFrame:
    width = len(V.ACCESS_FIELDS)
    df = decoded(raw, V.ACCESS_LOG).withColumn(
        "line", computed_once(captures(F.col("message"), V.ACCESS_PATTERN, range(1, width + 1), V.ACCESS_LITERAL))
    )
    line = F.col("line")
    matched = complete(line, width)
    return with_bookkeeping(
        df,
        ["message"]
        + [F.when(matched, slot(line, i)).alias(f) for i, f in enumerate(V.ACCESS_FIELDS)],
        F.when(F.col("message").isNull(), NOT_UTF8).when(~matched, NO_MATCH),
    )
