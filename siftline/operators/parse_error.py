"""Web error lines: the line first, then the action, path and errno inside its message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.captures import captures, complete, computed_once, slot
from siftline.operators.decoding import NO_MATCH, NOT_UTF8, decoded, with_bookkeeping

NO_DETAIL = "no_detail"


def parse_error(raw: DataFrame) -> DataFrame:
    outer, inner = len(V.ERROR_FIELDS), len(V.ERROR_DETAIL_FIELDS)
    line, detail = F.col("line"), F.col("detail")
    line_matched = complete(line, outer)
    inner_text = F.when(line_matched, slot(line, V.ERROR_FIELDS.index("error_message")))
    df = (
        decoded(raw, V.ERROR_LOG)
        .withColumn(
            "line",
            computed_once(captures(F.col("message"), V.ERROR_PATTERN, range(1, outer + 1), V.ERROR_LITERAL)),
        )
        .withColumn(
            "detail",
            computed_once(captures(
                    inner_text, V.ERROR_DETAIL_PATTERN, range(1, inner + 1), V.ERROR_DETAIL_LITERAL
                )),
        )
    )
    matched = line_matched & complete(detail, inner)
    return with_bookkeeping(
        df,
        ["message"]
        + [F.when(matched, slot(line, i)).alias(f) for i, f in enumerate(V.ERROR_FIELDS)]
        + [F.when(matched, slot(detail, i)).alias(f) for i, f in enumerate(V.ERROR_DETAIL_FIELDS)],
        F.when(F.col("message").isNull(), NOT_UTF8)
        .when(~line_matched, NO_MATCH)
        .when(~matched, NO_DETAIL),
    )
