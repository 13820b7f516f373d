"""Firewall lines: header first, then one detailed pattern per event type.

Debug lines (severity 7) keep their text. Other lines get the event type their
text selects and that type's columns; a text no type selects keeps the header
alone and is no reject.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.captures import (
    captures,
    complete,
    computed_once,
    found,
    searched,
    slot,
)
from siftline.operators.decoding import NOT_UTF8, decoded, with_bookkeeping

NO_HEADER = "no_header"
NO_DETAIL = "no_detail"


def _event_type(text: Column) -> Column:
    first, *others = V.CISCO_EVENTS
    start = F.when(found(text, first[1]), first[0])
    return reduce(lambda chain, e: chain.when(found(text, e[1]), e[0]), others, start)


def _detail(text: Column, event_type: Column) -> Column:
    """Captures of the selected type's pattern, laid out as the common detail columns."""
    chain = F
    for name, _, pattern, fields in V.CISCO_EVENTS:
        slots = [
            fields.index(f) + 1 if f in fields else None for f in V.CISCO_DETAIL_FIELDS
        ]
        chain = chain.when(event_type == name, captures(text, pattern, slots, pattern.split(" ")[0]))
    return chain


def parse_cisco(raw: DataFrame) -> DataFrame:
    message, header, detail = F.col("message"), F.col("header"), F.col("detail")
    severity, event_type = F.col("severity"), F.col("event_type")
    severity_number = severity.try_cast("bigint")
    has_header = complete(header, 3) & severity_number.isNotNull()
    debug = severity_number == V.CISCO_DEBUG_SEVERITY
    width = len(V.CISCO_DETAIL_FIELDS)

    df = (
        decoded(raw, V.CISCO_LOG)
        .withColumn(
            "header",
            computed_once(captures(message, V.CISCO_HEADER_PATTERN, (1, 2, 3), V.CISCO_LITERAL)),
        )
        # severity comes from its own, looser search: it may match earlier in the line
        .withColumn(
            "severity",
            F.when(
                message.contains(V.CISCO_LITERAL),
                F.regexp_extract(message, searched(V.CISCO_SEVERITY_PATTERN), 1),
            ),
        )
        .withColumn(
            "event_type",
            computed_once(F.when(has_header & ~debug, _event_type(slot(header, 2)))),
        )
        .withColumn("detail", computed_once(_detail(slot(header, 2), event_type)))
    )
    reject = (
        F.when(message.isNull(), NOT_UTF8)
        .when(~has_header, NO_HEADER)
        .when(event_type.isNotNull() & ~complete(detail, width), NO_DETAIL)
    )
    df = df.withColumn("reject", computed_once(reject))
    kept = F.col("reject").isNull()
    return with_bookkeeping(
        df,
        [
            "message",
            F.when(kept, severity).alias("severity"),
            F.when(kept, slot(header, 1)).alias("message_id"),
            F.when(kept & debug, slot(header, 2)).alias("message_text"),
            F.when(kept, event_type).alias("event_type"),
        ]
        + [
            F.when(kept, F.nullif(slot(detail, i), F.lit(""))).alias(f)
            for i, f in enumerate(V.CISCO_DETAIL_FIELDS)
        ],
        F.col("reject"),
    )
