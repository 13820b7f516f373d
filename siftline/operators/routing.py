"""Exclusive routing: ordered predicates, the first that holds names the route."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.captures import computed_once
from siftline.functions.letters import upper_letters

SAMPLE, DANGEROUS, DEDUPE = "sample", "dangerous", "dedupe"
REJECT = "reject"
ROUTES = (SAMPLE, DANGEROUS, DEDUPE)


def exclusive_route(routes: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first route whose predicate is true; a NULL predicate does not match."""
    (first, condition), *others = routes
    return reduce(lambda chain, r: chain.when(r[1], r[0]), others, F.when(condition, first))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def shortest_words(words: Sequence[str]) -> list[str]:
    """The words that contain no other word of the list; enough for a substring test."""
    return [w for w in words if not any(o != w and o in w for o in words)]


def access_routes() -> list[tuple[str, Column]]:
    status = F.col("status").try_cast("bigint")
    return [
        (SAMPLE, contains_any(F.col("url"), shortest_words(V.STATIC_EXTENSIONS))),
        # a status that is no number fails the whole test
        (
            DANGEROUS,
            status.isNotNull()
            & (
                contains_any(F.col("method"), V.WRITE_METHODS)
                | (status >= V.FIRST_FAILING_STATUS)
            ),
        ),
        (DEDUPE, F.lit(True)),
    ]


def error_routes() -> list[tuple[str, Column]]:
    important = F.coalesce(F.col("level").isin(*V.IMPORTANT_LEVELS), F.lit(False))
    return [(SAMPLE, ~important), (DANGEROUS, F.lit(True)), (DEDUPE, F.lit(True))]


def cisco_routes() -> list[tuple[str, Column]]:
    return [
        (SAMPLE, F.col("severity").try_cast("bigint") == V.CISCO_DEBUG_SEVERITY),
        (DANGEROUS, F.col("event_type").isin(*V.CISCO_DANGEROUS_EVENTS)),
        (DEDUPE, F.lit(True)),
    ]


def window_routes() -> list[tuple[str, Column]]:
    event_id = F.col("event_id").try_cast("bigint")
    return [
        (SAMPLE, event_id == V.WINDOW_LOGOFF_EVENT),
        (DANGEROUS, event_id.isin(*V.WINDOW_DANGEROUS_EVENTS)),
        (DEDUPE, F.lit(True)),
    ]


def with_route(df: DataFrame, routes: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds ``route``; a rejected row, where the table still holds them, goes to ``reject``."""
    route = exclusive_route(routes)
    if "reject_reason" in df.columns:
        route = F.when(F.col("reject_reason").isNotNull(), REJECT).otherwise(route)
    return df.withColumn("route", computed_once(route))


def only_log_type(df: DataFrame, log_type: str) -> DataFrame:
    """Rows for one log type's sink."""
    return df.filter(F.col("log_type") == log_type)


def matching_upper(df: DataFrame, column: str = "value", pattern: str = r".*\d+.*") -> DataFrame:
    """Rows whose whole text matches the pattern, with the text in upper case, letter by letter."""
    return df.filter(F.col(column).rlike(rf"\A(?:{pattern})\z")).withColumn(
        column, upper_letters(F.col(column))
    )
