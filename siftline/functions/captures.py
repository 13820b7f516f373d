"""Regex captures in one pass over the text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\x01"


def searched(pattern: str) -> str:
    """``pattern`` with Unicode classes and ``.`` stopping only at a line feed."""
    return f"(?dU-s:{pattern})"


def found(text: Column, pattern: str) -> Column:
    return text.rlike(searched(pattern))


def captures(
    text: Column, pattern: str, groups: Sequence[int | None], literal: str
) -> Column:
    """Array of the wanted groups of the first match, ``''`` for an absent one.

    ``groups`` names the group for each slot, None for a slot left empty. The
    array has ``len(groups)`` entries exactly when the pattern matched. One
    replacement pass writes all groups side by side and one split takes them
    apart. A text that holds the separator itself gets one of its own, longer by
    the text's digest: it starts with the only separator character in it, so it
    cannot run into a neighbouring group. ``literal`` is a text every match
    contains; where it is missing the pattern is not tried.
    """
    if len(groups) < 2:
        raise ValueError("two slots at least: the array size tells a match")
    whole = f"(?s)^.*?{searched(pattern)}.*$"
    usual = SEPARATOR.join("" if g is None else f"${g}" for g in groups)
    clashes = text.contains(SEPARATOR)
    own = F.concat(F.lit(SEPARATOR), F.sha2(text.cast("binary"), 256))
    replacement = F.when(clashes, F.replace(F.lit(usual), F.lit(SEPARATOR), own)).otherwise(usual)
    separator = F.when(clashes, own).otherwise(SEPARATOR)
    groups_apart = F.split(F.regexp_replace(text, F.lit(whole), replacement), separator, -1)
    return F.when(text.contains(literal), groups_apart)


def slot(captured: Column, index: int) -> Column:
    """One slot; NULL, not an error, where there was no match."""
    return F.get(captured, F.lit(index))


def complete(captured: Column, slots: int) -> Column:
    """Whether ``captures`` into that many slots found a match; never NULL."""
    return F.coalesce(F.size(captured) == slots, F.lit(False))


def computed_once(expression: Column) -> Column:
    """The expression as a generated column.

    Optimizer rules copy a projected expression into every filter that uses it;
    they do not move a filter below a generator. So a regex stays at one
    evaluation per row however many filters follow.
    """
    return F.explode(F.array(expression))


def with_computed_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Adds a generated column as ``computed_once`` does, the expression in a projection below.

    A generator interprets the expression it is given, a projection compiles it.
    """
    below = f"_{name}_below"
    return df.withColumn(below, expression).withColumn(name, computed_once(F.col(below))).drop(below)
