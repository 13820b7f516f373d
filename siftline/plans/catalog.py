"""What the jobs need to know about each log type."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from siftline import fixed_values as V
from siftline.operators.parse_access import parse_access
from siftline.operators.parse_cisco import parse_cisco
from siftline.operators.parse_error import parse_error
from siftline.operators.parse_windows import parse_windows
from siftline.operators.reduction import reduce_events
from siftline.operators.routing import (
    access_routes,
    cisco_routes,
    error_routes,
    window_routes,
    with_route,
)


@dataclass(frozen=True)
class LogType:
    name: str
    parse: Callable[[DataFrame], DataFrame]
    routes: Callable[[], list[tuple[str, Column]]]
    dedupe_keys: tuple[str, ...]

    def staged(self, raw: DataFrame) -> DataFrame:
        """Parsed rows and rejects with their route, in one narrow pass."""
        return with_route(self.parse(raw), self.routes())

    def reduced(
        self, staged: DataFrame, gap_seconds: int | None = None, seen: DataFrame | None = None
    ) -> DataFrame:
        kept = reduce_events(staged, self.dedupe_keys, gap_seconds=gap_seconds, seen=seen)
        return kept.drop("reject_reason", "raw_value")


def _entry(name: str, parse, routes) -> LogType:
    return LogType(name, parse, routes, V.DEDUPE_KEYS[name])


LOG_TYPES = {
    t.name: t
    for t in (
        _entry(V.ACCESS_LOG, parse_access, access_routes),
        _entry(V.ERROR_LOG, parse_error, error_routes),
        _entry(V.CISCO_LOG, parse_cisco, cisco_routes),
        _entry(V.WINDOW_LOG, parse_windows, window_routes),
    )
}


def log_type_named(name: str) -> LogType:
    """The log type a name stands for: ``Cisco Log`` and ``source_cisco_log_1`` are both cisco."""
    plain = name.strip().lower().replace(" ", "_")
    for key, log_type in LOG_TYPES.items():
        if key in plain:
            return log_type
    raise ValueError(f"unknown log type {name!r}; known: {', '.join(LOG_TYPES)}")
