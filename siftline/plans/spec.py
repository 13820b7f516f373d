"""Run specifications: inputs, enrichment switches and sinks, checked on reading."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from siftline import fixed_values as V
from siftline.plans.catalog import log_type_named
from siftline.sinks.object_store import split_prefix


@dataclass(frozen=True)
class SinkSpec:
    id: str
    type: str
    endpoint: str | None = None
    index: str | None = None
    bucket: str | None = None
    key_prefix: str | None = None
    region: str | None = None
    auth: Mapping[str, str] = field(default_factory=dict, repr=False)


@dataclass(frozen=True)
class InputSpec:
    id: str
    log_type: str
    enrich_geoip: bool
    enrich_threatip: bool
    sinks: tuple[SinkSpec, ...]


@dataclass(frozen=True)
class RunSpec:
    id: str
    inputs: tuple[InputSpec, ...]


def _required(config: Mapping[str, Any], name: str, where: str) -> Any:
    value = config.get(name)
    if value in (None, ""):
        raise ValueError(f"{where}: {name} is required")
    return value


def _flag(config: Mapping[str, Any], name: str, where: str) -> bool:
    value = config.get(name, False)
    if not isinstance(value, bool):
        raise ValueError(f"{where}: {name} must be true or false")
    return value


def _sink(config: Mapping[str, Any], log_type: str, where: str) -> SinkSpec:
    kind = _required(config, "type", where)
    if kind not in V.SINK_TYPES:
        raise ValueError(f"{where}: unknown sink type {kind!r}")
    name = str(config.get("id", kind))
    where = f"{where}, sink {name}"
    inner = config.get("config", {})
    if kind == "elasticsearch":
        return SinkSpec(
            name, kind, endpoint=_required(inner, "endpoint", where),
            index=inner.get("index") or log_type,
        )
    if kind == "clickhouse":
        return SinkSpec(name, kind, endpoint=_required(inner, "endpoint", where))
    auth = inner.get("auth", {})
    prefix = inner.get("key_prefix") or V.DEFAULT_KEY_PREFIX.format(log_type=log_type)
    split_prefix(prefix)
    return SinkSpec(
        name, kind,
        endpoint=_required(inner, "endpoint", where),
        bucket=inner.get("bucket") or V.DEFAULT_BUCKET,
        key_prefix=prefix,
        region=_required(inner, "region", where),
        auth={k: _required(auth, k, where) for k in ("access_key_id", "secret_access_key")},
    )


def read_spec(config: Mapping[str, Any]) -> RunSpec:
    """Reads and checks a specification; the request envelope around it may be left off."""
    full = config.get("fullPipelineConfig", config)
    inputs = []
    for i, item in enumerate(full.get("inputs", [])):
        name = str(item.get("id", f"input-{i + 1}"))
        where = f"input {name}"
        sinks = item.get("sinks", [])
        log_type = log_type_named(_required(item, "log_type", where)).name
        inputs.append(InputSpec(
            name,
            log_type,
            _flag(item, "enrich_geoip", where),
            _flag(item, "enrich_threatip", where),
            tuple(_sink(s, log_type, where) for s in sinks),
        ))
        if len({s.id for s in inputs[-1].sinks}) != len(sinks):
            raise ValueError(f"{where}: sink ids must differ; a sink without one is named by its type")
    if not inputs:
        raise ValueError("at least one input is required")
    if len({i.id for i in inputs}) != len(inputs):
        raise ValueError("input ids must differ")
    return RunSpec(str(full.get("id", "run")), tuple(inputs))
