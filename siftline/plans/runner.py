"""The batch job of a run specification: raw, parsed, reduced, enriched, written."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.operators.accounting import observed, reduction_stats
from siftline.operators.decoding import rejects
from siftline.operators.enrichment import (
    GeoLookup,
    ThreatLookup,
    broadcastable,
    enrich,
)
from siftline.operators.routing import only_log_type
from siftline.operators.shaping import with_event_time
from siftline.plans.catalog import LOG_TYPES
from siftline.plans.ledger import Ledger
from siftline.plans.spec import InputSpec, RunSpec, SinkSpec
from siftline.session import JOBS_AT_ONCE, Stages
from siftline.sinks.object_store import object_folder, write_object_store
from siftline.sinks.runs import Run, of_run
from siftline.sinks.tables import index_name, store_options, write_index, write_olap


@dataclass(frozen=True)
class SinkResult:
    input_id: str
    sink_id: str
    type: str
    path: str
    events: int


@dataclass
class RunResult:
    """What a run wrote, and its stages; ``close`` removes exactly the stages.

    ``rejects`` reads the output. ``staged``, ``enriched`` and ``stats`` read the stages,
    so use them before closing; or use the result in a ``with`` statement.
    """

    stages: Stages
    sinks: list[SinkResult] = field(default_factory=list)
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    staged: dict[str, DataFrame] = field(default_factory=dict)
    enriched: dict[str, DataFrame] = field(default_factory=dict)

    def stats(self, input_id: str, log_type: str) -> DataFrame:
        return reduction_stats(self.staged[log_type], self.enriched[input_id])

    def close(self) -> None:
        self.stages.close()

    def __enter__(self) -> RunResult:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def rejects_path(out_dir: str, log_type: str) -> str:
    return f"{out_dir.rstrip('/')}/rejects/log_type={log_type}"


def write_rejects(staged: DataFrame, out_dir: str, log_type: str, run: Run) -> DataFrame:
    """The rows that did not parse, beside those of other runs; returns this run's."""
    writer, folders = of_run(rejects(staged).drop("log_type"), [], run, "overwrite")
    path = rejects_path(out_dir, log_type)
    writer.partitionBy(*folders).parquet(path)
    return read_rejects(staged.sparkSession, out_dir, log_type).filter(F.col(run.column) == run.value)


REJECT_SCHEMA = (
    "value binary, reason string, topic string, partition int, offset bigint, ingest_time timestamp"
)


def read_rejects(
    spark: SparkSession, out_dir: str, log_type: str, run_column: str = "run_id"
) -> DataFrame:
    """The reject table of a log type over all runs."""
    rows = spark.read.schema(f"{REJECT_SCHEMA}, {run_column} string").parquet(rejects_path(out_dir, log_type))
    return rows.withColumn("log_type", F.lit(log_type))


def sink_path(out_dir: str, item: InputSpec, sink: SinkSpec) -> str:
    """The folder of one sink's rows.

    Every input has a folder of its own, so equal sink settings do not collide.
    """
    place = sink.bucket if sink.type == "aws_s3" else sink.type
    path = f"{out_dir.rstrip('/')}/{place}/input_id={item.id}/{sink.id}"
    if sink.type == "aws_s3":
        return object_folder(path, sink.key_prefix)
    if sink.type == "elasticsearch":
        return f"{path}/{index_name(item.log_type, sink.index)}"
    return f"{path}/{V.OLAP_DATABASE}/{item.log_type}"


FILES, CONNECTOR = "files", "connector"


def write_sink(
    events: DataFrame, log_type: str, sink: SinkSpec, path: str, run: Run, deliver: str = FILES
) -> None:
    """One sink's rows of one run: as files at ``path``, or to the place the sink names."""
    rows = only_log_type(events, log_type)
    if deliver not in (FILES, CONNECTOR):
        raise ValueError(f"deliver must be {FILES!r} or {CONNECTOR!r}")
    if sink.type == "aws_s3":
        rows = with_event_time(rows, log_type).drop("route")
        if deliver == CONNECTOR:
            settings = events.sparkSession._jsc.hadoopConfiguration()
            for key, value in store_options(sink.endpoint, sink.region, sink.auth).items():
                # per bucket, so that sinks of several stores do not meet
                settings.set(key.replace("fs.s3a.", f"fs.s3a.bucket.{sink.bucket}.", 1), value)
            path = object_folder(f"s3a://{sink.bucket}", sink.key_prefix)
        write_object_store(rows, path, sink.key_prefix, log_type=log_type, run=run)
    elif sink.type == "elasticsearch":
        # this sink leaves the raw message out
        if deliver == CONNECTOR:
            write_index(rows, log_type, index=sink.index, endpoint=sink.endpoint, keep_message=False)
        else:
            write_index(rows, log_type, path, keep_message=False, run=run)
    elif deliver == CONNECTOR:
        write_olap(rows, log_type, url=sink.endpoint)
    else:
        write_olap(rows, log_type, path, run=run)


def check_lookups(item: InputSpec, threat: ThreatLookup | None, geo: GeoLookup | None) -> None:
    if item.enrich_threatip and threat is None:
        raise ValueError(f"input {item.id} wants the threat lookup, none was given")
    if item.enrich_geoip and geo is None:
        raise ValueError(f"input {item.id} wants the geographic lookup, none was given")


def enriched_input(
    reduced: DataFrame, item: InputSpec, threat: ThreatLookup | None, geo: GeoLookup | None
) -> DataFrame:
    check_lookups(item, threat, geo)
    return enrich(
        reduced,
        threat if item.enrich_threatip else None,
        geo if item.enrich_geoip else None,
    )


def run_batch(
    spec: RunSpec,
    raw: Mapping[str, DataFrame],
    out_dir: str,
    threat: ThreatLookup | None = None,
    geo: GeoLookup | None = None,
    gap_seconds: int | None = None,
    *,
    run_id: str,
    deliver: str = FILES,
    ledger: Ledger | None = None,
) -> RunResult:
    """Runs every input over the raw table of its log type and adds the rows to its sinks.

    Rows of other runs stay; a run repeated under its ``run_id`` replaces its own.
    ``deliver`` says whether sinks are folders under ``out_dir`` or the places the
    specification names (through connectors the cluster provides; those only add).

    With a ``ledger`` only rows beyond the positions of earlier runs are read, dedupe by gap
    remembers what those runs saw, and both are committed when all sinks have been written.
    A committed run that is repeated reads the rows that it read before.

    A log type is parsed once, into a table split by route in the shared folder,
    however many inputs use it; its rejects go to the output at once. Its reduced
    rows and an input's enriched rows are written likewise only where more than one
    reader follows. Log types, inputs and sinks do not wait for each other.
    """
    run = Run("run_id", run_id)
    spark = next(iter(raw.values())).sparkSession
    past = ledger.open(run_id) if ledger else None
    result = RunResult(Stages(spark))
    uses = Counter(i.log_type for i in spec.inputs)
    readers = 1 if broadcastable(threat, geo) else 2
    for item in spec.inputs:
        check_lookups(item, threat, geo)

    def run_type(name: str) -> list[Future]:
        log_type = LOG_TYPES[name]
        rows = past.unread(raw[name], name) if past else raw[name]
        staged = result.stages.written(log_type.staged(rows), f"parsed-{name}", ("route",))
        result.staged[name] = staged
        written_rejects = sink_jobs.submit(target(write_rejects), staged, out_dir, name, run)
        seen = past.seen(name) if past and gap_seconds is not None else None
        kept = log_type.reduced(staged, gap_seconds, seen)
        # a lookup by shuffling, and one of addresses in a map, read their rows twice
        if uses[name] > 1 or readers > 1 or name == V.WINDOW_LOG:
            kept = result.stages.written(kept, f"reduced-{name}")
        inputs = [input_jobs.submit(target(run_input), i, kept) for i in spec.inputs if i.log_type == name]
        result.rejects[name] = written_rejects.result()
        return inputs

    def run_input(item: InputSpec, reduced: DataFrame) -> list[Future]:
        events = enriched_input(reduced, item, threat, geo).withColumn("input_id", F.lit(item.id))
        if len(item.sinks) > 1:
            events = result.stages.written(events, f"enriched-{item.id}")
        result.enriched[item.id] = events
        return [sink_jobs.submit(target(run_sink), events, item, sink) for sink in item.sinks]

    def run_sink(events: DataFrame, item: InputSpec, sink: SinkSpec) -> SinkResult:
        path = sink_path(out_dir, item, sink)
        counted, seen = observed(events, f"{spec.id}-{run_id}-{item.id}-{sink.id}")
        write_sink(counted, item.log_type, sink, path, run, deliver)
        return SinkResult(item.id, sink.id, sink.type, path, seen.get["events"])

    target = inheritable_thread_target(spark)
    try:
        with (
            ThreadPoolExecutor(JOBS_AT_ONCE) as type_jobs,
            ThreadPoolExecutor(JOBS_AT_ONCE) as input_jobs,
            ThreadPoolExecutor(JOBS_AT_ONCE) as sink_jobs,
        ):
            types = [type_jobs.submit(target(run_type), name) for name in uses]
            sinks = [s for t in types for i in t.result() for s in i.result()]
            done = {(s.input_id, s.sink_id): s for s in (f.result() for f in sinks)}
        if past:
            past.commit(result.staged, {name: LOG_TYPES[name].dedupe_keys for name in uses}, gap_seconds)
    except BaseException:
        result.close()
        raise
    result.sinks = [done[i.id, s.id] for i in spec.inputs for s in i.sinks]
    return result
