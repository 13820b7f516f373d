"""The streaming form of a run: one query parses, one per input reduces, enriches and writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siftline import fixed_values as V
from siftline.functions.times import not_after
from siftline.operators.accounting import observed
from siftline.operators.enrichment import GeoLookup, ThreatLookup
from siftline.operators.reduction import position_key, sampled
from siftline.operators.routing import DANGEROUS, DEDUPE, REJECT, ROUTES, SAMPLE
from siftline.operators.shaping import with_event_time
from siftline.plans.catalog import LOG_TYPES, LogType
from siftline.plans.runner import FILES, check_lookups, enriched_input, sink_path, write_rejects, write_sink
from siftline.plans.spec import InputSpec, RunSpec
from siftline.session import Stages, few_state_partitions, without_sort
from siftline.sinks.runs import Run, of_run
from siftline.sources.raw import RAW_SCHEMA
from siftline.streaming.dedupe import dedupe_stream

EVERY_TEN_SECONDS = {"processingTime": V.MICRO_BATCH_INTERVAL}
EVERY_SECOND = {"processingTime": V.OLAP_BATCH_INTERVAL}
ALL_NOW = {"availableNow": True}
#: Files that a batch of reduced rows is written as.
FILES_A_BATCH = 4


def start_parse(
    raw: DataFrame, log_type: LogType, stage: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Raw stream to the parsed table, one folder per route, rejects among them.

    The file sink's own log makes each batch appear once, also after a restart.
    """
    without_sort(raw.sparkSession)
    return (
        log_type.staged(raw)
        .writeStream.format("parquet")
        .partitionBy("route")
        .option("path", stage)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def staged_schema(spark: SparkSession, log_type: LogType):
    return log_type.staged(spark.createDataFrame([], RAW_SCHEMA)).schema


def read_staged(
    spark: SparkSession, stage: str, log_type: LogType, routes: Sequence[str],
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The parsed table as a stream, only the folders of the given routes.

    A parse task writes a file for each route, and a trigger takes files of all folders: so
    ``max_files_per_trigger`` bounds the files of one folder.
    """
    reader = spark.readStream.schema(staged_schema(spark, log_type))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger * len((*ROUTES, REJECT)))
    return reader.parquet(stage).filter(F.col("route").isin(*routes))


def reduced_stream(
    spark: SparkSession, stage: str, log_type: LogType, window: str = "10 minutes",
    salts: int = 16, max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Sample, dangerous rows and the deduplicated rest of a parsed stream."""
    def read(*routes: str) -> DataFrame:
        return read_staged(spark, stage, log_type, routes, max_files_per_trigger)

    straight = read(SAMPLE, DANGEROUS).filter(
        (F.col("route") != SAMPLE) | sampled(position_key())
    )
    repeated = dedupe_stream(read(DEDUPE), log_type.dedupe_keys, window, salts=salts)
    return straight.unionByName(repeated).drop("reject_reason", "raw_value")


ACCOUNT_SCHEMA = "input_id string, sink_id string, events bigint"


def accounts_path(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/accounts"


def read_accounts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Events sent to each sink, by batch."""
    return spark.read.schema(f"{ACCOUNT_SCHEMA}, batch_id bigint").parquet(accounts_path(out_dir))


def start_reduce(
    spark: SparkSession, log_type: LogType, work_dir: str, trigger: dict,
    window: str = "10 minutes", salts: int = 16, max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """The reduced rows of a log type, once for all inputs that use it.

    A batch is written by ``FILES_A_BATCH`` tasks: the state has a task for each of its
    partitions, and a file of each would make as many batches for the inputs.
    """
    kept = reduced_stream(
        spark, f"{work_dir}/parsed/{log_type.name}", log_type, window, salts, max_files_per_trigger
    )
    with few_state_partitions(spark):
        return (
            kept.repartition(FILES_A_BATCH).writeStream.format("parquet")
            .option("path", f"{work_dir}/reduced/{log_type.name}")
            .option("checkpointLocation", f"{work_dir}/checkpoints/reduce-{log_type.name}")
            .trigger(**trigger)
            .start()
        )


def read_reduced(
    spark: SparkSession, log_type: LogType, work_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    schema = T.StructType([
        f for f in staged_schema(spark, log_type).fields if f.name not in ("reject_reason", "raw_value")
    ])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{work_dir}/reduced/{log_type.name}")


def start_rejects(
    spark: SparkSession, log_type: LogType, work_dir: str, out_dir: str, trigger: dict
) -> StreamingQuery:
    """The rejects of a log type into the output, a folder for each batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_rejects(batch, out_dir, log_type.name, Run("batch_id", str(batch_id)))

    return (
        read_staged(spark, f"{work_dir}/parsed/{log_type.name}", log_type, (REJECT,))
        .writeStream.option("checkpointLocation", f"{work_dir}/checkpoints/rejects-{log_type.name}")
        .foreachBatch(write).trigger(**trigger).start()
    )


def usual_trigger(item: InputSpec) -> dict:
    """Analytic tables are fed every second, files and indexes every ten."""
    fast = any(s.type == "clickhouse" for s in item.sinks)
    return EVERY_SECOND if fast else EVERY_TEN_SECONDS


def start_run(
    spark: SparkSession,
    spec: RunSpec,
    raw: Callable[[str], DataFrame],
    work_dir: str,
    out_dir: str,
    threat: ThreatLookup | None = None,
    geo: GeoLookup | None = None,
    window: str = "10 minutes",
    trigger: dict | None = None,
    *,
    salts: int = 16,
    max_files_per_trigger: int | None = None,
    stage_trigger: dict | None = None,
    deliver: str = FILES,
) -> list[StreamingQuery]:
    """Starts for each log type the queries that parse, keep rejects and reduce, then one per input.

    Without a trigger an input has the usual one of its sinks, and the stages of a log
    type the shortest of its inputs; ``stage_trigger`` sets that of the stages apart
    (a longer one writes fewer files). With the ``availableNow`` trigger each step is awaited
    before the next, so that it sees all of its output. ``max_files_per_trigger`` bounds
    the batches of a catch-up.

    An input's batch is written once to the shared folder, enriched and sent to all sinks
    from there, counted, and removed; its rows lie in a last folder ``batch_id=<n>`` of each sink,
    which a batch run again replaces.
    """
    names = list(dict.fromkeys(i.log_type for i in spec.inputs))
    at_once = bool(trigger and trigger.get("availableNow"))
    for item in spec.inputs:
        check_lookups(item, threat, geo)

    def stage_of(name: str) -> dict:
        usual = (usual_trigger(i) for i in spec.inputs if i.log_type == name)
        return trigger or stage_trigger or min(usual, key=lambda t: t is not EVERY_SECOND)

    def started(*steps: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
        running = [step() for step in steps]
        if at_once:
            for q in running:
                q.awaitTermination()
        return running

    queries = started(*[
        lambda name=name: start_parse(
            raw(name), LOG_TYPES[name], f"{work_dir}/parsed/{name}",
            f"{work_dir}/checkpoints/parse-{name}", stage_of(name),
        ) for name in names
    ])
    queries += started(*[
        lambda name=name: start_reduce(
            spark, LOG_TYPES[name], work_dir, stage_of(name), window, salts, max_files_per_trigger
        ) for name in names
    ], *[
        lambda name=name: start_rejects(spark, LOG_TYPES[name], work_dir, out_dir, stage_of(name))
        for name in names
    ])

    def start_input(item: InputSpec) -> StreamingQuery:
        def write(batch: DataFrame, batch_id: int) -> None:
            run = Run("batch_id", str(batch_id))
            with Stages(batch.sparkSession) as stages:
                stages.written(batch, f"batch-{item.id}")
                # read by the session of the run: that of the stream plans without adapting to sizes
                rows = spark.read.schema(batch.schema).parquet(stages.paths[-1])
                events = enriched_input(rows, item, threat, geo).withColumn("input_id", F.lit(item.id))
                if len(item.sinks) > 1:
                    events = stages.written(events, f"enriched-{item.id}")
                counts = []
                for sink in item.sinks:
                    counted, seen = observed(events, f"{spec.id}-{item.id}-{sink.id}-{batch_id}")
                    write_sink(counted, item.log_type, sink, sink_path(out_dir, item, sink), run, deliver)
                    counts.append((item.id, sink.id, seen.get["events"]))
                if counts:
                    rows = spark.createDataFrame(counts, ACCOUNT_SCHEMA).coalesce(1)
                    writer, folders = of_run(rows, ["input_id"], run, "overwrite")
                    writer.partitionBy(*folders).parquet(accounts_path(out_dir))

        return (
            read_reduced(spark, LOG_TYPES[item.log_type], work_dir, max_files_per_trigger)
            .writeStream.option("checkpointLocation", f"{work_dir}/checkpoints/input-{item.id}")
            .foreachBatch(write).trigger(**(trigger or usual_trigger(item))).start()
        )

    return queries + [start_input(item) for item in spec.inputs]


def event_counts(staged: DataFrame, log_type: str, lateness: str = "5 hours") -> DataFrame:
    """Events per log type, route and minute of event time, as a stream or a table.

    Event time is capped at arrival time: a row from the future would otherwise
    move the watermark past rows still to come.
    """
    timed = with_event_time(staged, log_type).withColumn(
        "at", not_after(F.col("event_time"), F.col("ingest_time"))
    )
    return (
        timed.withWatermark("at", lateness)
        .groupBy("log_type", "route", F.window("at", "1 minute").alias("minute"))
        .agg(F.count("*").alias("events"))
        .withColumn("minute", F.col("minute.start"))
    )
