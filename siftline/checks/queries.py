"""The registered queries: (session, folder of the given tables) -> DataFrame.

``pos`` is the event's offset in its topic. Instants are returned as UTC clocks
so that they compare the same in every session zone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.checks import inputs as I
from siftline.functions.addresses import address_columns, address_maps
from siftline.functions.names import snake_name
from siftline.functions.times import utc_clock
from siftline.operators.accounting import component_metric, received, reduction_stats
from siftline.operators.changelog import changelog_table, latest_per_key
from siftline.operators.decoding import accepted, rejects
from siftline.operators.enrichment import BROADCAST_ROWS, enrich, prepare_geo, prepare_threat, text_addresses
from siftline.operators.merging import merge_inputs
from siftline.operators.parse_api_json import API_FIELDS, parse_api_json
from siftline.operators.reduction import POSITION, dedupe_first, dedupe_gap, hash_sample
from siftline.operators.routing import DEDUPE, SAMPLE, matching_upper, only_log_type
from siftline.operators.shaping import (
    event_time,
    flattened,
    index_projection,
    olap_rows,
    with_event_time,
)
from siftline.plans.catalog import LOG_TYPES
from siftline.plans.ledger import Ledger
from siftline.plans.runner import read_rejects, run_batch, sink_path
from siftline.plans.spec import read_spec
from siftline.render import rendered
from siftline.session import few_state_partitions, fresh_path, written
from siftline.sinks.object_store import write_object_store
from siftline.sinks.tables import write_indexes
from siftline.sinks.topics import as_json, start_topic, write_topic
from siftline.sources.lookups import read_geo_networks, read_threat_csv
from siftline.sources.raw import from_topic_json, read_files
from siftline.streaming.changelog import (
    read_changelog_table, read_changelog_topic, start_changelog, start_changelog_topic,
)
from siftline.streaming.jobs import (
    ALL_NOW,
    event_counts,
    read_accounts,
    read_staged,
    reduced_stream,
    start_parse,
    start_reduce,
    start_run,
)

Query = Callable[[SparkSession, str], DataFrame]

SHORT = {V.ACCESS_LOG: "access", V.ERROR_LOG: "error", V.CISCO_LOG: "cisco", V.WINDOW_LOG: "window"}
DETAIL_FIELDS = {
    V.ACCESS_LOG: V.ACCESS_FIELDS,
    V.ERROR_LOG: (
        "timestamp", "level", "pid", "tid", "request_id", "ip", "error_message",
        *V.ERROR_DETAIL_FIELDS,
    ),
    V.CISCO_LOG: (
        "severity", "message_id", "message_text", "event_type", *V.CISCO_DETAIL_FIELDS,
    ),
    V.WINDOW_LOG: (
        *V.WINDOW_SYSTEM_FIELDS, *(snake_name(n) for n in V.WINDOW_DATA_NAMES),
    ),
}
# rendered field -> key of ``extra``
WINDOW_EXTRA = {
    "extra_elevated": "extra_elevated", "system_version": "version", "system_keywords": "keywords",
    "system_process": "execution_process_id", "system_guid": "provider_guid",
    "system_user": "security_user_id", "system_task": "task", "client_ip": "client_ip_address",
}
ADDRESSES = {
    V.ACCESS_LOG: ("ip",),
    V.ERROR_LOG: ("ip",),
    V.CISCO_LOG: ("src_ip", "dst_ip", "nat_ip"),
    V.WINDOW_LOG: ("ip_address", "ip_port"),
}
MAP_ADDRESSES = {V.WINDOW_LOG: ("client_ip",)}


def _pos(df: DataFrame, *columns) -> DataFrame:
    return df.select(F.col("offset").alias("pos"), *columns)


# ---- parsing -----------------------------------------------------------------
def parse(spark, sf_dir, log_type, where=None):
    df = I.parsed(spark, sf_dir, log_type)
    if where is not None:
        df = df.filter(where)
    extra = (
        [F.col("extra")[key].alias(name) for name, key in WINDOW_EXTRA.items()]
        if log_type == V.WINDOW_LOG else []
    )
    return _pos(df, *DETAIL_FIELDS[log_type], *extra)


def reject_rows(spark, sf_dir, log_type):
    df = rejects(I.staged(spark, sf_dir, log_type))
    return _pos(df, "log_type", "reason", F.octet_length("value").alias("value_bytes"))


def api_parse(spark, sf_dir):
    df = accepted(parse_api_json(I.raw(spark, sf_dir, V.API_LOG)))
    at = utc_clock(event_time(V.API_LOG)).alias("event_time")
    return _pos(df, *[snake_name(f) for f in API_FIELDS], at)


def event_times(spark, sf_dir, log_type):
    df = with_event_time(I.parsed(spark, sf_dir, log_type), log_type)
    return _pos(df, utc_clock(F.col("event_time")).alias("event_time"))


def junk_lines(spark, sf_dir):
    """Whole documents and pages through every parser: each must end as a reject."""
    texts = I.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text"
    ).unionByName(
        I.table(spark, sf_dir, "pages").select(
            F.lit("page").alias("origin"), F.col("page_id").alias("id"),
            F.col("html").alias("text"),
        )
    )
    lines = texts.select(
        F.col("text").cast("binary").alias("value"),
        F.lit(None).cast("binary").alias("key"),
        F.col("origin").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
    return merge_inputs([
        rejects(t.parse(lines)).select(
            F.col("topic").alias("origin"), F.col("offset").alias("id"), "log_type", "reason",
            F.octet_length("value").alias("value_bytes"),
        )
        for t in LOG_TYPES.values()
    ])


# ---- routing and reduction ---------------------------------------------------
def routes(spark, sf_dir, log_type):
    return _pos(I.parsed(spark, sf_dir, log_type), "route")


def sample(spark, sf_dir, log_type):
    df = I.parsed(spark, sf_dir, log_type).filter(F.col("route") == SAMPLE)
    return _pos(hash_sample(df))


def first_per_key(spark, sf_dir, log_type):
    keys = V.DEDUPE_KEYS[log_type]
    df = I.parsed(spark, sf_dir, log_type).filter(F.col("route") == DEDUPE)
    return _pos(dedupe_first(df, keys), *keys)


def gap_per_key(spark, sf_dir, log_type, keys, gap_seconds):
    df = dedupe_gap(I.parsed(spark, sf_dir, log_type), keys, gap_seconds)
    return _pos(df, *keys)


def reduce(spark, sf_dir, log_type):
    return _pos(I.reduced(spark, sf_dir, log_type), "route")


def merged(spark, sf_dir):
    tables = [I.reduced(spark, sf_dir, t) for t in I.PIPELINE_TYPES]
    return _pos(merge_inputs(tables), "log_type", "route", "level", "ip", "src_ip", "ip_address")


def per_log_type(spark, sf_dir):
    """One merged table split again by log type, as in front of the sinks."""
    merged_rows = merge_inputs([I.parsed(spark, sf_dir, t) for t in I.PIPELINE_TYPES])
    return merge_inputs([
        _pos(only_log_type(merged_rows, t), F.col("log_type").alias("sink")).groupBy("sink").agg(
            F.count("*").alias("events"), F.max("pos").alias("last_pos")
        )
        for t in I.PIPELINE_TYPES
    ])


# ---- enrichment --------------------------------------------------------------
def _addresses(spark, sf_dir, log_type, large=False):
    """Addresses of the parsed rows with their position, written once where they are read twice:
    by lookups of addresses in a map, and by lookups by shuffling."""
    df = I.parsed(spark, sf_dir, log_type)
    maps = address_maps(df.schema)
    df = df.select(*POSITION, *address_columns(df.schema), *maps)
    return written(df, f"addresses-{log_type}") if large or maps else df


def threat_flag(spark, sf_dir, log_type):
    threat, _ = I.lookups(spark, sf_dir)
    df = enrich(_addresses(spark, sf_dir, log_type), threat, keep_metadata=True)
    return _pos(df, "threat_ip")


def _geo_columns(names, extra=()):
    """Hit and place per address column; ``extra``: rendered fields that lie in the map ``extra``."""
    out = []
    for n in (*names, *extra):
        geo = F.col("geo_extra")[WINDOW_EXTRA[n]] if n in extra else F.col(f"geo_{n}")
        out += [
            geo.isNotNull().alias(f"geo_{n}_hit"),
            geo["country"].alias(f"geo_{n}_country"),
            geo["latitude"].alias(f"geo_{n}_latitude"),
            geo["longitude"].alias(f"geo_{n}_longitude"),
        ]
    return out


def geo(spark, sf_dir, log_type):
    _, networks = I.lookups(spark, sf_dir)
    df = enrich(_addresses(spark, sf_dir, log_type), geo=networks, keep_metadata=True)
    return _pos(df, *_geo_columns(ADDRESSES[log_type], MAP_ADDRESSES.get(log_type, ())))


def geo_large(spark, sf_dir, log_type):
    """The same rows by the way taken when the lookups are too large to broadcast."""
    threat, networks = I.lookups(spark, sf_dir)
    df = enrich(
        _addresses(spark, sf_dir, log_type, large=True), threat, networks,
        broadcast_rows=0, keep_metadata=True,
    )
    return _pos(df, "threat_ip", *_geo_columns(ADDRESSES[log_type], MAP_ADDRESSES.get(log_type, ())))


def modes(spark, sf_dir):
    """Both lookups, one and none on the same events."""
    threat, networks = I.lookups(spark, sf_dir)
    events = I.parsed(spark, sf_dir, V.ACCESS_LOG).select("log_type", "ip", "status", "offset")
    out = []
    for name, t, g in (
        ("both", threat, networks), ("geo", None, networks),
        ("threat", threat, None), ("none", None, None),
    ):
        df = enrich(events, t, g, keep_metadata=True)
        out.append(_pos(
            df,
            F.lit(name).alias("mode"),
            (F.col("threat_ip").cast("string") if t else F.lit("not asked")).alias("threat"),
            (F.col("geo_ip.country") if g else F.lit("not asked")).alias("country"),
        ))
    return merge_inputs(out)


def text_ips(spark, sf_dir, name, key, text):
    threat, networks = I.lookups(spark, sf_dir)
    found = text_addresses(I.table(spark, sf_dir, name), text, [key])
    df = enrich(found, threat, networks)
    return df.select(key, "position", "ip", "threat_ip", *_geo_columns(("ip",)))


# ---- shaping and sinks -------------------------------------------------------
def _enriched(spark, sf_dir, log_type):
    threat, networks = I.lookups(spark, sf_dir)
    return enrich(I.parsed(spark, sf_dir, log_type), threat, networks, keep_metadata=True)


def flat(spark, sf_dir):
    df = flattened(_enriched(spark, sf_dir, V.ACCESS_LOG))
    return _pos(
        df, *V.ACCESS_FIELDS, "threat_ip", "geo_ip_country", "geo_ip_latitude", "geo_ip_longitude"
    )


def index_rows(spark, sf_dir, log_type):
    df = index_projection(_enriched(spark, sf_dir, log_type), log_type, keep_message=False)
    return flattened(df).withColumn("timestamp", utc_clock(F.col("timestamp")))


def olap(spark, sf_dir):
    columns = [
        "log_type", "timestamp", "level", "pid", "ip", "errno", "file_path",
        "geo_ip_country", "threat_ip", "not_sent",
    ]
    df = olap_rows(_enriched(spark, sf_dir, V.ERROR_LOG), V.ERROR_LOG, columns)
    return df.withColumn("timestamp", utc_clock(F.col("timestamp"))).withColumn(
        "not_sent", F.coalesce("not_sent", F.lit("-"))
    )


def object_store_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "objects")
    df = with_event_time(_enriched(spark, sf_dir, V.ACCESS_LOG), V.ACCESS_LOG)
    write_object_store(df.drop("route"), path)
    schema = (
        "offset bigint, ip string, method string, url string, status string, threat_ip boolean,"
        "geo_ip struct<country:string,latitude:double,longitude:double>,"
        "year string, month string, day string, log_type string"
    )
    back = spark.read.schema(schema).json(path)
    return _pos(
        back, "ip", "method", "url", "status", "threat_ip",
        F.col("geo_ip.country").alias("country"), "year", "month", "day", "log_type",
    )


def index_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "indexes")
    rows = merge_inputs([
        I.parsed(spark, sf_dir, t).select(
            # some events of no known type, for the fallback index
            F.when(F.col("offset") % 50 != 1, F.col("log_type")).alias("log_type"), "offset"
        )
        for t in I.PIPELINE_TYPES
    ])
    write_indexes(rows, path)
    back = spark.read.parquet(path)
    pos = F.get_json_object("document", "$.offset").cast("bigint")
    return back.groupBy(F.col("index").alias("index_name")).agg(
        F.count("*").alias("documents"), F.sum(pos).alias("pos_sum")
    )


def topic_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "topics")
    events = I.parsed(spark, sf_dir, V.CISCO_LOG).select(
        "log_type", "offset", "event_type", "src_ip", "dst_ip",
        F.col("offset").cast("string").alias("k"),
    )
    write_topic(as_json(events, key="k"), "enrich_topic", path=path)
    back = spark.read.parquet(path).filter(F.col("topic") == "enrich_topic")
    schema = "log_type string, offset bigint, event_type string, src_ip string, dst_ip string"
    return _pos(from_topic_json(back, schema), "event_type", "src_ip", "dst_ip")


def _store(name: str, prefix: str | None = None) -> dict:
    config = {
        "endpoint": "https://objects.example", "region": "eu-north-1", "bucket": "edge-archive",
        "auth": {"access_key_id": "id-of-tests", "secret_access_key": "not-a-secret"},
    }
    return {"id": name, "type": "aws_s3", "config": config | ({"key_prefix": prefix} if prefix else {})}


RUN_SPEC = {"fullPipelineConfig": {"id": "nightly", "inputs": [
    {"id": "perimeter", "log_type": "cisco_log", "enrich_geoip": True, "enrich_threatip": True, "sinks": [
        {"id": "search", "type": "elasticsearch", "config": {"endpoint": "https://search.example:9243/logs", "index": "fw"}},
        _store("archive", "firewall/y=%Y/h=%H/raw/kept"),
    ]},
    {"id": "perimeter-flags", "log_type": "cisco_log", "enrich_threatip": True, "sinks": [_store("flags")]},
    {"id": "edge", "log_type": "access_log", "enrich_geoip": True, "sinks": [
        {"id": "analytics", "type": "clickhouse", "config": {"endpoint": "http://columns.example:8123"}},
    ]},
    {"id": "edge-errors", "log_type": "error_log", "enrich_geoip": True, "enrich_threatip": True, "sinks": [
        {"id": "search", "type": "elasticsearch", "config": {"endpoint": "search.example"}},
    ]},
    {"id": "hosts", "log_type": "window_log", "enrich_threatip": True, "sinks": [_store("archive")]},
]}}
# the key of a deduplicated row decides what these sinks show of it: a stream may keep any row of a key
STREAM_SPEC = {"inputs": [
    {"id": "perimeter", "log_type": "cisco_log", "enrich_geoip": True, "enrich_threatip": False, "sinks": [
        {"id": "search", "type": "elasticsearch", "config": {"endpoint": "search.example"}}, _store("archive"),
    ]},
    {"id": "edge", "log_type": "access_log", "enrich_geoip": True, "enrich_threatip": True, "sinks": [
        {"id": "analytics", "type": "clickhouse", "config": {"endpoint": "columns.example"}},
    ]},
]}
_GEO_COLUMN = "struct<country:string,latitude:double,longitude:double>"
_JSON_ROWS = (
    "threat_ip boolean, event_type string, src_ip string, dst_ip string, computer string, event_id string, "
    "target_user_name string, "
    f"geo_src_ip {_GEO_COLUMN}, log_type string"
)


def _sink_rows(spark, item, sink, path):
    """What a sink holds, as ``input_id, sink_id, a, b, c, flag, place``."""
    if sink.type == "aws_s3":
        rows = spark.read.schema(_JSON_ROWS).json(path)
        a, b, c, place = F.col("src_ip"), F.col("event_type"), F.col("dst_ip"), F.col("geo_src_ip.country")
        if item.log_type == V.WINDOW_LOG:
            a, b, c = F.col("computer"), F.col("event_id"), F.col("target_user_name")
    else:
        rows = spark.read.parquet(path)
        if item.log_type == V.CISCO_LOG:
            a, b, c, place = F.col("src_ip"), F.col("event_type"), F.col("dst_ip"), F.col("geo_src_ip.country")
        elif item.log_type == V.ERROR_LOG:
            a, b, c, place = F.col("ip"), F.col("level"), F.col("errno").cast("string"), F.col("geo_ip.country")
        else:
            a, b, c, place = F.col("ip"), F.col("url"), F.col("status"), F.col("geo_ip_country")
    flag = F.col("threat_ip") if item.enrich_threatip else F.lit(None)
    return rows.select(
        F.lit(item.id).alias("input_id"), F.lit(sink.id).alias("sink_id"),
        a.alias("a"), b.alias("b"), c.alias("c"), flag.cast("boolean").alias("flag"), place.alias("place"),
    )


def _all_sinks(spark, spec, out):
    return merge_inputs([
        _sink_rows(spark, i, s, sink_path(out, i, s)) for i in spec.inputs for s in i.sinks
    ])


def spec_run(spark, sf_dir):
    """The batch job of a specification: every row that its sinks hold."""
    threat, networks = I.lookups(spark, sf_dir)
    spec, out = read_spec(RUN_SPEC), fresh_path(spark, "run")
    raws = {i.log_type: I.raw(spark, sf_dir, i.log_type) for i in spec.inputs}
    run_batch(spec, raws, out, threat, networks, run_id="r1").close()
    return _all_sinks(spark, spec, out)


def _halves(raw):
    return raw.filter("offset % 2 = 0"), raw.filter("offset % 2 = 1")


def spec_two_runs(spark, sf_dir):
    """Two runs over two halves of the events, the second one twice: every row of all sinks."""
    threat, networks = I.lookups(spark, sf_dir)
    spec, out = read_spec(RUN_SPEC), fresh_path(spark, "run")
    halves = {i.log_type: _halves(I.raw(spark, sf_dir, i.log_type)) for i in spec.inputs}
    for run_id, half in (("even", 0), ("odd", 1), ("odd", 1)):
        raws = {name: h[half] for name, h in halves.items()}
        run_batch(spec, raws, out, threat, networks, run_id=run_id).close()
    return _all_sinks(spark, spec, out)


RESUMED_GAP = 36_000


def spec_resumed_runs(spark, sf_dir):
    """Three runs over files that grow, without offsets given: the second one fails at its
    sinks first, the third is repeated after its commit. Every row of all sinks, deduplicated
    as if it had been one run."""
    threat, networks = I.lookups(spark, sf_dir)
    spec, out, topics = read_spec(RUN_SPEC), fresh_path(spark, "run"), fresh_path(spark, "topics")
    ledger = Ledger(spark, fresh_path(spark, "ledger"))
    types = sorted({i.log_type for i in spec.inputs})
    events = I.table(spark, sf_dir, "events").count()

    def run(run_id, **options):
        raws = {t: read_files(spark, f"{topics}/{t}") for t in types}
        run_batch(spec, raws, out, threat, networks, RESUMED_GAP, run_id=run_id, ledger=ledger, **options).close()

    for k in range(3):
        # a few narrow rows become many long lines: dealt first, rendered and written by all tasks
        part = I.table(spark, sf_dir, "events").filter(
            (F.col("event_id") * 3 >= k * events) & (F.col("event_id") * 3 < (k + 1) * events)
        ).repartition(spark.sparkContext.defaultParallelism, "event_id")
        for t in types:
            rendered(part, t).write.mode("append").parquet(f"{topics}/{t}")
        if k == 1:
            try:
                run("run-1", deliver="nowhere")
            except ValueError:
                pass
        run(f"run-{k}")
    run("run-2")
    return _all_sinks(spark, spec, out)


def spec_rejects(spark, sf_dir):
    """The reject tables that two runs leave in the output."""
    spec, out = read_spec({"inputs": [
        {"id": t, "log_type": t, "sinks": []} for t in (V.ACCESS_LOG, V.WINDOW_LOG)
    ]}), fresh_path(spark, "run")
    halves = {i.log_type: _halves(I.raw(spark, sf_dir, i.log_type)) for i in spec.inputs}
    for half in (0, 1):
        run_batch(spec, {n: h[half] for n, h in halves.items()}, out, run_id=f"half-{half}").close()
    return merge_inputs([
        _pos(read_rejects(spark, out, t), "log_type", "reason", "run_id",
             F.octet_length("value").alias("value_bytes"))
        for t in halves
    ])


def listed_files(spark, sf_dir):
    """Both lookups from CSV files, bare addresses among the networks; access rows enriched by them."""
    path = fresh_path(spark, "lists")
    suppliers = I.table(spark, sf_dir, "supplier").select(F.expr(I.SUPPLIER_ADDRESS).alias("ip"), "s_suppkey")
    listed = I.threat_list(spark, sf_dir)
    listed.write.option("header", True).csv(f"{path}/threat")
    suppliers.select(
        F.col("ip").alias("network"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("country"),
        F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"),
    ).write.option("header", True).csv(f"{path}/places.csv")
    threat = prepare_threat(read_threat_csv(spark, f"{path}/threat"))
    geo = prepare_geo(read_geo_networks(spark, f"{path}/places.csv"))
    events = suppliers.select(
        F.col("s_suppkey").alias("offset"), "ip", F.regexp_replace("ip", r"\.\d+$", ".0").alias("other_ip"))
    df = enrich(events, threat, geo, keep_metadata=True)
    return _pos(df, "threat_ip", F.col("geo_ip.country").alias("country"),
                F.col("geo_other_ip.country").alias("other_country"))


def offset_range(spark, sf_dir):
    """A range of offsets of one topic of two that lie in the same files."""
    path = fresh_path(spark, "topics")
    for t in (V.ACCESS_LOG, V.CISCO_LOG):
        I.raw(spark, sf_dir, t).write.mode("append").parquet(path)
    rows = read_files(spark, path, topics=[V.CISCO_LOG], offsets=(100, 700))
    return _pos(rows, "topic", "partition", F.octet_length("value").alias("value_bytes"))


def two_topics(spark, sf_dir):
    """First row per key of two topics that share partition and offset numbers and times."""
    events = I.parsed(spark, sf_dir, V.ACCESS_LOG)
    both = events.unionByName(events.withColumn("topic", F.lit("a_" + V.ACCESS_LOG)))
    return _pos(dedupe_first(both, ("method", "status")), "topic", "method", "status")


# ---- accounting --------------------------------------------------------------
def stats(spark, sf_dir):
    threat, _ = I.lookups(spark, sf_dir)
    parts = []
    for t in I.PIPELINE_TYPES:
        stage = I.staged_table(spark, sf_dir, t)
        kept = enrich(LOG_TYPES[t].reduced(stage), threat)
        parts.append(reduction_stats(stage, kept))
    return merge_inputs(parts)


def bytes_received(spark, sf_dir):
    return received(merge_inputs([I.raw(spark, sf_dir, t) for t in I.PIPELINE_TYPES]))


def metric_filter(spark, sf_dir):
    """Byte counts of one component type, picked out of a table of metric rows."""
    counts = bytes_received(spark, sf_dir)
    metrics = counts.select(
        "topic", "minute",
        F.inline(F.array(*[
            F.struct(
                F.struct(F.lit(kind).alias("component_type")).alias("tags"),
                F.lit(name).alias("name"), F.col(measure).alias("counter"),
            )
            for kind, name, measure in (
                ("kafka", "component_received_event_bytes_total", "bytes"),
                ("kafka", "component_received_events_total", "events"),
                ("remap", "component_received_event_bytes_total", "bytes"),
            )
        ])),
    )
    return component_metric(
        metrics, "kafka", "component_received_event_bytes_total"
    ).select("topic", "minute", "name", "counter")


# ---- changelog ---------------------------------------------------------------
def changes(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("value"),
        F.col("event_id").alias("offset"),
    )


def changelog_latest(spark, sf_dir):
    return changelog_table(changes(spark, sf_dir), contains="c")


def full_match_upper(spark, sf_dir):
    """Names, which have digits, and addresses of pages, of which only some end in one line."""
    names = I.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_name").alias("value"))
    texts = I.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("value"))
    urls = I.table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("origin"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("value"))
    return matching_upper(merge_inputs([names, texts, urls])).withColumn("value", F.md5("value"))


# ---- streaming ---------------------------------------------------------------
#: Bytes of a row group of the raw files: lines compress so well that a file would be one task's.
ROW_GROUP = 4 << 20


def _raw_files(spark, sf_dir, log_type):
    """The raw lines as files a stream reads in several batches; events are dealt before they are rendered."""
    path = fresh_path(spark, f"raw-{log_type}")
    events = I.table(spark, sf_dir, "events").repartitionByRange(6, "event_id")
    I.rendered(events, log_type).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return path


def _raw_stream(spark, path):
    return read_files(spark, path, stream=True, max_files_per_trigger=2)


def _drained(df, path, **options):
    """Runs a stream over all there is into Parquet files."""
    with few_state_partitions(df.sparkSession):
        query = (
            df.writeStream.format("parquet").option("path", f"{path}/rows")
            .option("checkpointLocation", f"{path}/checkpoint").options(**options)
            .trigger(**ALL_NOW).start()
        )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")


def _parsed_stream(spark, sf_dir, log_type):
    work = fresh_path(spark, "stream")
    source = _raw_stream(spark, _raw_files(spark, sf_dir, log_type))
    start_parse(
        source, LOG_TYPES[log_type], f"{work}/parsed", f"{work}/checkpoint", ALL_NOW
    ).awaitTermination()
    return work


def stream_parse(spark, sf_dir, log_type):
    work = _parsed_stream(spark, sf_dir, log_type)
    back = spark.read.parquet(f"{work}/parsed")
    return _pos(back, "route", "reject_reason", *DETAIL_FIELDS[log_type])


FOREVER = "36500 days"


def stream_reduced(spark, sf_dir, log_type):
    """Kept rows by position; of the deduplicated rows, whose winner may vary, the keys."""
    work = _parsed_stream(spark, sf_dir, log_type)
    kept = reduced_stream(
        spark, f"{work}/parsed", LOG_TYPES[log_type], FOREVER, max_files_per_trigger=4
    )
    rows = _drained(kept, f"{work}/reduced")
    pos = F.when(F.col("route") != DEDUPE, F.col("offset")).otherwise(-1)
    return rows.select(pos.alias("pos"), "route", *V.DEDUPE_KEYS[log_type])


def _spec_stream(spark, sf_dir, spec, **options):
    threat, networks = I.lookups(spark, sf_dir)
    files = {i.log_type: _raw_files(spark, sf_dir, i.log_type) for i in spec.inputs}
    work, out = fresh_path(spark, "stream-run"), fresh_path(spark, "stream-out")
    for q in start_run(
        spark, spec, lambda name: _raw_stream(spark, files[name]), work, out,
        threat, options.pop("geo", networks), trigger=ALL_NOW, max_files_per_trigger=4, **options,
    ):
        q.awaitTermination()
    return out


def stream_enriched(spark, sf_dir):
    """The streaming run of a specification: every row that its sinks hold."""
    spec = read_spec(STREAM_SPEC)
    out = _spec_stream(spark, sf_dir, spec, window=FOREVER)
    return _all_sinks(spark, spec, out).select("input_id", "sink_id", "a", "b", "flag", "place")


def stream_accounts(spark, sf_dir):
    """Events that the sinks of a streaming run were sent, counted while they were."""
    spec = read_spec(STREAM_SPEC)
    out = _spec_stream(spark, sf_dir, spec, window=FOREVER)
    return read_accounts(spark, out).groupBy("input_id", "sink_id").agg(F.sum("events").alias("events"))


def stream_large_lookup(spark, sf_dir):
    """The same with lookups too large to be sent to every executor."""
    _, geo = I.lookups(spark, sf_dir)
    spec = read_spec(STREAM_SPEC)
    out = _spec_stream(spark, sf_dir, spec, window=FOREVER, geo=replace(geo, rows=BROADCAST_ROWS + 1))
    return _all_sinks(spark, spec, out).select("input_id", "sink_id", "a", "b", "flag", "place")


def stream_dedupe_late(spark, sf_dir):
    """A short window, and topic partitions hours behind each other: which keys have a kept row."""
    raw = I.raw(spark, sf_dir, V.ACCESS_LOG)
    lag = F.expr("make_interval(0, 0, 0, 0, partition * 3)")
    path = fresh_path(spark, "raw-lagging")
    raw.withColumn("timestamp", F.col("timestamp") - lag).repartition(8, "partition").write.parquet(path)
    work = fresh_path(spark, "stream")
    t = LOG_TYPES[V.ACCESS_LOG]
    start_parse(
        read_files(spark, path, stream=True, max_files_per_trigger=1), t, f"{work}/parsed",
        f"{work}/checkpoint", ALL_NOW,
    ).awaitTermination()
    kept = reduced_stream(spark, f"{work}/parsed", t, "1 second", salts=4, max_files_per_trigger=3)
    rows = _drained(kept, f"{work}/reduced").filter(F.col("route") == DEDUPE)
    return rows.groupBy(*t.dedupe_keys).agg(F.lit(True).alias("kept"))


def stream_restart(spark, sf_dir):
    """A parse and a reduce query stopped in the middle and started again on the same checkpoint."""
    t = LOG_TYPES[V.CISCO_LOG]
    path, work = fresh_path(spark, "raw"), fresh_path(spark, "stream")
    for part in _halves(I.raw(spark, sf_dir, V.CISCO_LOG)):
        part.write.mode("append").parquet(path)
        start_parse(_raw_stream(spark, path), t, f"{work}/parsed/{t.name}", f"{work}/checkpoint", ALL_NOW).awaitTermination()
        start_reduce(spark, t, work, ALL_NOW, FOREVER).awaitTermination()
    rows = spark.read.parquet(f"{work}/reduced/{t.name}")
    pos = F.when(F.col("route") != DEDUPE, F.col("offset")).otherwise(-1)
    return rows.select(pos.alias("pos"), "route", *V.DEDUPE_KEYS[V.CISCO_LOG])


def stream_topic(spark, sf_dir):
    """A stream handed on as JSON over a topic, and read from it by the next job."""
    work = _parsed_stream(spark, sf_dir, V.CISCO_LOG)
    events = read_staged(spark, f"{work}/parsed", LOG_TYPES[V.CISCO_LOG], (SAMPLE, "dangerous", DEDUPE), 4).select(
        "log_type", "offset", "event_type", "src_ip", "dst_ip")
    start_topic(as_json(events), "enrich_topic", f"{work}/topic-checkpoint", path=f"{work}/topics").awaitTermination()
    back = spark.read.parquet(f"{work}/topics").filter(F.col("topic") == "enrich_topic")
    schema = "log_type string, offset bigint, event_type string, src_ip string, dst_ip string"
    return _pos(from_topic_json(back, schema), "event_type", "src_ip", "dst_ip")


def stream_counts(spark, sf_dir):
    """Events per minute of event time, from a stream of the parsed table."""
    work = _parsed_stream(spark, sf_dir, V.ACCESS_LOG)
    parsed = read_staged(
        spark, f"{work}/parsed", LOG_TYPES[V.ACCESS_LOG], ("sample", "dangerous", "dedupe"), 4
    )
    target = f"{work}/counts"

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    (
        event_counts(parsed, V.ACCESS_LOG)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", f"{work}/checkpoint-counts")
        .foreachBatch(replace).trigger(**ALL_NOW).start().awaitTermination()
    )
    rows = spark.read.parquet(target)
    return rows.select("log_type", "route", utc_clock(F.col("minute")).alias("minute"), "events")


def stream_changelog(spark, sf_dir):
    work = fresh_path(spark, "changelog")
    source = changes(spark, sf_dir)
    source.repartitionByRange(6, "offset").write.parquet(f"{work}/changes")
    stream = (
        spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 2)
        .parquet(f"{work}/changes")
    )
    start_changelog(
        stream, f"{work}/table", f"{work}/checkpoint", contains="c", compact_every=2
    ).awaitTermination()
    return read_changelog_table(spark, f"{work}/table")


def stream_changelog_topic(spark, sf_dir):
    """The changelog sent on to a topic with tombstones, and that topic read as a changelog."""
    work = fresh_path(spark, "changelog")
    source = changes(spark, sf_dir)
    source.repartitionByRange(6, "offset").write.parquet(f"{work}/changes")
    stream = (
        spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 2)
        .parquet(f"{work}/changes")
    )
    start_changelog_topic(
        stream, "current", f"{work}/checkpoint", contains="c", path=f"{work}/out"
    ).awaitTermination()
    sent = read_changelog_topic(spark, f"{work}/out", "current")
    return latest_per_key(sent, ("key",), ("batch_id",)).filter("value IS NOT NULL").select("key", "value")


# ---- registration ------------------------------------------------------------
CISCO_KINDS = tuple(e[0] for e in V.CISCO_EVENTS)
WINDOW_EVENTS = (4624, 4625, 4634, 4723)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access lines parsed, routed, reduced and flagged."""
    threat, _ = I.lookups(spark, sf_dir)
    df = enrich(I.reduced(spark, sf_dir, V.ACCESS_LOG), threat, keep_metadata=True)
    return _pos(df, "route", *V.ACCESS_FIELDS, "threat_ip")


def registered() -> dict[str, Query]:
    out: dict[str, Query] = {"access_reduced_flagged": flagship}
    for t, short in SHORT.items():
        out[f"{short}_parse"] = partial(parse, log_type=t)
        out[f"{short}_reject"] = partial(reject_rows, log_type=t)
        out[f"event_time_{short}"] = partial(event_times, log_type=t)
        out[f"route_{short}"] = partial(routes, log_type=t)
        out[f"sample_{short}"] = partial(sample, log_type=t)
        out[f"reduced_{short}"] = partial(reduce, log_type=t)
        out[f"threat_flag_{short}"] = partial(threat_flag, log_type=t)
        out[f"geo_{short}"] = partial(geo, log_type=t)
    for kind in CISCO_KINDS:
        out[f"cisco_parse_{kind}"] = partial(
            parse, log_type=V.CISCO_LOG, where=f"event_type = '{kind}'"
        )
    out["cisco_parse_debug"] = partial(parse, log_type=V.CISCO_LOG, where="severity = '7'")
    out["cisco_parse_unknown"] = partial(
        parse, log_type=V.CISCO_LOG, where="event_type IS NULL AND severity <> '7'"
    )
    for event in WINDOW_EVENTS:
        out[f"window_parse_{event}"] = partial(
            parse, log_type=V.WINDOW_LOG, where=f"event_id = '{event}'"
        )
    out["api_json_parse"] = api_parse
    out["junk_lines"] = junk_lines
    for t in (V.ACCESS_LOG, V.CISCO_LOG, V.WINDOW_LOG):
        out[f"dedupe_first_{SHORT[t]}"] = partial(first_per_key, log_type=t)
    out["dedupe_gap_access"] = partial(
        gap_per_key, log_type=V.ACCESS_LOG, keys=("method", "url"), gap_seconds=36_000
    )
    out["dedupe_gap_cisco"] = partial(
        gap_per_key, log_type=V.CISCO_LOG, keys=("severity", "event_type"), gap_seconds=600
    )
    out["geo_large_cisco"] = partial(geo_large, log_type=V.CISCO_LOG)
    out["geo_large_window"] = partial(geo_large, log_type=V.WINDOW_LOG)
    out["geo_large_access"] = partial(geo_large, log_type=V.ACCESS_LOG)
    out["merged_inputs"] = merged
    out["per_log_type"] = per_log_type
    out["enrich_modes"] = modes
    out["document_ips_enriched"] = partial(text_ips, name="documents", key="doc_id", text="text")
    out["page_ips_enriched"] = partial(text_ips, name="pages", key="page_id", text="html")
    out["flatten_rows"] = flat
    out["index_access"] = partial(index_rows, log_type=V.ACCESS_LOG)
    out["index_error"] = partial(index_rows, log_type=V.ERROR_LOG)
    out["olap_rows"] = olap
    out["object_store_roundtrip"] = object_store_roundtrip
    out["index_roundtrip"] = index_roundtrip
    out["topic_roundtrip"] = topic_roundtrip
    out["spec_run"] = spec_run
    out["spec_two_runs"] = spec_two_runs
    out["spec_resumed_runs"] = spec_resumed_runs
    out["spec_rejects"] = spec_rejects
    out["listed_files"] = listed_files
    out["offset_range"] = offset_range
    out["two_topics"] = two_topics
    out["reduction_stats"] = stats
    out["bytes_received"] = bytes_received
    out["metric_filter"] = metric_filter
    out["changelog_latest"] = changelog_latest
    out["full_match_upper"] = full_match_upper
    for t, short in SHORT.items():
        out[f"stream_parse_{short}"] = partial(stream_parse, log_type=t)
    out["stream_reduced_access"] = partial(stream_reduced, log_type=V.ACCESS_LOG)
    out["stream_reduced_cisco"] = partial(stream_reduced, log_type=V.CISCO_LOG)
    out["stream_spec_run"] = stream_enriched
    out["stream_accounts"] = stream_accounts
    out["stream_large_lookup"] = stream_large_lookup
    out["stream_dedupe_late"] = stream_dedupe_late
    out["stream_restart"] = stream_restart
    out["stream_topic"] = stream_topic
    out["stream_event_counts"] = stream_counts
    out["stream_changelog"] = stream_changelog
    out["stream_changelog_topic"] = stream_changelog_topic
    return out
