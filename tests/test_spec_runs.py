"""Specifications: reading, defaults, errors and the batch job."""

import copy
import os

import pytest

from siftline import fixed_values as V
from siftline.checks.queries import RUN_SPEC
from siftline.operators.enrichment import prepare_geo, prepare_threat
from siftline.plans.catalog import LOG_TYPES, log_type_named
from siftline.plans.runner import read_rejects, run_batch
from siftline.plans.spec import read_spec
from siftline.render import THREAT_ADDRESSES, rendered
from siftline.session import shared_dir, written
from siftline.sinks.runs import Run
from siftline.sinks.tables import index_options, olap_options, store_options
from siftline.sources.lookups import GEO_SCHEMA


def changed(change):
    spec = copy.deepcopy(RUN_SPEC)
    change(spec["fullPipelineConfig"]["inputs"])
    return spec


def test_defaults():
    def drop(inputs):
        inputs[0]["sinks"][0]["config"].pop("index")
        for k in ("bucket", "key_prefix"):
            inputs[0]["sinks"][1]["config"].pop(k)
        inputs[0].pop("enrich_geoip")

    item = read_spec(changed(drop)).inputs[0]
    assert item.sinks[0].index == "cisco_log" and item.enrich_geoip is False
    assert item.sinks[1].bucket == "log-bucket"
    assert item.sinks[1].key_prefix == "year=%Y/month=%m/day=%d/cisco_log/"
    assert "not-a-secret" not in repr(item)


@pytest.mark.parametrize("change", [
    lambda i: i[0].pop("log_type"),
    lambda i: i[0].update(log_type="mail_log"),
    lambda i: i[0]["sinks"][0].pop("type"),
    lambda i: i[0]["sinks"][0].update(type="ftp"),
    lambda i: i[0]["sinks"][0]["config"].pop("endpoint"),
    lambda i: i[0]["sinks"][1]["config"].pop("region"),
    lambda i: i[0]["sinks"][1]["config"]["auth"].pop("secret_access_key"),
    lambda i: i[0]["sinks"][1]["config"].update(key_prefix="w=%W/"),
    lambda i: i[0]["sinks"][1].update(id="search"),
    lambda i: i[0].update(enrich_geoip="yes"),
    lambda i: i[1].update(id="perimeter"),
    lambda i: i.clear(),
])
def test_bad_specs_are_refused(change):
    with pytest.raises(ValueError):
        read_spec(changed(change))


def test_two_sinks_without_ids_are_refused():
    sink = {"type": "elasticsearch", "config": {"endpoint": "x"}}
    with pytest.raises(ValueError, match="sink ids"):
        read_spec({"inputs": [{"log_type": "access_log", "sinks": [sink, sink]}]})


def test_connector_options():
    https = index_options("https://search.example:9243/logs")
    assert https["es.nodes"] == "search.example" and https["es.port"] == "9243"
    assert https["es.net.ssl"] == "true" and https["es.nodes.path.prefix"] == "logs"
    assert index_options("search.example")["es.port"] == "9200"
    olap = olap_options("http://columns.example:8123", "access_log")
    assert olap["url"] == "jdbc:clickhouse://columns.example:8123/log_database" and olap["dbtable"] == "access_log"
    assert olap_options("https://columns.example", "a")["url"].endswith(":8443/log_database?ssl=true")
    assert olap_options("jdbc:x://y", "a")["dbtable"] == "log_database.a"
    auth = {"access_key_id": "k", "secret_access_key": "s"}
    store = store_options("https://objects.example", "eu-north-1", auth)
    assert store["fs.s3a.endpoint.region"] == "eu-north-1" and store["fs.s3a.secret.key"] == "s"


def test_run_names():
    with pytest.raises(ValueError):
        Run("run_id", "a/b")


def test_log_type_names():
    assert log_type_named("Cisco Log").name == V.CISCO_LOG
    assert log_type_named("source_window_log_input-1").name == V.WINDOW_LOG


@pytest.fixture(scope="module")
def small(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    threat = prepare_threat(spark.createDataFrame([(a,) for a in THREAT_ADDRESSES], "ip string"))
    geo = prepare_geo(spark.createDataFrame([("1.0.0.0/8", "A", 1.0, 2.0)], GEO_SCHEMA))
    return events, threat, geo


def stage_folders(spark):
    place = f"{shared_dir(spark)}/siftline"
    return {n for n in (os.listdir(place) if os.path.isdir(place) else ())}


def test_batch_run(spark, tmp_path, small):
    events, threat, geo = small
    spec = read_spec(RUN_SPEC)
    raw = {i.log_type: rendered(events, i.log_type) for i in spec.inputs}
    before = stage_folders(spark)
    with run_batch(spec, raw, str(tmp_path), threat, geo, run_id="one") as result:
        assert stage_folders(spark) > before
        counts = {(s.input_id, s.sink_id): s.events for s in result.sinks}
        assert len(counts) == 6 and counts["perimeter", "search"] == counts["perimeter-flags", "flags"]
        index = spark.read.parquet(result.sinks[0].path)
        assert index.count() == counts["perimeter", "search"]
        assert "message" not in index.columns and "geo_src_ip" in index.columns
        archive = spark.read.json(result.sinks[1].path)
        assert archive.filter("key_tail = 'raw/kept'").count() == archive.count() > 0
        assert archive.inputFiles()[0].count("/h=") == 1
        store = spark.read.json(result.sinks[2].path)
        assert "geo_src_ip" not in store.columns and "threat_ip" in store.columns
        stats = result.stats("perimeter", V.CISCO_LOG).collect()
        assert sum(r["events_in"] for r in stats) == events.count()
        assert sum(r["rejected"] for r in stats) == result.rejects[V.CISCO_LOG].count()
        assert sum(r["kept"] for r in stats) == counts["perimeter", "search"]
    assert stage_folders(spark) == before
    assert result.rejects[V.CISCO_LOG].count() > 0  # in the output, not in a stage
    with pytest.raises(ValueError):
        run_batch(spec, raw, str(tmp_path), None, geo, run_id="two")
    with pytest.raises(ValueError):
        run_batch(spec, raw, str(tmp_path), threat, geo, run_id="two", deliver="somehow")
    assert stage_folders(spark) == before  # a run that fails leaves none either


def test_runs_add_and_a_repeated_run_replaces(spark, tmp_path, small):
    events, threat, geo = small
    spec = read_spec(changed(lambda i: i.__delitem__(slice(1, None))))
    raw = rendered(events, V.CISCO_LOG)
    counts = []
    for run_id, part in (("a", "offset < 300"), ("b", "offset >= 300"), ("b", "offset >= 300")):
        with run_batch(spec, {V.CISCO_LOG: raw.filter(part)}, str(tmp_path), threat, geo, run_id=run_id) as result:
            counts.append([s.events for s in result.sinks])
    for sink, first, second in zip(result.sinks, counts[0], counts[1]):
        rows = (spark.read.json if sink.type == "aws_s3" else spark.read.parquet)(sink.path)
        assert rows.count() == first + second
    assert counts[1] == counts[2] and {r.run_id for r in read_rejects(spark, str(tmp_path), V.CISCO_LOG).collect()} == {"a", "b"}


def test_reducing_reads_each_branch_from_its_own_folders(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    t = LOG_TYPES[V.ACCESS_LOG]
    staged = written(t.staged(rendered(events, t.name)), "test", partition_by=("route",))
    plan = t.reduced(staged)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(scans) == 2
    for line in scans:
        assert "route" in line.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "regexp_replace" not in plan


def test_parsing_evaluates_the_pattern_once(spark, lines):
    t = LOG_TYPES[V.ACCESS_LOG]
    df = t.staged(lines(["x"])).filter("reject_reason IS NULL AND route = 'dangerous'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_usual_triggers():
    from siftline.streaming.jobs import EVERY_SECOND, EVERY_TEN_SECONDS, usual_trigger

    assert {i.id: usual_trigger(i) for i in read_spec(RUN_SPEC).inputs} == {
        "perimeter": EVERY_TEN_SECONDS, "perimeter-flags": EVERY_TEN_SECONDS, "edge": EVERY_SECOND,
        "edge-errors": EVERY_TEN_SECONDS, "hosts": EVERY_TEN_SECONDS,
    }


def test_run_with_lookups_too_large_to_broadcast(spark, tmp_path, small):
    from siftline.operators import enrichment

    events, threat, geo = small
    huge = enrichment.GeoLookup(geo.levels, enrichment.BROADCAST_ROWS + 1)
    spec = read_spec(changed(lambda i: i.__delitem__(slice(1, None))))
    raw = {V.CISCO_LOG: rendered(events, V.CISCO_LOG)}
    some = run_batch(spec, raw, str(tmp_path / "a"), threat, geo, run_id="r").enriched["perimeter"]
    large = run_batch(spec, raw, str(tmp_path / "b"), threat, huge, run_id="r").enriched["perimeter"]
    columns = [c for c in some.columns if c != "extra"]
    assert some.count() == large.count()
    assert some.select(columns).exceptAll(large.select(columns)).count() == 0
