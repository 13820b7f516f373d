import random

import pytest
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.operators.reduction import LAST, dedupe_gap, remembered
from siftline.plans.ledger import Ledger
from siftline.plans.runner import read_rejects, run_batch
from siftline.plans.spec import read_spec
from siftline.render import rendered
from siftline.session import folder_names

GAP = 100
KEYS = ("a", "b")


def events(spark, rng, n, keys):
    rows = [(rng.choice(keys), rng.choice([None, "x"]), "t", 0, k, 1_700_000_000 + at)
            for k, at in enumerate(sorted(rng.randrange(20 * n) for _ in range(n)))]
    df = spark.createDataFrame(rows, "a string, b string, topic string, partition int, offset bigint, at bigint")
    return df.withColumn("ingest_time", F.timestamp_seconds("at")).drop("at")


def offsets(df):
    return sorted(r.offset for r in df.collect())


@pytest.mark.parametrize("parts", [2, 5, 40])
def test_dedupe_in_parts_equals_dedupe_of_all(spark, parts):
    rng = random.Random(parts)
    df = events(spark, rng, 400, ["k", "l", "m", None, *map(str, range(12))])
    kept, seen = [], None
    for k in range(min(parts, 8)):
        step = -(-400 // min(parts, 8))
        own = df.filter(F.col("offset").between(k * step, (k + 1) * step - 1))
        kept += offsets(dedupe_gap(own, KEYS, GAP, seen=seen))
        rows = remembered(own, KEYS, GAP, seen).collect()
        seen = spark.createDataFrame(rows, "a string, b string, last_micros bigint")
        newest = max(r[LAST] for r in rows)
        assert all(newest - r[LAST] <= GAP * 1_000_000 for r in rows)  # no more than the keys of one gap
    assert sorted(kept) == offsets(dedupe_gap(df, KEYS, GAP))


def test_rows_at_and_around_what_was_seen(spark):
    def df(*times):
        rows = [("k", "x", "t", 0, i, t) for i, t in enumerate(times)]
        return spark.createDataFrame(rows, "a string, b string, topic string, partition int, offset bigint, at bigint") \
            .withColumn("ingest_time", F.timestamp_seconds("at")).drop("at")

    seen = remembered(df(1000, 1050), KEYS, GAP)
    assert [tuple(r) for r in seen.collect()] == [("k", "x", 1_050_000_000)]
    assert offsets(dedupe_gap(df(1150), KEYS, GAP, seen=seen)) == []  # no more than the gap after
    assert offsets(dedupe_gap(df(1151), KEYS, GAP, seen=seen)) == [0]
    assert offsets(dedupe_gap(df(1010), KEYS, GAP, seen=seen)) == []  # late, beside what was seen
    assert offsets(dedupe_gap(df(1090, 1180, 1300), KEYS, GAP, seen=seen)) == [2]
    nothing = remembered(df(1).limit(0), KEYS, GAP)
    assert nothing.count() == 0 and offsets(dedupe_gap(df(7), KEYS, GAP, seen=nothing)) == [0]
    assert remembered(df(1).limit(0), KEYS, GAP, seen).count() == 1


SPEC = {"id": "s", "inputs": [{"id": "edge", "log_type": "access_log", "sinks": [
    {"id": "table", "type": "clickhouse", "config": {"endpoint": "http://olap.example:8123"}}]}]}


@pytest.fixture(scope="module")
def raw(spark):
    return rendered(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), V.ACCESS_LOG).cache()


def sink_rows(spark, out):
    return sorted((r.run_id, r.message) for r in
                  spark.read.parquet(f"{out}/clickhouse/input_id=edge/table/{V.OLAP_DATABASE}/access_log").collect())


def test_runs_read_what_earlier_ones_did_not(spark, raw, tmp_path):
    spec, out, ledger = read_spec(SPEC), str(tmp_path / "out"), Ledger(spark, str(tmp_path / "ledger"))

    def run(run_id, upto, **options):
        run_batch(spec, {V.ACCESS_LOG: raw.filter(F.col("offset") < upto)}, out, gap_seconds=GAP, run_id=run_id, ledger=ledger, **options).close()
        return ledger.commits()[-1]

    first = run("a", 300)
    assert (first.number, first.run_id) == (0, "a")
    with pytest.raises(ValueError):
        run("b-2", 600, deliver="nowhere")
    assert ledger.commits() == [first]  # a run that fails is not committed
    second = run("b-2", 600)
    assert (second.number, second.run_id) == (1, "b-2")
    positions = ledger.positions(second)[V.ACCESS_LOG]
    assert positions == {(r.topic, r.partition): r.n for r in raw.filter("offset < 600").groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("n")).collect()}
    before = sink_rows(spark, out)
    assert run("b-2", 1000) == second and sink_rows(spark, out) == before  # repeated: the rows it had, no others
    third = run("c", 1000)
    rejected = read_rejects(spark, out, V.ACCESS_LOG).groupBy("run_id").count().collect()
    whole = str(tmp_path / "whole")
    run_batch(spec, {V.ACCESS_LOG: raw.filter("offset < 1000")}, whole, gap_seconds=GAP, run_id="a").close()
    assert sorted(r[1] for r in sink_rows(spark, out)) == sorted(r[1] for r in sink_rows(spark, whole))
    assert sum(r["count"] for r in rejected) == read_rejects(spark, whole, V.ACCESS_LOG).count()
    # the memory of the last two runs stays, so only the last run can be repeated
    assert sorted(folder_names(spark, f"{ledger.path}/seen")) == [second.name, third.name]
    run("c", 2000)
    run("d", 2000)
    with pytest.raises(ValueError, match="only the last run"):
        run("b-2", 600)


def test_positions_of_new_partitions_and_other_log_types(spark, raw, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    two = read_spec({"inputs": [*SPEC["inputs"], {"id": "fw", "log_type": "cisco_log", "sinks": []}]})
    cisco = rendered(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), V.CISCO_LOG).filter("offset < 50")
    run_batch(two, {V.ACCESS_LOG: raw.filter("partition < 2 AND offset < 100"), V.CISCO_LOG: cisco}, str(tmp_path / "o"),
              gap_seconds=GAP, run_id="a", ledger=ledger).close()
    run = ledger.open("b")
    topic = raw.first().topic
    unread = run.unread(raw.filter("offset < 100"), V.ACCESS_LOG)
    assert {r.partition for r in unread.collect()} == {2, 3}
    known = run.start[V.ACCESS_LOG][topic, 0]
    assert run.starting_offsets(V.ACCESS_LOG, {topic: [0, 3]}) == f'{{"{topic}": {{"0": {known}, "3": -2}}}}'
    # a run without an input of a type keeps that type's positions and memory
    run_batch(read_spec(SPEC), {V.ACCESS_LOG: raw.filter("offset < 100")}, str(tmp_path / "o"), gap_seconds=GAP, run_id="b", ledger=ledger).close()
    assert ledger.positions(ledger.commits()[-1])[V.CISCO_LOG] == run.start[V.CISCO_LOG]
    assert set(folder_names(spark, f"{ledger.path}/seen/{ledger.commits()[-1].name}")) == {V.ACCESS_LOG, V.CISCO_LOG}


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_beyond_the_positions_are_dealt_to_all_tasks(spark, raw, tmp_path):
    # two runs' files, one after the other: the second run's rows lie in one of them
    path, ledger = str(tmp_path / "topic"), Ledger(spark, str(tmp_path / "ledger"))
    own = raw.filter("offset < 1000")
    own.filter("offset < 900").coalesce(1).write.parquet(path)
    assert len(rows_by_task(ledger.open("a").unread(spark.read.parquet(path), V.ACCESS_LOG))) == 1  # nothing read yet: as they lie
    run_batch(read_spec(SPEC), {V.ACCESS_LOG: spark.read.parquet(path)}, str(tmp_path / "o"), run_id="a", ledger=ledger).close()
    own.filter("offset >= 900").coalesce(1).write.mode("append").parquet(path)
    grown = spark.read.parquet(path)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # the rows of a test would fit one task
    try:
        rest = ledger.open("b").unread(grown, V.ACCESS_LOG)
        again = ledger.open("a").unread(grown, V.ACCESS_LOG)
        assert len(rows_by_task(rest)) > 1 and len(rows_by_task(again)) > 1
    finally:
        spark.conf.unset(coalesce)
    assert offsets(rest) == list(range(900, 1000)) and offsets(again) == list(range(900))
