"""Times the headline jobs and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Log lines, BENCH_COPIES of each event, are rendered from the ``events`` table once, outside
the timing, into Parquet files with the raw topic columns; the jobs then read those files. Every
job runs twice: ``queries`` holds the second (warm) time, ``cold`` the first.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from siftline import fixed_values as V  # noqa: E402
from siftline.checks import inputs as I  # noqa: E402
from siftline.checks import queries as Q  # noqa: E402
from siftline.operators.changelog import changelog_table  # noqa: E402
from siftline.operators.enrichment import enrich  # noqa: E402
from siftline.operators.reduction import dedupe_gap  # noqa: E402
from siftline.plans.catalog import LOG_TYPES  # noqa: E402
from siftline.plans.runner import run_batch  # noqa: E402
from siftline.plans.spec import read_spec  # noqa: E402
from siftline.render import rendered  # noqa: E402
from siftline.session import fresh_path, local_session, written  # noqa: E402
from siftline.sources.raw import read_files  # noqa: E402
from siftline.streaming.jobs import ALL_NOW, start_parse, start_reduce  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "4"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = local_session(
        CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8,
        **{"spark.checkpoint.dir": f"{scratch}/shared"},
    )
    # several lines of each event, with ids of their own
    ids = I.table(spark, SF_DIR, "events").agg(F.max("event_id")).first()[0] + 1
    events = I.table(spark, SF_DIR, "events").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    ).withColumn("event_id", F.col("copy") * ids + F.col("event_id")).drop("copy")
    raw, lines, size = {}, {}, {}
    for name in LOG_TYPES:
        path = f"{scratch}/raw/{name}"
        rendered(events.repartitionByRange(16, "event_id"), name).write.parquet(path)
        raw[name] = spark.read.parquet(path)
        row = raw[name].agg(F.count("*"), F.sum(F.octet_length("value"))).first()
        lines[name], size[name] = row[0], row[1]
    threat, geo = I.lookups(spark, SF_DIR)
    parsed = {
        name: written(t.staged(raw[name]), f"bench-{name}", ("route",))
        for name, t in LOG_TYPES.items()
    }
    good = {name: df.filter("route <> 'reject'") for name, df in parsed.items()}
    access, cisco = LOG_TYPES[V.ACCESS_LOG], LOG_TYPES[V.CISCO_LOG]
    spec = read_spec(Q.RUN_SPEC)

    def stage_and_reduce():
        stage = written(access.staged(raw[V.ACCESS_LOG]), "bench-stage", ("route",))
        consume(access.reduced(stage))

    def whole_run():
        run_batch(spec, raw, fresh_path(spark, "bench-run"), threat, geo, run_id="bench").close()

    def stream():
        work, name = fresh_path(spark, "bench-stream"), V.ACCESS_LOG
        source = read_files(spark, f"{scratch}/raw/{name}", stream=True, max_files_per_trigger=8)
        start_parse(source, access, f"{work}/parsed/{name}", f"{work}/checkpoint", ALL_NOW).awaitTermination()
        start_reduce(spark, access, work, ALL_NOW).awaitTermination()

    jobs = {
        "stream_parse_reduce_access": stream,
        **{
            f"parse_{Q.SHORT[name]}": lambda t=t, name=name: consume(t.staged(raw[name]))
            for name, t in LOG_TYPES.items()
        },
        "parse_route_reduce_access": stage_and_reduce,
        "reduce_cisco": lambda: consume(cisco.reduced(parsed[V.CISCO_LOG])),
        "dedupe_gap_access": lambda: consume(dedupe_gap(
            good[V.ACCESS_LOG].drop("raw_value"), ("method", "url", "status"), 3_600
        )),
        "threat_cisco": lambda: consume(enrich(good[V.CISCO_LOG], threat)),
        "geo_cisco": lambda: consume(enrich(good[V.CISCO_LOG], geo=geo)),
        "threat_geo_access": lambda: consume(enrich(good[V.ACCESS_LOG], threat, geo)),
        "threat_geo_shuffled_cisco": lambda: consume(
            enrich(good[V.CISCO_LOG], threat, geo, broadcast_rows=0)
        ),
        "changelog_latest": lambda: consume(
            changelog_table(Q.changes(spark, SF_DIR), contains="c")
        ),
        "document_ips": lambda: consume(
            Q.text_ips(spark, SF_DIR, "documents", "doc_id", "text")
        ),
        "junk_lines": lambda: consume(Q.junk_lines(spark, SF_DIR)),
        "access_reduced_flagged": lambda: consume(Q.flagship(spark, SF_DIR)),
        "spec_run": whole_run,
    }
    cold, warm = {}, {}
    for name, job in jobs.items():
        for times in (cold, warm):
            start = time.perf_counter()
            job()
            times[name] = round(time.perf_counter() - start, 3)

    kept_lines = cisco.reduced(parsed[V.CISCO_LOG]).count()
    kept_bytes = cisco.reduced(parsed[V.CISCO_LOG]).agg(
        F.sum(F.octet_length("message"))
    ).first()[0]
    run_lines = sum(lines[i] for i in {i.log_type for i in spec.inputs})
    print(json.dumps({
        "metric": "total warm time of the headline jobs",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "lines": lines,
        "input_bytes": size,
        "lines_per_sec": {
            **{k: round(lines[n] / warm[f"parse_{k}"]) for n, k in Q.SHORT.items()},
            "spec_run": round(run_lines / warm["spec_run"]),
        },
        "cisco_lines_out_per_in": round(kept_lines / lines[V.CISCO_LOG], 4),
        "cisco_bytes_out_per_in": round(kept_bytes / size[V.CISCO_LOG], 4),
        "spark": pyspark.__version__,
        "python": platform.python_version(),
        "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()
