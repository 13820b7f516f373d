"""Event time in any session zone, flattening, projections, sinks and accounting."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline import fixed_values as V
from siftline.functions.times import (
    access_time,
    error_time,
    not_after,
    utc_clock,
    utc_minute,
    utc_text,
    window_time,
)
from siftline.operators.accounting import observed, received, reduction_stats
from siftline.operators.changelog import changelog_table
from siftline.operators.merging import merge_inputs
from siftline.operators.shaping import (
    INDEX_MAPPINGS,
    flattened,
    index_projection,
    olap_rows,
    with_event_time,
)
from siftline.plans.catalog import LOG_TYPES
from siftline.sinks.object_store import object_folder, split_prefix, write_object_store
from siftline.sinks.tables import write_index, write_indexes, write_olap
from siftline.sinks.topics import as_json, write_topic
from siftline.sources.raw import from_topic_json, kafka_options, read_files

LINE = '1.2.3.4 - - [{t}] "GET /check HTTP/1.1" 200 {b} "Mozilla/5.0" "-"'


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_event_times_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.sql(
        "SELECT '09/03/2025:09:30:00 +0700' a, '2025/03/09 09:30:00 ' e, '2025-03-09 02:30:00' w"
    )
    row = df.select(
        utc_clock(access_time(F.col("a"))).alias("a"),
        utc_clock(error_time(F.col("e"))).alias("e"),
        # a clock time New York skipped that day
        utc_clock(window_time(F.col("w"))).alias("w"),
        utc_text(window_time(F.col("w"))).alias("t"),
        utc_minute(access_time(F.col("a"))).alias("m"),
    ).first()
    want = dt.datetime(2025, 3, 9, 2, 30)
    assert (row["a"], row["e"], row["w"], row["m"]) == (want,) * 4
    assert row["t"] == "2025-03-09 02:30:00"


def test_text_that_is_no_time_gives_null(spark):
    df = spark.sql("SELECT 'x' a, '31/31/2025:10:00:00 +0700' b")
    assert df.select(access_time(F.col("a")), access_time(F.col("b"))).first() == (None, None)


def test_event_time_is_capped_at_arrival(spark):
    df = spark.sql(
        "SELECT TIMESTAMP'2025-01-02' late, TIMESTAMP'2025-01-01' now, CAST(NULL AS TIMESTAMP) n"
    )
    r = df.select(
        not_after(F.col("late"), F.col("now")), not_after(F.col("n"), F.col("now")),
        not_after(F.col("now"), F.col("late")),
    ).first()
    assert [x.day for x in r] == [1, 1, 1]


def test_flatten_nested(spark):
    df = spark.sql("SELECT 1 a, named_struct('b', 2, 'c', named_struct('d', 3)) s, array(1) l")
    assert flattened(df).columns == ["a", "s_b", "s_c_d", "l"]


def test_flatten_names_with_dots(spark):
    df = spark.sql("SELECT named_struct('x.y', 1) AS `p.q`")
    assert flattened(df).columns == ["p.q_x.y"]


@pytest.fixture(scope="module")
def access(lines):
    raw = lines([LINE.format(t=f"0{1 + i % 2}/05/2025:23:30:00 +0700", b=b)
                 for i, b in enumerate(["10", "20", "99999999999"])])
    parsed = LOG_TYPES[V.ACCESS_LOG].staged(raw).drop("reject_reason", "raw_value")
    geo = F.struct(F.lit("A").alias("country"), F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"))
    return parsed.withColumn("geo_ip", geo).withColumn("threat_ip", F.col("offset") == 1)


def test_index_projection_casts_and_leaves_out(access):
    out = index_projection(access, V.ACCESS_LOG)
    assert out.schema.names == INDEX_MAPPINGS[V.ACCESS_LOG].names
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["bytes"] == T.IntegerType() and types["status"] == T.StringType()
    assert types["geo_ip"]["latitude"].dataType == T.FloatType()
    assert [r["bytes"] for r in out.orderBy("message").collect()].count(None) == 1
    assert "message" not in index_projection(access, V.ACCESS_LOG, keep_message=False).columns


def test_index_projection_without_geo(access):
    out = index_projection(access.drop("geo_ip", "threat_ip"), V.ACCESS_LOG)
    assert out.first()["geo_ip"] is None


def test_olap_rows_skip_unknown_fields(access):
    out = olap_rows(access, V.ACCESS_LOG, ["ip", "geo_ip_country", "timestamp", "absent"])
    r = out.first()
    assert out.columns == ["ip", "geo_ip_country", "timestamp", "absent"]
    assert r["geo_ip_country"] == "A" and r["absent"] is None
    assert isinstance(r["timestamp"], dt.datetime)


def test_object_store_folders(spark, access, tmp_path):
    path = str(tmp_path / "out")
    write_object_store(with_event_time(access, V.ACCESS_LOG), path)
    files = glob.glob(f"{path}/year=2025/month=05/day=0*/log_type=access_log/*.json.gz")
    assert {f.split("day=")[1][:2] for f in files} == {"01", "02"}
    assert spark.read.json(path).count() == 3


def test_prefix_parts():
    p = split_prefix("raw/year=%Y/month=%m/day=%d/access_log/")
    assert (p.base, [d[0] for d in p.dates], p.tail) == ("raw", ["year", "month", "day"], "access_log")
    assert object_folder("s3a://b/", "raw/x=%Y") == "s3a://b/raw"
    with pytest.raises(ValueError):
        split_prefix("week=%W/")


def test_index_tables(spark, access, tmp_path):
    write_index(access, V.ACCESS_LOG, str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i")).count() == 3
    mixed = access.withColumn("log_type", F.when(F.col("offset") > 0, F.col("log_type")))
    write_indexes(mixed.select("log_type", "ip"), str(tmp_path / "m"))
    got = spark.read.parquet(str(tmp_path / "m")).groupBy("index").count().collect()
    assert {r["index"]: r["count"] for r in got} == {"access_log": 2, "default_log": 1}
    with pytest.raises(ValueError):
        write_index(access, V.ACCESS_LOG)


def test_olap_table_by_name(spark, access):
    write_olap(access, V.ACCESS_LOG, mode="overwrite")
    write_olap(access, V.ACCESS_LOG)
    assert spark.table("log_database.access_log").count() == 6


def test_topics(spark, access, tmp_path):
    rows = as_json(access.select("ip", "bytes"), key="ip")
    write_topic(rows, "enrich", path=str(tmp_path))
    back = from_topic_json(spark.read.parquet(str(tmp_path)), "ip string, bytes string")
    assert back.count() == 3 and back.first()["ip"] == "1.2.3.4"
    with pytest.raises(ValueError):
        write_topic(rows, "enrich")


def test_broker_options():
    o = kafka_options(["a", "b"], "broker:9092", stream=True, max_offsets_per_trigger=10)
    assert o["subscribe"] == "a,b" and o["groupIdPrefix"] == "a"
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "10"
    assert "endingOffsets" not in o
    assert kafka_options(["a"], "b", stream=False)["endingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_options([], "b", stream=True)


def test_several_topics_from_files(spark, lines, tmp_path):
    merge_inputs([lines(["a"], "t1"), lines(["b"], "t2"), lines(["c"], "t3")]).write.parquet(
        str(tmp_path / "raw")
    )
    got = read_files(spark, str(tmp_path / "raw"), ["t1", "t3"])
    assert {r["topic"] for r in got.collect()} == {"t1", "t3"}


def test_stats_add_up(access, lines):
    raw = lines(["junk", LINE.format(t="x", b="1"), LINE.format(t="01/05/2025:23:30:00 +0700", b="1")])
    t = LOG_TYPES[V.ACCESS_LOG]
    staged = t.staged(raw)
    stats = reduction_stats(staged, t.reduced(staged)).collect()
    assert sum(r["events_in"] for r in stats) == 3
    assert sum(r["rejected"] for r in stats) == 2
    assert sum(r["kept"] for r in stats) == 1
    assert received(raw).first()["events"] == 3


def test_observed_counts(spark, access, tmp_path):
    df, seen = observed(access, "accounting")
    df.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"events": 3, "threat_hits": 1}


def test_changelog_takes_the_latest_first(spark):
    data = [("a", "value1", 0), ("b", "other", 1), ("a", "nothing", 2), ("b", "value2", 3),
            ("c", "value3", 4), ("c", None, 5)]
    df = spark.createDataFrame(data, "key string, value string, offset long")
    assert [tuple(r) for r in changelog_table(df).collect()] == [("b", "VALUE2")]
