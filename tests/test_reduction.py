"""Routing, sampling and deduplication against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.operators.reduction import (
    dedupe_first,
    dedupe_gap,
    hash_sample,
    reduce_events,
)
from siftline.operators.routing import (
    exclusive_route,
    matching_upper,
    only_log_type,
    shortest_words,
)
from siftline.plans.catalog import LOG_TYPES
from siftline.render import rendered
from siftline.session import written


def rows(spark, n=4000, hot=0.5, seed=1):
    """Keys with NULLs, one of them holding ``hot`` of the rows; equal times among them."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        k = "hot" if rng.random() < hot else rng.choice(["a", "b", None, "", "c"])
        j = None if rng.random() < 0.2 else rng.randint(1, 3)
        data.append((k, j, rng.randint(0, 20_000), "t", rng.randint(0, 2), i))
    df = spark.createDataFrame(
        data, "k string, j int, s long, topic string, partition int, offset long"
    )
    return data, df.withColumn("ingest_time", F.timestamp_seconds("s")).repartition(7)


def test_first_matching_route_wins_and_null_does_not_match(spark):
    df = spark.createDataFrame([(1, None), (2, True), (3, False)], "i int, b boolean")
    route = exclusive_route([("x", F.col("b")), ("y", F.col("i") > 2), ("z", F.lit(True))])
    assert [r[0] for r in df.orderBy("i").select(route).collect()] == ["z", "x", "y"]


def test_shorter_extensions_find_the_same_urls():
    short = shortest_words(V.STATIC_EXTENSIONS)
    assert len(V.STATIC_EXTENSIONS) == 33 and len(short) < 33
    for e in V.STATIC_EXTENSIONS:
        assert any(s in f"/x{e}y" for s in short)


def test_sample_is_a_function_of_the_key(spark):
    data, df = rows(spark)
    got = {r["offset"] for r in hash_sample(df).collect()}
    want = {
        o for (_, _, _, t, p, o) in data
        if int(hashlib.md5(f"{t}:{p}:{o}".encode()).hexdigest()[:8], 16) < 0.2 * 2**32
    }
    assert got == want and 0.17 < len(got) / len(data) < 0.23
    assert got == {r["offset"] for r in hash_sample(df.repartition(3)).collect()}


@pytest.mark.parametrize("ratio, share", [(0.0, 0), (1.0, 1)])
def test_sample_bounds(spark, ratio, share):
    data, df = rows(spark, 200)
    assert hash_sample(df, ratio).count() == share * len(data)


def test_sample_ratio_is_checked(spark):
    with pytest.raises(ValueError):
        hash_sample(rows(spark, 5)[1], 1.5)


def test_dedupe_first(spark):
    data, df = rows(spark)
    best = {}
    for k, j, s, t, p, o in data:
        if (k, j) not in best or (s, p, o) < best[k, j]:
            best[k, j] = (s, p, o)
    got = {r["offset"] for r in dedupe_first(df, ["k", "j"]).collect()}
    assert got == {b[2] for b in best.values()}


def test_dedupe_first_limits_before_the_shuffle(spark):
    plan = dedupe_first(rows(spark, 50)[1], ["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    above, below = physical.split("Exchange hashpartitioning(k", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


@pytest.mark.parametrize("gap, hot", [(1, 0.3), (7, 0.5), (60, 0.9), (3600, 0.9)])
def test_dedupe_gap(spark, gap, hot):
    data, df = rows(spark, hot=hot, seed=gap)
    want, last = set(), {}
    for k, j, s, t, p, o in sorted(data, key=lambda r: (r[2], r[4], r[5])):
        if (k, j) not in last or s - last[k, j] > gap:
            want.add(o)
        last[k, j] = s
    out = dedupe_gap(df, ["k", "j"], gap)
    assert out.columns == df.columns
    assert {r["offset"] for r in out.collect()} == want


def test_every_row_ends_in_exactly_one_place(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for name, log_type in LOG_TYPES.items():
        staged = written(log_type.staged(rendered(events, name)), "test", ("route",))
        by = {r["route"]: r["count"] for r in staged.groupBy("route").count().collect()}
        assert sum(by.values()) == events.count()
        kept = log_type.reduced(staged).select("route", "topic", "partition", "offset").cache()
        out = {r["route"]: r["count"] for r in kept.groupBy("route").count().collect()}
        assert kept.count() == kept.select("topic", "partition", "offset").distinct().count()
        assert out.get("dangerous", 0) == by.get("dangerous", 0)
        assert out["sample"] < by["sample"]
        assert out.get("dedupe", 0) <= by.get("dedupe", 0)
        assert "reject" not in out


def test_reduce_with_a_gap(spark):
    data, df = rows(spark, 500)
    routed = df.withColumn("route", F.lit("dedupe"))
    assert reduce_events(routed, ["k"], gap_seconds=30).count() == dedupe_gap(df, ["k"], 30).count()


def test_full_match_and_log_type_filter(spark):
    df = spark.createDataFrame([("a1",), ("b",), ("x\n1",), ("1\n",)], "value string")
    assert [r[0] for r in matching_upper(df).collect()] == ["A1"]
    df = spark.createDataFrame([("a",), (None,)], "log_type string")
    assert only_log_type(df, "a").count() == 1


def test_upper_case_keeps_the_number_of_letters(spark):
    texts = ["1 groß", "ŉ1ﬁx ᾳ ᾼ ǰ", "1ßß", "ß1é"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [r[0] for r in matching_upper(df).collect()]
    assert got == ["1 GROẞ", "ŉ1ﬁX ᾼ ᾼ ǰ", "1ẞẞ", "ẞ1É"]
