"""Threat flags and places against plain Python, both for small and large lookups."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siftline.functions.addresses import address_columns, ipv4_number, is_ipv4
from siftline.operators.enrichment import (
    enrich,
    geo_entries,
    prepare_geo,
    prepare_threat,
    text_addresses,
)
from siftline.sources.lookups import GEO_SCHEMA, read_geo_networks, read_threat_csv

META = "topic string, partition int, offset long"


def test_is_ipv4_and_number(spark):
    texts = ["1.2.3.4", "255.255.255.255", "0.0.0.0", "256.1.1.1", "1.2.3", "1.2.3.4.", "01.2.3.4",
             "1.2.3.4\n", " 1.2.3.4", "1.2.3.4, server", "", None, "::1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(is_ipv4(F.col("t")).alias("ok"), ipv4_number(F.col("t")).alias("n")).collect()
    for t, r in zip(texts, got):
        good = t in ("1.2.3.4", "255.255.255.255", "0.0.0.0")
        assert r["ok"] == good
        assert r["n"] == (int(ipaddress.ip_address(t)) if good else None)


def test_address_columns(spark):
    df = spark.createDataFrame(
        [], "ip string, src_ip string, zip int, ip_port string, threat_ip string, geo_ip string, x string"
    )
    assert address_columns(df.schema) == ["ip", "src_ip", "ip_port"]


def networks(n=400, seed=3):
    rng = random.Random(seed)
    out = [("0.0.0.0/1", "half", 0.0, 0.0), ("1.0.0.0/8", None, 1.5, 2.5), ("1.2.3.4/32", "one", 1.0, 1.0),
           ("1.2.0.0/16", "sixteen", 0.0, 0.0), ("1.2.3.0/24", "twentyfour", 0.0, 0.0),
           ("1.2.0.0/16", "again", 0.0, 0.0), ("bad", "x", 0.0, 0.0), ("1.2.3.4/33", "x", 0.0, 0.0),
           ("9.9.9.9", "no length", 0.0, 0.0)]
    for i in range(n):
        length = rng.randint(2, 32)
        base = f"1.{rng.randint(0, 5)}.{rng.randint(0, 5)}.{rng.randint(0, 255)}"
        out.append((f"{base}/{length}", f"c{i}", float(i), float(-i)))
    return out


def place(address, nets):
    best = None
    for net, country, lat, lon in nets:
        if "/" not in net or int(net.split("/")[1]) > 32:
            continue
        n = ipaddress.ip_network(net, strict=False)
        if ipaddress.ip_address(address) in n:
            key = (-n.prefixlen, country is not None, country or "", lat, lon)
            if best is None or key < best[0]:
                best = (key, (country, lat, lon))
    return best and best[1]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)

    def address():
        if rng.random() < 0.4:
            return "1.2.3.4"  # one address holds a large part of the rows
        return rng.choice([
            f"1.{rng.randint(0, 6)}.{rng.randint(0, 6)}.{rng.randint(0, 255)}",
            f"200.{rng.randint(0, 255)}.1.1", None, "not one", "1.2.3.400",
        ])

    data = [(address(), address(), f"10.0.0.{i % 5}", "t", i % 3, i) for i in range(1500)]
    events = spark.createDataFrame(data, f"src_ip string, dst_ip string, note string, {META}")
    listed = ["1.2.3.4", "1.2.3.4", "200.1.1.1", "1.0.0.7", "x", None]
    nets = networks()
    threat = spark.createDataFrame([(t,) for t in listed], "ip string")
    geo = spark.createDataFrame(nets, GEO_SCHEMA)
    return data, events, set(listed) - {None}, nets, prepare_threat(threat), prepare_geo(geo)


@pytest.mark.parametrize("limit", [10**6, 0], ids=["broadcast", "shuffled"])
def test_enrich_matches_plain_lookup(tables, limit):
    data, events, listed, nets, threat, geo = tables
    out = enrich(events, threat, geo, broadcast_rows=limit, keep_metadata=True)
    assert out.columns == [*events.columns, "threat_ip", "geo_src_ip", "geo_dst_ip"]
    rows = {r["offset"]: r for r in out.collect()}
    assert len(rows) == len(data) == out.count()

    def looked_up(a):
        try:
            ipaddress.IPv4Address(a)
        except ValueError:
            return None
        return place(a, nets)

    for src, dst, _, _, _, o in data:
        r = rows[o]
        assert r["threat_ip"] == (src in listed or dst in listed)
        for c, a in (("geo_src_ip", src), ("geo_dst_ip", dst)):
            assert (tuple(r[c]) if r[c] else None) == looked_up(a)


def test_prefix_entries_are_unique_and_bounded(spark):
    nets = networks()
    entries = geo_entries(spark.createDataFrame(nets, GEO_SCHEMA))
    rows = entries.collect()
    assert len({(r["level"], r["prefix"]) for r in rows}) == len(rows)
    assert len(rows) <= 256 * len(nets)


def test_enriching_twice_changes_nothing(tables):
    _, events, _, _, threat, geo = tables
    once = enrich(events, threat, geo, keep_metadata=True)
    twice = enrich(once, threat, geo, keep_metadata=True)
    assert sorted(once.columns) == sorted(twice.columns)
    assert once.exceptAll(twice.select(once.columns)).count() == 0


def test_modes_and_metadata(tables):
    _, events, _, _, threat, geo = tables
    base = ["src_ip", "dst_ip", "note"]
    assert enrich(events).columns == base
    assert enrich(events, threat).columns == [*base, "threat_ip"]
    assert enrich(events, geo=geo).columns == [*base, "geo_src_ip", "geo_dst_ip"]


def test_no_address_column_is_no_threat(spark, tables):
    threat = tables[4]
    df = spark.createDataFrame([("a",)], "x string")
    assert enrich(df, threat).first()["threat_ip"] is False


def test_small_lookups_are_broadcast_and_large_ones_are_not(tables):
    _, events, _, _, threat, geo = tables
    text = enrich(events, threat, geo)._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 8 and "SortMergeJoin" not in text


def test_text_addresses(spark):
    df = spark.createDataFrame(
        [(1, "from 1.2.3.4 to 300.1.1.1, 5.6.7.8."), (2, "none"), (3, None)], "id int, t string"
    )
    rows = [tuple(r) for r in text_addresses(df, "t", ["id"]).collect()]
    assert rows == [(1, 0, "1.2.3.4"), (1, 2, "5.6.7.8")]


def test_lookup_files(spark, tmp_path):
    (tmp_path / "threat.csv").write_text("ip,seen\n1.2.3.4,x\n5.6.7.8,y\n")
    assert read_threat_csv(spark, str(tmp_path / "threat.csv")).count() == 2
    (tmp_path / "geo.csv").write_text("network,country,latitude,longitude\n1.0.0.0/8,A,1.5,\n")
    row = read_geo_networks(spark, str(tmp_path / "geo.csv")).first()
    assert tuple(row) == ("1.0.0.0/8", "A", 1.5, None)


def test_networks_are_expanded_without_their_places(spark):
    nets = [(f"10.{i}.0.0/9", "x", 1.0, 2.0) for i in range(3)]
    plan = geo_entries(spark.createDataFrame(nets, GEO_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    by_prefix = [line for line in plan.splitlines() if "Aggregate(keys=[level" in line or "Aggregate(key=[level" in line]
    expanded = [line for line in by_prefix if "prefix" in line.split("functions")[0]]
    assert expanded and not [line for line in expanded if "SortAggregate" in line or "geo" in line]


@pytest.mark.parametrize("name", ["geo_window", "threat_flag_window", "geo_large_access", "geo_large_cisco"])
def test_rows_that_are_looked_up_twice_are_parsed_once(spark, name):
    """Lookups of addresses in a map and lookups by shuffling read their rows twice: written ones, not lines."""
    rows = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert not [f for f in rows.inputFiles() if f.endswith("/events.parquet")]
