"""Threat flag and geographic enrichment of IPv4 columns.

Both lookups are keyed by the address as a number. A geographic network is
prepared as entries at three prefix levels (16, 24, 32 bits): a network becomes
at most 256 entries of the next level (one of under 8 bits up to 65,536, all that
the level can have), the longest network wins inside a level, and a hit at a
longer level wins over a shorter one. That is the
longest-prefix rule as plain equality joins on unique keys: no range scan of a
bucket, no window over the whole list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V
from siftline.functions.addresses import (
    DOTTED_QUAD,
    address_columns,
    address_maps,
    ipv4_number,
    is_ipv4,
)
from siftline.functions.captures import computed_once
from siftline.operators.reduction import POSITION
from siftline.session import written

LEVELS = (32, 24, 16)
# Largest lookup sent whole to every executor: five million entries of about
# 100 bytes stay near 500 MB. A larger one is joined by shuffling.
BROADCAST_ROWS = 5_000_000
GEO_TYPE = "struct<country:string,latitude:double,longitude:double>"


@dataclass(frozen=True)
class ThreatLookup:
    """Distinct listed addresses: ``number BIGINT``."""

    table: DataFrame
    rows: int


@dataclass(frozen=True)
class GeoLookup:
    """Per prefix level: ``prefix BIGINT, geo STRUCT``, prefix unique."""

    levels: dict[int, DataFrame]
    rows: int


def prepare_threat(threat: DataFrame) -> ThreatLookup:
    """Distinct IPv4 addresses of a list with a column ``ip``, written once per list version."""
    numbers = threat.select(ipv4_number(F.col("ip")).alias("number"))
    table = written(numbers.filter(F.col("number").isNotNull()).distinct(), "threat")
    return ThreatLookup(table, table.count())


def broadcastable(
    threat: ThreatLookup | None, geo: GeoLookup | None, broadcast_rows: int = BROADCAST_ROWS
) -> bool:
    """Whether both lookups are small enough to send to every executor."""
    return max(threat.rows if threat else 0, geo.rows if geo else 0) <= broadcast_rows


def _level(length: Column) -> Column:
    return F.when(length <= 16, 16).when(length <= 24, 24).otherwise(32)


def geo_entries(networks: DataFrame) -> DataFrame:
    """``(level, prefix, geo)`` from rows of network (CIDR text), country, latitude, longitude.

    Of equal networks the smallest (country, latitude, longitude) is taken. A bare
    address is a network of its own. A row whose network is no IPv4 CIDR gives nothing.
    """
    parts = F.col("parts")
    length = F.when(F.size(parts) == 1, 32).otherwise(F.get(parts, F.lit(1)).try_cast("int"))
    # each text is taken apart once, however often its numbers are used below
    sized = (
        networks.select(
            F.split("network", "/").alias("_parts"),
            F.struct(
                F.col("country").cast("string").alias("country"),
                F.col("latitude").cast("double").alias("latitude"),
                F.col("longitude").cast("double").alias("longitude"),
            ).alias("geo"),
        )
        .select("geo", computed_once(F.col("_parts")).alias("parts"))
        .select("geo", computed_once(F.struct(
            ipv4_number(parts[0]).alias("number"), length.alias("length"))).alias("net"))
        .select("geo", "net.number", "net.length")
        .filter(F.col("number").isNotNull() & F.col("length").between(0, 32))
        .withColumn("level", _level(F.col("length")))
    )
    networks = (
        sized.withColumn("network", F.expr("shiftright(number, 32 - length)"))
        .groupBy("level", "length", "network").agg(F.min("geo").alias("geo"))
    )
    size = F.expr("shiftleft(1L, level - length)")
    start = F.expr("shiftleft(network, level - length)")
    # expanded as numbers only: a place travels once for each entry that is left
    longest = (
        networks.select("level", "length", F.explode(F.sequence(start, start + size - 1)).alias("prefix"))
        .groupBy("level", "prefix").agg(F.max("length").alias("length"))
        .withColumn("network", F.expr("shiftright(prefix, level - length)"))
    )
    return longest.join(networks, ["level", "length", "network"]).select("level", "prefix", "geo")


def prepare_geo(networks: DataFrame) -> GeoLookup:
    """Writes the entries once per lookup version and counts them per level."""
    entries = written(geo_entries(networks), "geo", partition_by=("level",))
    counts = {r["level"]: r["count"] for r in entries.groupBy("level").count().collect()}
    levels = {
        level: entries.filter(F.col("level") == level).select("prefix", "geo")
        for level in LEVELS
        if counts.get(level)
    }
    return GeoLookup(levels, sum(counts.values()))


def _prefix(number: Column, level: int) -> Column:
    return F.shiftright(number, 32 - level)


def _geo_name(column: str) -> str:
    return f"geo_{column}"


def _lookup_threat(
    df: DataFrame, number: str, threat: ThreatLookup, hit: str, broadcast: bool = True
) -> DataFrame:
    table = threat.table.select(F.col("number").alias("_on_list"))
    return (
        df.join(F.broadcast(table) if broadcast else table, F.col(number) == F.col("_on_list"), "left")
        .withColumn(hit, F.col("_on_list").isNotNull())
        .drop("_on_list")
    )


def _lookup_geo(df: DataFrame, number: str, geo: GeoLookup, into: str, broadcast: bool) -> DataFrame:
    """Adds ``into``, the entry of the longest matching level or NULL.

    The short level has at most 65,536 entries and is always broadcast;
    ``broadcast`` says whether the long ones are.
    """
    found: list[str] = []
    for level, table in geo.levels.items():
        name = f"_geo{level}"
        side = table.select(
            F.col("prefix").alias(f"_prefix{level}"), F.col("geo").alias(name)
        )
        df = df.join(
            F.broadcast(side) if broadcast or level <= 16 else side,
            _prefix(F.col(number), level) == F.col(f"_prefix{level}"),
            "left",
        ).drop(f"_prefix{level}")
        found.append(name)
    if not found:
        return df.withColumn(into, F.lit(None).cast(GEO_TYPE))
    return df.withColumn(into, F.coalesce(*[F.col(c) for c in found])).drop(*found)


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*V.BROKER_METADATA)


def enrich(
    df: DataFrame,
    threat: ThreatLookup | None = None,
    geo: GeoLookup | None = None,
    columns: list[str] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    keep_metadata: bool = False,
) -> DataFrame:
    """Enriches by the lookups given: both, one or none; then drops broker metadata.

    ``threat_ip`` is one flag per row over all address columns and over the keys
    containing ``ip`` of map columns; ``geo_<column>`` is NULL unless the address hit,
    for a map column it is the map from key to place. Rows are never added or lost.
    """
    names = address_columns(df.schema) if columns is None else columns
    kept = [c for c in df.columns if c != "threat_ip" or threat is None]
    if geo is not None:
        looked_up = (*names, *(address_maps(df.schema) if columns is None else ()))
        kept = [c for c in kept if c not in {_geo_name(n) for n in looked_up}]
    df = df.select(*kept)
    if threat is None and geo is None:
        return df if keep_metadata else drop_metadata(df)

    maps = address_maps(df.schema) if columns is None else []
    if broadcastable(threat, geo, broadcast_rows):
        out = _enrich_small(df, names, maps, threat, geo)
    else:
        out = _enrich_large(df, names, maps, threat, geo)
    added: list[Column] = []
    if threat is not None:
        added.append(F.coalesce("_listed", F.lit(False)).alias("threat_ip"))
    if geo is not None:
        added += [F.col(f"_g_{n}").alias(_geo_name(n)) for n in (*names, *maps)]
    out = out.select(*kept, *added)
    return out if keep_metadata else drop_metadata(out)


def _position(df: DataFrame) -> list[str]:
    missing = [c for c in POSITION if c not in df.columns]
    if missing:
        raise ValueError(f"rows need their position to be looked up by shuffling: no {missing}")
    return list(POSITION)


def _map_entries(maps: list[str]) -> Column:
    """(slot, number) of the addresses under keys containing ``ip`` in the map columns."""
    def of(name: str) -> Column:
        entries = F.map_entries(F.coalesce(F.col(name), F.create_map().cast("map<string,string>")))
        addresses = F.filter(entries, lambda e: e["key"].contains("ip") & is_ipv4(e["value"]))
        return F.transform(addresses, lambda e: F.struct(
            F.concat(F.lit(f"{name}."), e["key"]).alias("slot"), ipv4_number(e["value"]).alias("number")
        ))

    return F.concat(*[of(m) for m in maps])


def _map_places(found: Column, name: str) -> Column:
    """Of the map ``slot -> place`` the part of one map column, by its own keys; NULL if empty."""
    own = F.map_filter(found, lambda slot, _: slot.startswith(f"{name}."))
    keys = F.transform(F.map_keys(own), lambda k: F.substring(k, len(name) + 2, 1 << 30))
    return F.when(F.size(own) > 0, F.map_from_arrays(keys, F.map_values(own)))


def _found(
    entries: DataFrame, by: list[str], threat: ThreatLookup | None, geo: GeoLookup | None,
    broadcast: bool, *more: Column,
) -> DataFrame:
    """Per ``by``: whether an address is listed, and the map from slot to place."""
    if threat is not None:
        entries = _lookup_threat(entries, "number", threat, "hit", broadcast)
    if geo is not None:
        entries = _lookup_geo(entries, "number", geo, "place", broadcast)
    hit = F.col("hit") if threat is not None else F.lit(False)
    place = F.col("place") if geo is not None else F.lit(None).cast(GEO_TYPE)
    placed = F.when(place.isNotNull(), F.struct(F.col("slot"), place.alias("place")))
    return entries.groupBy(*by).agg(
        F.max(hit).alias("_found_listed"),
        F.map_from_entries(F.collect_set(placed)).alias("_found_places"), *more,
    )


def _enrich_small(
    df: DataFrame, names: list[str], maps: list[str],
    threat: ThreatLookup | None, geo: GeoLookup | None,
) -> DataFrame:
    """Lookups sent to every executor: rows stay where they are.

    Only rows with addresses in a map are exploded and gathered again; with map columns the table is read twice, so give it a written one.
    """
    if maps:
        entries = _map_entries(maps)
        usual = df.filter(F.size(entries) == 0)
        exploded = df.filter(F.size(entries) > 0).select(
            F.monotonically_increasing_id().alias("_id"), F.struct("*").alias("_row"),
            F.explode(entries).alias("_entry"),
        ).select("*", "_entry.*").drop("_entry")
        found = _found(exploded, ["_id"], threat, geo, True, F.first("_row").alias("_row")).select(
            "_row.*", "_found_listed", "_found_places")
        df = usual.unionByName(found, allowMissingColumns=True)
    listed = F.coalesce("_found_listed", F.lit(False)) if maps else F.lit(False)
    for n in names:
        df = df.withColumn("_number", ipv4_number(F.col(n)))
        if threat is not None:
            df = _lookup_threat(df, "_number", threat, f"_t_{n}")
            listed = listed | F.col(f"_t_{n}")
        if geo is not None:
            df = _lookup_geo(df, "_number", geo, f"_g_{n}", broadcast=True)
    if geo is not None:
        df = df.withColumns({f"_g_{m}": _map_places(F.col("_found_places"), m) for m in maps})
    return df.withColumn("_listed", listed)


def _enrich_large(
    df: DataFrame, names: list[str], maps: list[str],
    threat: ThreatLookup | None, geo: GeoLookup | None,
) -> DataFrame:
    """Lookups too large to broadcast: narrow (position, slot, address) rows are looked up.

    What they hit is gathered by position and joined back: the rows themselves are
    shuffled once. A frequent address is split by the skew handling of the join.
    The rows are read twice: give it a written table.
    """
    position = _position(df)
    columns = F.array(*[
        F.struct(F.lit(n).alias("slot"), ipv4_number(F.col(n)).alias("number")) for n in names
    ]) if names else F.array().cast("array<struct<slot:string,number:bigint>>")
    slots = F.filter(columns, lambda e: e["number"].isNotNull())
    slots = F.concat(slots, _map_entries(maps)) if maps else slots
    entries = df.select(
        *[F.col(c).alias(f"_p_{c}") for c in position], F.explode(slots).alias("_entry")
    ).select("*", "_entry.*").drop("_entry")
    found = _found(entries, [f"_p_{c}" for c in position], threat, geo, False).filter(
        F.col("_found_listed") | (F.size("_found_places") > 0)
    )
    same = F.lit(True)
    for c in position:
        same &= F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    df = df.join(found, same, "left")
    if geo is not None:
        df = df.withColumns({
            **{f"_g_{n}": F.col("_found_places")[n] for n in names},
            **{f"_g_{m}": _map_places(F.col("_found_places"), m) for m in maps},
        })
    return df.withColumn("_listed", F.coalesce("_found_listed", F.lit(False)))


def text_addresses(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per IPv4 address in a free text, with its position among the matches."""
    return (
        df.select(
            *keep,
            F.posexplode(
                F.regexp_extract_all(F.col(text), F.lit(DOTTED_QUAD), F.lit(0))
            ).alias("position", "ip"),
        )
        .filter(is_ipv4(F.col("ip")))
    )
