"""DuckDB SQL with the same result as each registered query.

The SQL works from the fields a line is rendered from, never from the line, so
a wrong parse shows as a difference.
"""

from __future__ import annotations

from siftline import fixed_values as V
from siftline.checks.inputs import NETWORKS, PIPELINE_TYPES, SUPPLIER_ADDRESS
from siftline.checks.queries import (
    ADDRESSES,
    CISCO_KINDS,
    DETAIL_FIELDS,
    MAP_ADDRESSES,
    RESUMED_GAP,
    SHORT,
    WINDOW_EVENTS,
    WINDOW_EXTRA,
)
from siftline.functions.names import snake_name
from siftline.operators.parse_api_json import API_FIELDS
from siftline.render import THREAT_ADDRESSES, fields_sql

SAMPLED = "substr(md5('{t}:' || (event_id % 4) || ':' || event_id), 1, 8) < '33333334'"
MINUTE = "date_trunc('minute', ts)"


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


ROUTES = {
    V.ACCESS_LOG: (
        "CASE WHEN " + " OR ".join(f"contains(url, '{e}')" for e in V.STATIC_EXTENSIONS)
        + " THEN 'sample' WHEN "
        + " OR ".join(f"contains(method, '{m}')" for m in V.WRITE_METHODS)
        + " OR CAST(status AS INT) >= 400 THEN 'dangerous' ELSE 'dedupe' END"
    ),
    V.ERROR_LOG: (
        f"CASE WHEN level IN ({_quoted(V.IMPORTANT_LEVELS)}) THEN 'dangerous' ELSE 'sample' END"
    ),
    V.CISCO_LOG: (
        "CASE WHEN severity = '7' THEN 'sample' WHEN event_type IN "
        f"({_quoted(V.CISCO_DANGEROUS_EVENTS)}) THEN 'dangerous' ELSE 'dedupe' END"
    ),
    V.WINDOW_LOG: (
        "CASE WHEN win_event_id = '4634' THEN 'sample' "
        "WHEN win_event_id IN ('4625', '4723') THEN 'dangerous' ELSE 'dedupe' END"
    ),
}


def _field(log_type: str, name: str) -> str:
    return "win_event_id AS event_id" if (log_type, name) == (V.WINDOW_LOG, "event_id") else name


def _fields(log_type: str, names) -> str:
    return ", ".join(_field(log_type, n) for n in names)


def _rows(log_type: str) -> str:
    """Fields and route of the events that parse."""
    return (
        f"(SELECT *, {ROUTES[log_type]} AS route FROM ({fields_sql(log_type)}) r "
        "WHERE reject IS NULL)"
    )


def _kept(log_type: str, where: str = "true") -> str:
    keys = ", ".join(V.DEDUPE_KEYS[log_type])
    sampled = SAMPLED.format(t=log_type)
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route, {keys} "
        f"ORDER BY ts, event_id % 4, event_id) AS rn FROM {_rows(log_type)} x WHERE {where}) y "
        f"WHERE route = 'dangerous' OR (route = 'sample' AND {sampled}) "
        "OR (route = 'dedupe' AND rn = 1))"
    )


def _kept_by_gap(log_type: str, seconds: int) -> str:
    """The rows that one run with dedupe by gap keeps."""
    keys = ", ".join(V.DEDUPE_KEYS[log_type])
    return (
        f"SELECT * FROM (SELECT *, lag(ts) OVER (PARTITION BY route, {keys} "
        f"ORDER BY ts, event_id % 4, event_id) AS before FROM {_rows(log_type)} x) y "
        f"WHERE route = 'dangerous' OR (route = 'sample' AND {SAMPLED.format(t=log_type)}) "
        f"OR (route = 'dedupe' AND (before IS NULL OR ts - before > INTERVAL {seconds} SECOND))"
    )


# ---- lookups -----------------------------------------------------------------
LISTED = (
    f"(SELECT unnest([{_quoted(THREAT_ADDRESSES)}]) AS ip "
    f"UNION SELECT {SUPPLIER_ADDRESS} FROM supplier)"
)


def _number(ip: str) -> str:
    parts = [f"CAST(split_part({ip}, '.', {i + 1}) AS BIGINT) * {1 << (24 - 8 * i)}" for i in range(4)]
    return "(" + " + ".join(parts) + ")"


_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _ipv4(ip: str) -> str:
    return f"regexp_full_match({ip}, '{_OCTET}(\\.{_OCTET}){{3}}')"


_CIDRS = " UNION ALL ".join(
    f"SELECT {network} AS network, {country} AS country, {latitude} AS latitude, "
    f"{longitude} AS longitude FROM {name}"
    for name, network, country, latitude, longitude in NETWORKS
)
RANGES = (
    "(SELECT len, country, latitude, longitude, "
    "(n >> (32 - len)) << (32 - len) AS lo, "
    "((n >> (32 - len)) << (32 - len)) + (CAST(1 AS BIGINT) << (32 - len)) - 1 AS hi "
    f"FROM (SELECT *, {_number(chr(97))} AS n FROM (SELECT *, split_part(network, '/', 1) AS a, "
    f"CAST(split_part(network, '/', 2) AS BIGINT) AS len FROM ({_CIDRS}) c) d) e)"
)


def _places(ips: str) -> str:
    """``ip`` with the place of its longest network, for those that lie in one."""
    return (
        "(SELECT ip, country, latitude, longitude FROM (SELECT ip, r.country, r.latitude, "
        "r.longitude, row_number() OVER (PARTITION BY ip ORDER BY len DESC, r.country NULLS FIRST, "
        "r.latitude, r.longitude) AS rn "
        f"FROM (SELECT ip, CASE WHEN {_ipv4('ip')} THEN {_number('ip')} END AS n "
        f"FROM (SELECT DISTINCT ip FROM ({ips}) i) j WHERE {_ipv4('ip')}) k "
        f"JOIN {RANGES} r ON k.n BETWEEN r.lo AND r.hi) m WHERE rn = 1)"
    )


def _addresses(log_type: str) -> tuple[str, ...]:
    return ADDRESSES[log_type] + MAP_ADDRESSES.get(log_type, ())


def _flag(names) -> str:
    return " OR ".join(f"coalesce({n} IN (SELECT ip FROM listed), false)" for n in names)


def _geo_query(log_type: str, before: str, flag: bool) -> str:
    names = _addresses(log_type)
    ips = " UNION ".join(f"SELECT {n} AS ip FROM f" for n in names)
    columns, joins = [], []
    for i, n in enumerate(names):
        joins.append(f"LEFT JOIN places p{i} ON f.{n} = p{i}.ip")
        columns += [
            f"p{i}.ip IS NOT NULL AS geo_{n}_hit", f"p{i}.country AS geo_{n}_country",
            f"p{i}.latitude AS geo_{n}_latitude", f"p{i}.longitude AS geo_{n}_longitude",
        ]
    if flag:
        columns.insert(0, f"({_flag([f'f.{n}' for n in names])}) AS threat_ip")
    return (
        f"WITH listed AS {LISTED}, f AS {_rows(log_type)}, places AS {_places(ips)} "
        f"SELECT {before}, {', '.join(columns)} FROM f {' '.join(joins)}"
    )


def _text_query(table: str, key: str, text: str) -> str:
    return (
        f"WITH listed AS {LISTED}, f AS (SELECT {key}, unnest(range(len(a))) AS position, "
        f"unnest(a) AS ip FROM (SELECT {key}, list_filter(regexp_extract_all({text}, "
        "'[0-9]+(?:\\.[0-9]+)*'), lambda x: regexp_full_match(x, '[0-9]{1,3}(?:\\.[0-9]{1,3}){3}')) AS a "
        "FROM " + table + ") t), "
        f"places AS {_places('SELECT ip FROM f')} "
        f"SELECT f.{key}, CAST(position AS INT) AS position, f.ip, ({_flag(['f.ip'])}) AS threat_ip, "
        "p.ip IS NOT NULL AS geo_ip_hit, p.country AS geo_ip_country, "
        "p.latitude AS geo_ip_latitude, p.longitude AS geo_ip_longitude "
        f"FROM f LEFT JOIN places p ON f.ip = p.ip WHERE {_ipv4('f.ip')}"
    )


# ---- per query ---------------------------------------------------------------
LOCAL_CLOCK = "date_trunc('second', ts) - INTERVAL 7 HOUR"
EVENT_TIMES = {
    V.ACCESS_LOG: LOCAL_CLOCK,
    V.ERROR_LOG: LOCAL_CLOCK,
    V.CISCO_LOG: "ts",
    V.WINDOW_LOG: "date_trunc('second', ts)",
}


def _parse(log_type: str, where: str = "true") -> str:
    extra = "".join(f", {n}" for n in WINDOW_EXTRA) if log_type == V.WINDOW_LOG else ""
    return (
        f"SELECT event_id AS pos, {_fields(log_type, DETAIL_FIELDS[log_type])}{extra} "
        f"FROM {_rows(log_type)} x WHERE {where}"
    )


def _bytes() -> str:
    return "strlen(message) + CASE WHEN event_id % 193 = 0 THEN 2 ELSE 0 END"


def _reject(log_type: str) -> str:
    return (
        f"SELECT event_id AS pos, '{log_type}' AS log_type, reject AS reason, "
        f"CAST({_bytes()} AS INT) AS value_bytes "
        f"FROM ({fields_sql(log_type)}) r WHERE reject IS NOT NULL"
    )


def _gap(log_type: str, keys, seconds: int) -> str:
    by = ", ".join(keys)
    return (
        f"SELECT event_id AS pos, {by} FROM (SELECT *, lag(ts) OVER (PARTITION BY {by} "
        f"ORDER BY ts, event_id % 4, event_id) AS before FROM {_rows(log_type)} x) y "
        f"WHERE before IS NULL OR ts - before > INTERVAL {seconds} SECOND"
    )


def _junk() -> str:
    reasons = {
        V.ACCESS_LOG: "no_match", V.ERROR_LOG: "no_match", V.CISCO_LOG: "no_header",
        V.WINDOW_LOG: "bad_xml",
    }
    texts = (
        "SELECT 'document' AS origin, doc_id AS id, text FROM documents "
        "UNION ALL SELECT 'page', page_id, html FROM pages"
    )
    return " UNION ALL ".join(
        f"SELECT origin, id, '{t}' AS log_type, '{r}' AS reason, "
        f"CAST(strlen(text) AS INT) AS value_bytes FROM ({texts}) x"
        for t, r in reasons.items()
    )


def _merged() -> str:
    has = {
        V.ACCESS_LOG: ("NULL", "ip", "NULL", "NULL"),
        V.ERROR_LOG: ("level", "ip", "NULL", "NULL"),
        V.CISCO_LOG: ("NULL", "NULL", "src_ip", "NULL"),
        V.WINDOW_LOG: ("level", "NULL", "NULL", "ip_address"),
    }
    names = ("level", "ip", "src_ip", "ip_address")
    return " UNION ALL ".join(
        f"SELECT event_id AS pos, '{t}' AS log_type, route, "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {n}" for c, n in zip(cs, names))
        + f" FROM {_kept(t)} k"
        for t, cs in has.items()
    )


def _modes() -> str:
    t = V.ACCESS_LOG
    places = f"places AS {_places('SELECT ip FROM f')}"
    parts = []
    for mode, flag, geo in (
        ("both", True, True), ("geo", False, True), ("threat", True, False), ("none", False, False),
    ):
        threat = f"CAST(({_flag(['f.ip'])}) AS VARCHAR)" if flag else "'not asked'"
        country = "p.country" if geo else "'not asked'"
        parts.append(
            f"SELECT event_id AS pos, '{mode}' AS mode, {threat} AS threat, "
            f"{country} AS country FROM f LEFT JOIN places p ON f.ip = p.ip"
        )
    return f"WITH listed AS {LISTED}, f AS {_rows(t)}, {places} " + " UNION ALL ".join(parts)


def _enriched(log_type: str, select: str) -> str:
    return (
        f"WITH listed AS {LISTED}, f AS {_rows(log_type)}, "
        f"places AS {_places('SELECT ip FROM f')} "
        f"SELECT {select} FROM f LEFT JOIN places p ON f.ip = p.ip"
    )


def _place(ip: str) -> str:
    return f"(SELECT country FROM places p WHERE p.ip = k.{ip})"


def _sink_rows(inputs, kept, columns=("a", "b", "c", "flag", "place")) -> str:
    """Rows of (input, sink, log type, a, b, c, flag, place); ``kept`` gives a log type's rows."""
    ips = " UNION ".join(f"SELECT {ip} AS ip FROM ({kept(t)}) k" for t, ip in (
        (V.CISCO_LOG, "src_ip"), (V.ACCESS_LOG, "ip"), (V.ERROR_LOG, "ip")))
    parts = []
    for input_id, sink_id, t, a, b, c, flag, place in inputs:
        values = dict(a=a, b=b, c=f"CAST({c} AS VARCHAR)",
                      flag=f"({_flag(_addresses(t))})" if flag else "CAST(NULL AS BOOLEAN)",
                      place=_place(place) if place else "CAST(NULL AS VARCHAR)")
        parts.append(
            f"SELECT '{input_id}' AS input_id, '{sink_id}' AS sink_id, "
            + ", ".join(f"{values[n]} AS {n}" for n in columns) + f" FROM ({kept(t)}) k"
        )
    return f"WITH listed AS {LISTED}, places AS {_places(ips)} " + " UNION ALL ".join(parts)


_RUN_SINKS = (
    ("perimeter", "search", V.CISCO_LOG, "src_ip", "event_type", "dst_ip", True, "src_ip"),
    ("perimeter", "archive", V.CISCO_LOG, "src_ip", "event_type", "dst_ip", True, "src_ip"),
    ("perimeter-flags", "flags", V.CISCO_LOG, "src_ip", "event_type", "dst_ip", True, None),
    ("edge", "analytics", V.ACCESS_LOG, "ip", "url", "status", False, "ip"),
    ("edge-errors", "search", V.ERROR_LOG, "ip", "level", "errno", True, "ip"),
    ("hosts", "archive", V.WINDOW_LOG, "computer", "win_event_id", "target_user_name", True, None),
)
_STREAM_SINKS = (
    ("perimeter", "search", V.CISCO_LOG, "src_ip", "event_type", "dst_ip", False, "src_ip"),
    ("perimeter", "archive", V.CISCO_LOG, "src_ip", "event_type", "dst_ip", False, "src_ip"),
    ("edge", "analytics", V.ACCESS_LOG, "ip", "url", "status", True, "ip"),
)


def _kept_halves(log_type: str) -> str:
    """The rows that a run over the even events and one over the odd ones keep."""
    return " UNION ALL ".join(
        f"SELECT * FROM {_kept(log_type, f'event_id % 2 = {half}')} k{half}" for half in (0, 1)
    )


def _stats() -> str:
    parts = []
    for t in PIPELINE_TYPES:
        all_rows = (
            f"(SELECT *, CASE WHEN reject IS NOT NULL THEN 'reject' ELSE {ROUTES[t]} END AS route "
            f"FROM ({fields_sql(t)}) r)"
        )
        parts.append(
            f"SELECT '{t}' AS log_type, route, {MINUTE} AS minute, count(*) AS events_in, "
            "count(*) FILTER (WHERE reject IS NOT NULL) AS rejected, 0 AS kept, 0 AS threat_hits "
            f"FROM {all_rows} a GROUP BY ALL"
        )
        parts.append(
            f"SELECT '{t}', route, {MINUTE} AS minute, 0, 0, count(*), "
            f"count(*) FILTER (WHERE {_flag(_addresses(t))}) FROM {_kept(t)} k GROUP BY ALL"
        )
    measures = ("events_in", "rejected", "kept", "threat_hits")
    sums = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in measures)
    return (
        f"WITH listed AS {LISTED} SELECT log_type, route, minute, {sums} "
        f"FROM ({' UNION ALL '.join(parts)}) u GROUP BY log_type, route, minute"
    )


def _received() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS topic, {MINUTE} AS minute, count(*) AS events, "
        f"CAST(sum({_bytes()}) AS BIGINT) AS bytes FROM ({fields_sql(t)}) r GROUP BY ALL"
        for t in PIPELINE_TYPES
    )


def _changelog() -> str:
    return (
        "SELECT key, upper(value) AS value FROM (SELECT CAST(user_id AS VARCHAR) AS key, "
        "CASE WHEN event_id % 11 <> 0 THEN event_type END AS value, row_number() OVER "
        "(PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) x "
        "WHERE rn = 1 AND contains(value, 'c')"
    )


def _stream_parse(log_type: str) -> str:
    """Typed columns are NULL on a reject, and its route is ``reject``."""
    names = DETAIL_FIELDS[log_type]
    columns = ", ".join(
        f"CASE WHEN reject IS NULL THEN {'win_event_id' if (log_type, n) == (V.WINDOW_LOG, 'event_id') else n} END AS {n}"
        for n in names
    )
    return (
        f"SELECT event_id AS pos, CASE WHEN reject IS NULL THEN {ROUTES[log_type]} "
        f"ELSE 'reject' END AS route, reject AS reject_reason, {columns} "
        f"FROM ({fields_sql(log_type)}) r"
    )


def _stream_reduced(log_type: str) -> str:
    keys = ", ".join(V.DEDUPE_KEYS[log_type])
    return (
        f"SELECT CASE WHEN route <> 'dedupe' THEN event_id ELSE -1 END AS pos, route, {keys} "
        f"FROM {_kept(log_type)} k"
    )


def registered() -> dict[str, str]:
    out = {
        "access_reduced_flagged": (
            f"WITH listed AS {LISTED} SELECT event_id AS pos, route, "
            f"{', '.join(V.ACCESS_FIELDS)}, ({_flag(['ip'])}) AS threat_ip "
            f"FROM {_kept(V.ACCESS_LOG)} k"
        ),
    }
    for t, short in SHORT.items():
        out[f"{short}_parse"] = _parse(t)
        out[f"{short}_reject"] = _reject(t)
        out[f"event_time_{short}"] = (
            f"SELECT event_id AS pos, {EVENT_TIMES[t]} AS event_time FROM {_rows(t)} x"
        )
        out[f"route_{short}"] = f"SELECT event_id AS pos, route FROM {_rows(t)} x"
        out[f"sample_{short}"] = (
            f"SELECT event_id AS pos FROM {_rows(t)} x "
            f"WHERE route = 'sample' AND {SAMPLED.format(t=t)}"
        )
        out[f"reduced_{short}"] = f"SELECT event_id AS pos, route FROM {_kept(t)} k"
        out[f"threat_flag_{short}"] = (
            f"WITH listed AS {LISTED} SELECT event_id AS pos, ({_flag(_addresses(t))}) AS threat_ip "
            f"FROM {_rows(t)} x"
        )
        out[f"geo_{short}"] = _geo_query(t, "event_id AS pos", flag=False)
        out[f"stream_parse_{short}"] = _stream_parse(t)
    for kind in CISCO_KINDS:
        out[f"cisco_parse_{kind}"] = _parse(V.CISCO_LOG, f"event_type = '{kind}'")
    out["cisco_parse_debug"] = _parse(V.CISCO_LOG, "severity = '7'")
    out["cisco_parse_unknown"] = _parse(V.CISCO_LOG, "event_type IS NULL AND severity <> '7'")
    for event in WINDOW_EVENTS:
        out[f"window_parse_{event}"] = _parse(V.WINDOW_LOG, f"win_event_id = '{event}'")
    names = [snake_name(f) for f in API_FIELDS]
    api = ", ".join("user_id_text AS user_id" if n == "user_id" else n for n in names)
    out["api_json_parse"] = (
        f"SELECT event_id AS pos, {api}, date_trunc('millisecond', ts) - INTERVAL 7 HOUR "
        f"AS event_time FROM ({fields_sql(V.API_LOG)}) r WHERE reject IS NULL"
    )
    out["junk_lines"] = _junk()
    for t in (V.ACCESS_LOG, V.CISCO_LOG, V.WINDOW_LOG):
        keys = ", ".join(V.DEDUPE_KEYS[t])
        out[f"dedupe_first_{SHORT[t]}"] = (
            f"SELECT event_id AS pos, {keys} FROM {_kept(t)} k WHERE route = 'dedupe'"
        )
    out["dedupe_gap_access"] = _gap(V.ACCESS_LOG, ("method", "url"), 36_000)
    out["dedupe_gap_cisco"] = _gap(V.CISCO_LOG, ("severity", "event_type"), 600)
    out["geo_large_cisco"] = _geo_query(V.CISCO_LOG, "event_id AS pos", flag=True)
    out["geo_large_window"] = _geo_query(V.WINDOW_LOG, "event_id AS pos", flag=True)
    out["geo_large_access"] = _geo_query(V.ACCESS_LOG, "event_id AS pos", flag=True)
    out["merged_inputs"] = _merged()
    out["per_log_type"] = " UNION ALL ".join(
        f"SELECT '{t}' AS sink, count(*) AS events, max(event_id) AS last_pos FROM {_rows(t)} x"
        for t in PIPELINE_TYPES
    )
    out["enrich_modes"] = _modes()
    out["document_ips_enriched"] = _text_query("documents", "doc_id", "text")
    out["page_ips_enriched"] = _text_query("pages", "page_id", "html")
    access = ", ".join("f.ip" if f == "ip" else f for f in V.ACCESS_FIELDS)
    threat = f"({_flag(['f.ip'])}) AS threat_ip"
    out["flatten_rows"] = _enriched(
        V.ACCESS_LOG,
        f"event_id AS pos, {access}, {threat}, p.country AS geo_ip_country, "
        "p.latitude AS geo_ip_latitude, p.longitude AS geo_ip_longitude",
    )
    floats = (
        "p.country AS geo_ip_country, CAST(p.latitude AS FLOAT) AS geo_ip_latitude, "
        "CAST(p.longitude AS FLOAT) AS geo_ip_longitude"
    )
    out["index_access"] = _enriched(
        V.ACCESS_LOG,
        f"CAST(bytes AS INT) AS bytes, {floats}, f.ip, 'access_log' AS log_type, method, protocol, "
        f"refer, status, {threat}, {LOCAL_CLOCK} AS timestamp, url, user_agent",
    )
    out["index_error"] = _enriched(
        V.ERROR_LOG,
        f"action, CAST(errno AS INT) AS errno, error_message, file_path, {floats}, f.ip, level, "
        f"'error_log' AS log_type, pid, request_id, {threat}, tid, {LOCAL_CLOCK} AS timestamp",
    )
    out["olap_rows"] = _enriched(
        V.ERROR_LOG,
        f"'error_log' AS log_type, {LOCAL_CLOCK} AS timestamp, level, pid, f.ip, errno, file_path, "
        f"p.country AS geo_ip_country, {threat}, '-' AS not_sent",
    )
    day = LOCAL_CLOCK
    out["object_store_roundtrip"] = _enriched(
        V.ACCESS_LOG,
        f"event_id AS pos, f.ip, method, url, status, {threat}, p.country AS country, "
        f"strftime({day}, '%Y') AS year, strftime({day}, '%m') AS month, "
        f"strftime({day}, '%d') AS day, 'access_log' AS log_type",
    )
    out["index_roundtrip"] = (
        "SELECT index_name, count(*) AS documents, CAST(sum(event_id) AS BIGINT) AS pos_sum FROM ("
        + " UNION ALL ".join(
            f"SELECT CASE WHEN event_id % 50 <> 1 THEN '{t}' ELSE 'default_log' END AS index_name, "
            f"event_id FROM {_rows(t)} x"
            for t in PIPELINE_TYPES
        )
        + ") u GROUP BY index_name"
    )
    out["topic_roundtrip"] = (
        f"SELECT event_id AS pos, event_type, src_ip, dst_ip FROM {_rows(V.CISCO_LOG)} x"
    )
    whole = lambda t: f"SELECT * FROM {_kept(t)} k0"
    out["spec_run"] = _sink_rows(_RUN_SINKS, whole)
    out["spec_two_runs"] = _sink_rows(_RUN_SINKS, _kept_halves)
    out["spec_resumed_runs"] = _sink_rows(_RUN_SINKS, lambda t: _kept_by_gap(t, RESUMED_GAP))
    out["stream_spec_run"] = _sink_rows(_STREAM_SINKS, whole, ("a", "b", "flag", "place"))
    out["stream_large_lookup"] = out["stream_spec_run"]
    out["stream_accounts"] = (
        f"SELECT input_id, sink_id, CAST(count(*) AS BIGINT) AS events FROM ({out['stream_spec_run']}) r GROUP BY ALL"
    )
    out["spec_rejects"] = " UNION ALL ".join(
        f"SELECT *, CASE WHEN pos % 2 = 0 THEN 'half-0' ELSE 'half-1' END AS run_id FROM ({_reject(t)}) r"
        for t in (V.ACCESS_LOG, V.WINDOW_LOG)
    )
    out["listed_files"] = (
        f"WITH s AS (SELECT s_suppkey, {SUPPLIER_ADDRESS} AS ip, 'S' || s_suppkey AS country FROM supplier), "
        "f AS (SELECT *, split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.' || "
        "split_part(ip, '.', 3) || '.0' AS other FROM s) "
        "SELECT s_suppkey AS pos, true OR other = '' AS threat_ip, "
        "(SELECT min(country) FROM s WHERE s.ip = f.ip) AS country, "
        "(SELECT min(country) FROM s WHERE s.ip = f.other) AS other_country FROM f"
    )
    out["offset_range"] = (
        f"SELECT event_id AS pos, '{V.CISCO_LOG}' AS topic, CAST(event_id % 4 AS INT) AS partition, "
        f"CAST({_bytes()} AS INT) AS value_bytes FROM ({fields_sql(V.CISCO_LOG)}) r "
        "WHERE event_id BETWEEN 100 AND 699"
    )
    out["two_topics"] = (
        "SELECT event_id AS pos, 'a_access_log' AS topic, method, status FROM (SELECT *, row_number() "
        "OVER (PARTITION BY method, status ORDER BY ts, event_id % 4, event_id) AS rn "
        f"FROM {_rows(V.ACCESS_LOG)} x) y WHERE rn = 1"
    )
    out["stream_dedupe_late"] = (
        f"SELECT DISTINCT {', '.join(V.DEDUPE_KEYS[V.ACCESS_LOG])}, true AS kept "
        f"FROM {_rows(V.ACCESS_LOG)} x WHERE route = 'dedupe'"
    )
    out["stream_topic"] = out["topic_roundtrip"]
    out["reduction_stats"] = _stats()
    out["bytes_received"] = _received()
    out["metric_filter"] = (
        "SELECT topic, minute, 'component_received_event_bytes_total' AS name, bytes AS counter "
        f"FROM ({_received()}) r"
    )
    out["changelog_latest"] = _changelog()
    out["stream_changelog"] = _changelog()
    out["stream_changelog_topic"] = _changelog()
    out["full_match_upper"] = (
        "SELECT origin, id, md5(upper(value)) AS value FROM ("
        "SELECT 'customer' AS origin, c_custkey AS id, c_name AS value FROM customer UNION ALL "
        "SELECT 'document', doc_id, text FROM documents UNION ALL "
        "SELECT 'nation', n_nationkey, n_name FROM nation) x "
        "WHERE len(string_split(value, chr(10))) = 1 AND regexp_matches(value, '[0-9]')"
    )
    out["stream_reduced_access"] = _stream_reduced(V.ACCESS_LOG)
    out["stream_reduced_cisco"] = _stream_reduced(V.CISCO_LOG)
    out["stream_restart"] = out["stream_reduced_cisco"]
    out["stream_event_counts"] = (
        f"SELECT 'access_log' AS log_type, route, date_trunc('minute', {LOCAL_CLOCK}) AS minute, "
        f"count(*) AS events FROM {_rows(V.ACCESS_LOG)} x GROUP BY ALL"
    )
    return out
