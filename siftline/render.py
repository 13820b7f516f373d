"""Turns rows of the ``events`` table into log lines: input for checks and the bench.

Each log type is a set of SQL expressions over ``event_id, ts, user_id, value``:
its fields, the line they are put into, and the reason it must be rejected for.
The expressions keep to functions Spark and DuckDB share, so a check can
compute the expected rows from the fields without reading a line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline import fixed_values as V

#: Sixteen addresses of the networks set apart for documentation: every other line has one, and the
#: threat list has them all.
THREAT_ADDRESSES = tuple(
    f"{('192.0.2', '198.51.100', '203.0.113')[i % 3]}.{9 + 15 * i}" for i in range(16)
)


def text(sql: str) -> str:
    return f"CAST({sql} AS STRING)"


def pick(words: str, index: str) -> str:
    """The ``index``-th (from 0) of words separated by ``|``."""
    return f"split_part('{words}', '|', CAST({index} AS INT) + 1)"


def half(sql: str) -> str:
    return f"CAST(floor(({sql}) / 2) AS BIGINT)"


CLOCK = text("ts")
DAY, MONTH, YEAR = f"substr({CLOCK}, 9, 2)", f"substr({CLOCK}, 6, 2)", f"substr({CLOCK}, 1, 4)"
TIME = f"substr({CLOCK}, 12, 8)"
MILLIS = f"rpad(split_part({CLOCK} || '.0', '.', 2), 3, '0')"
LISTED = "|".join(THREAT_ADDRESSES)
ADDRESS = (
    f"CASE WHEN event_id % 2 = 0 THEN {pick(LISTED, half('event_id') + ' % 16')} "
    f"ELSE {text('1 + user_id % 223')} || '.' || {text('event_id * 7 % 256')} || '.' || "
    f"{text('event_id * 13 % 256')} || '.' || {text('1 + event_id % 254')} END"
)
INSIDE = f"'192.168.' || {text('event_id % 256')} || '.' || {text('user_id % 256')}"
WHOLE_VALUE = "CAST(floor(value) AS BIGINT)"


@dataclass(frozen=True)
class Rendering:
    """Field expressions, the line over them, and the reject reason over the row."""

    fields: dict[str, str]
    line: str
    reject: str


ACCESS = Rendering(
    fields={
        "ip": ADDRESS,
        "timestamp": f"{DAY} || '/' || {MONTH} || '/' || {YEAR} || ':' || {TIME} || ' +0700'",
        "method": pick("GET|POST|PUT|DELETE|HEAD|OPTIONS|CHECK", "event_id % 7"),
        "url": pick(
            "/index.html|/login|/logout|/admin|/x.jsp|/api/v1/data|/search?q=test|/robots.txt"
            "|/a?f=.json|/café|/css/style.css|/img/logo.png|/register|/upload|/download/file.zip",
            "user_id % 15",
        ),
        "protocol": pick("HTTP/1.0|HTTP/1.1|HTTP/2.0", "event_id % 3"),
        "status": pick("200|301|403|404|500|201", "(event_id + user_id) % 6"),
        "bytes": text(f"100 + {WHOLE_VALUE}"),
        "user_agent": pick(
            "Mozilla/5.0 (Windows NT 10.0; Win64; x64)|curl/7.68.0|Mobile — Android 11",
            "(event_id + user_id) % 3",
        ),
        "refer": pick("-|https://example.com/article|http://spam.example", "event_id % 3"),
    },
    line=(
        "CASE WHEN event_id % 97 = 0 THEN 'broken ' || CAST(event_id AS STRING) ELSE "
        "CASE WHEN event_id % 31 = 0 THEN 'relay 7' || chr(10) ELSE '' END || "
        "ip || ' - - [' || timestamp || '] \"' || method || ' ' || url || ' ' || protocol || "
        "'\" ' || status || ' ' || bytes || ' \"' || user_agent || '\" \"' || refer || '\"' || "
        "CASE WHEN event_id % 29 = 0 THEN ' tail' ELSE '' END END"
    ),
    reject=(
        "CASE WHEN event_id % 193 = 0 THEN 'not_utf8' WHEN event_id % 97 = 0 THEN 'no_match' END"
    ),
)

ERROR = Rendering(
    fields={
        "timestamp": f"{YEAR} || '/' || {MONTH} || '/' || {DAY} || ' ' || {TIME} || ' '",
        "level": pick("warn|notice|error|crit|alert|info", "(event_id + user_id) % 6"),
        "pid": text("1000 + event_id % 8999"),
        "tid": text("event_id % 10"),
        "request_id": text("1 + user_id % 998"),
        "ip": f"{ADDRESS} || CASE WHEN event_id % 13 = 0 THEN ', server: _' ELSE '' END",
        "action": pick("open|read|list|flush|send|lookup|connect", "event_id % 7"),
        "file_path": pick(
            "/var/www/html/index.html|/favicon.ico|/etc/passwd|/tmp/shell.php|/données/db.sqlite",
            "user_id % 5",
        ),
        "errno": pick("2|13|21|30|32|40|110", "event_id % 7"),
        "error_message": "action || '()' || "
        + pick("|| on directory||| on| to", "event_id % 7")
        + " || ' \"' || file_path || '\" ' || "
        + "CASE WHEN event_id % 7 = 4 THEN 'aborted' ELSE 'failed' END || ' (' || errno || ': ' || "
        + pick(
            "No such file or directory|Permission denied|Is a directory|Read-only file system"
            "|Broken pipe|Symbolic link loop|Connection timed out", "event_id % 7",
        )
        + " || ')'",
    },
    line=(
        "CASE WHEN event_id % 97 = 0 THEN '[x] broken ' || CAST(event_id AS STRING) ELSE "
        "CASE WHEN event_id % 37 = 0 THEN 'shipper [' ELSE '' END || "
        "timestamp || '[' || level || '] ' || pid || '#' || tid || ': *' || request_id || ' ' || "
        "CASE WHEN event_id % 101 = 0 THEN 'accept() failed (24: Too many open files)' "
        "ELSE error_message END || ', client: ' || ip END"
    ),
    reject=(
        "CASE WHEN event_id % 193 = 0 THEN 'not_utf8' WHEN event_id % 97 = 0 THEN 'no_match' "
        "WHEN event_id % 101 = 0 THEN 'no_detail' END"
    ),
)

# kinds: 0 teardown, 1 denied, 2 nat, 3 icmp, 4 build, 5 debug, 6 unknown
_KIND = "event_id % 7"
_SEVERITY = pick("6|4|6|6|6|7|5", _KIND)
_MESSAGE_ID = pick("302014|106023|305011|302015|302013|710003|111111", _KIND)


def _when(kinds: tuple[int, ...], sql: str, extra: str = "") -> str:
    listed = ", ".join(str(k) for k in kinds)
    return f"CASE WHEN {_KIND} IN ({listed}){extra} THEN {sql} END"


CISCO = Rendering(
    fields={
        "severity": _SEVERITY,
        "message_id": _MESSAGE_ID,
        "message_text": _when((5,), "'TCP access permitted — ' || CAST(user_id AS STRING)"),
        "event_type": _when((0, 1, 2, 3, 4), pick(
            "connection_teardown|connection_denied|nat_translation|icmp_connection"
            "|connection_build", _KIND,
        )),
        "protocol": _when((0, 1, 2, 4), pick("TCP|UDP|ICMP", "event_id % 3")),
        "conn_id": _when((0, 4), text("10000 + event_id % 90000")),
        "src_zone": _when((0, 1, 2, 4), pick("inside|outside", "event_id % 2")),
        "src_ip": _when((0, 1, 2, 3, 4), f"({ADDRESS})"),
        "src_port": _when((0, 1, 2, 4), text("1 + event_id % 65534")),
        "dst_zone": _when((0, 1, 2, 4), pick("inside|outside", "user_id % 2")),
        "dst_ip": _when((0, 1, 2, 3, 4), INSIDE),
        "dst_port": _when((0, 1, 2, 4), text("1 + user_id % 65534")),
        "duration": _when((0,), f"'0:' || lpad({text('event_id % 60')}, 2, '0') || ':' || "
                                f"lpad({text('user_id % 60')}, 2, '0')"),
        "bytes": _when((0,), text(f"500 + {WHOLE_VALUE}")),
        "access_group": _when((1,), "'outside_access_in'"),
        "nat_ip": f"CASE WHEN {_KIND} = 3 OR ({_KIND} = 4 AND event_id % 2 = 0) "
                  f"THEN {pick(LISTED, 'user_id % 16')} END",
        "nat_port": _when((4,), text("1 + user_id % 1000"), " AND event_id % 2 = 0"),
    },
    line=(
        "CASE WHEN event_id % 97 = 0 THEN '%ASA-6-302013unknown' ELSE "
        "CASE WHEN event_id % 41 = 0 THEN 'fw1 ' ELSE '' END || "
        "'%ASA-' || severity || '-' || message_id || ': ' || "
        f"CASE WHEN {_KIND} = 0 AND event_id % 101 = 0 THEN 'Teardown TCP connection lost' "
        f"WHEN {_KIND} = 0 THEN 'Teardown ' || protocol || ' connection ' || conn_id || ' for ' || "
        "src_zone || ':' || src_ip || '/' || src_port || ' to ' || dst_zone || ':' || dst_ip || "
        "'/' || dst_port || ' duration ' || duration || ' bytes ' || bytes "
        f"WHEN {_KIND} = 1 THEN 'Deny ' || protocol || ' src ' || src_zone || ':' || src_ip || "
        "'/' || src_port || ' dst ' || dst_zone || ':' || dst_ip || '/' || dst_port || "
        "' by access-group \"' || access_group || '\"' "
        f"WHEN {_KIND} = 2 THEN 'Built dynamic ' || protocol || ' translation from ' || "
        "src_zone || ':' || src_ip || '/' || src_port || ' to ' || dst_zone || ':' || dst_ip || "
        "'/' || dst_port "
        f"WHEN {_KIND} = 3 THEN 'Built ICMP connection for faddr ' || dst_ip || '/0 gaddr ' || "
        "nat_ip || '/0 laddr ' || src_ip || '/0' "
        f"WHEN {_KIND} = 4 THEN 'Built ' || CASE WHEN event_id % 3 = 0 THEN 'inbound ' "
        "ELSE 'outbound ' END || protocol || ' connection ' || conn_id || ' for ' || src_zone || "
        "':' || src_ip || '/' || src_port || "
        "CASE WHEN nat_ip IS NULL THEN '' ELSE ' (' || nat_ip || '/' || nat_port || ')' END || "
        "' to ' || dst_zone || ':' || dst_ip || '/' || dst_port "
        f"WHEN {_KIND} = 5 THEN message_text ELSE 'Something else' END END"
    ),
    reject=(
        "CASE WHEN event_id % 193 = 0 THEN 'not_utf8' WHEN event_id % 97 = 0 THEN 'no_header' "
        f"WHEN {_KIND} = 0 AND event_id % 101 = 0 THEN 'no_detail' END"
    ),
)

# event ids by event_id % 4
_EVENT = "event_id % 4"


def _on(kinds: tuple[int, ...], sql: str) -> str:
    return f"CASE WHEN {_EVENT} IN ({', '.join(str(k) for k in kinds)}) THEN {sql} END"


WINDOW = Rendering(
    fields={
        "provider_name": "'Microsoft-Windows-Security-Auditing'",
        "win_event_id": pick("4624|4625|4634|4723", _EVENT),
        "level": "'0'",
        "time_created_system_time": f"{YEAR} || '-' || {MONTH} || '-' || {DAY} || ' ' || {TIME}",
        "event_record_id": text("100000 + event_id"),
        "channel": "'Security'",
        "computer": f"'host' || {text('user_id % 50')} || '.example'",
        "subject_user_sid": _on((0, 3), "'S-1-5-18'"),
        "subject_user_name": _on((0, 3), "'SYSTEM'"),
        "subject_domain_name": _on((3,), "'NT AUTHORITY'"),
        "target_user_name": f"'user' || {text('user_id')} || "
                            "CASE WHEN user_id % 10 = 0 THEN ' & co' ELSE '' END",
        "target_domain_name": "'WORKGROUP'",
        "logon_type": _on((0,), pick("2|3|10", "event_id % 3")),
        "logon_process_name": _on((0,), "'User32'"),
        "authentication_package_name": _on((0,), "'Negotiate'"),
        "workstation_name": _on((0,), f"'host' || {text('user_id % 50')} || '.example'"),
        "ip_address": _on((0, 1), f"({ADDRESS})"),
        "ip_port": _on((0, 1), text("1024 + event_id % 64511")),
        "process_name": _on((0,), "'winlogon.exe'"),
        "status": _on((1,), "'0xc000006a'"),
        "failure_reason": _on((1,), "'Unknown user name or bad password.'"),
        "logon_id": _on((2,), "'0x' || lower(hex(event_id))"),
        "extra_elevated": "CASE WHEN event_id % 13 = 0 THEN 'yes' END",
        "system_version": "CASE WHEN event_id % 3 = 0 THEN '2' END",
        "system_keywords": "CASE WHEN event_id % 3 = 0 THEN '0x8020000000000000' END",
        "system_process": f"CASE WHEN event_id % 3 = 0 THEN {text('500 + event_id % 90')} END",
        "system_guid": "CASE WHEN event_id % 5 = 0 THEN '{54849625-5478-4994}' END",
        "system_user": f"CASE WHEN event_id % 7 = 0 THEN 'S-1-5-' || {text('user_id')} END",
        "system_task": "CASE WHEN event_id % 3 = 0 THEN '12544' WHEN event_id % 11 = 0 THEN 'data task' END",
        "client_ip": f"CASE WHEN event_id % 19 = 0 THEN ({ADDRESS}) END",
    },
    line=(
        "CASE WHEN event_id % 97 = 0 THEN '<bad' ELSE "
        "'<Event xmlns=\"http://schemas.microsoft.com/win/2004/08/events/event\">' || chr(10) || "
        "CASE WHEN event_id % 103 = 0 THEN '' ELSE "
        "'  <System><Provider Name=\"' || provider_name || '\"' || CASE WHEN system_guid IS NULL THEN '' ELSE ' Guid=\"' || system_guid || '\"' END || '/><EventID>' || win_event_id || "
        "'</EventID>' || CASE WHEN event_id % 3 = 0 THEN '<Version>' || system_version || '</Version><Task>' || "
        "system_task || '</Task><Keywords>' || system_keywords || '</Keywords><Execution ProcessID=\"' || "
        "system_process || '\" ThreadID=\"8\"/>' ELSE '' END || "
        "CASE WHEN system_user IS NULL THEN '' ELSE '<Security UserID=\"' || system_user || '\"/>' END || "
        "'<Level>' || level || '</Level><TimeCreated SystemTime=\"' || "
        "CASE WHEN event_id % 107 = 0 THEN 'yesterday' ELSE "
        f"replace(time_created_system_time, ' ', 'T') || '.' || {MILLIS} || 'Z' END || "
        "'\"/><EventRecordID>' || event_record_id || '</EventRecordID><Channel>' || channel || "
        "'</Channel><Computer>' || computer || '</Computer></System>' END || chr(10) || "
        "CASE WHEN event_id % 101 = 0 THEN '' ELSE '<EventData>' || "
        + " || ".join(
            f"CASE WHEN {column} IS NULL THEN '' ELSE '<Data Name=\"{name}\">' || "
            f"replace({column}, '&', '&amp;') || '</Data>' END"
            for name, column in (
                ("SubjectUserSid", "subject_user_sid"),
                ("SubjectUserName", "subject_user_name"),
                ("SubjectDomainName", "subject_domain_name"),
                ("TargetUserName", "target_user_name"),
                ("TargetDomainName", "target_domain_name"),
                ("LogonType", "logon_type"),
                ("LogonProcessName", "logon_process_name"),
                ("AuthenticationPackageName", "authentication_package_name"),
                ("WorkstationName", "workstation_name"),
                ("IpAddress", "ip_address"),
                ("IpPort", "ip_port"),
                ("ProcessName", "process_name"),
                ("Status", "status"),
                ("FailureReason", "failure_reason"),
                ("LogonID", "logon_id"),
            )
        )
        + " || CASE WHEN event_id % 13 = 0 THEN '<Data Name=\"ExtraElevated\">no</Data>"
        "<Data Name=\"ExtraElevated\">yes</Data>' ELSE '' END || "
        "CASE WHEN event_id % 17 = 0 THEN '<Data Name=\"Computer\">other</Data>' ELSE '' END || "
        "CASE WHEN event_id % 11 = 0 THEN '<Data Name=\"Task\">data task</Data>' ELSE '' END || "
        "CASE WHEN client_ip IS NULL THEN '' ELSE '<Data Name=\"ClientIpAddress\">' || client_ip || '</Data>' END || "
        "'</EventData>' END || chr(10) || '</Event>' END"
    ),
    reject=(
        "CASE WHEN event_id % 193 = 0 THEN 'not_utf8' WHEN event_id % 97 = 0 THEN 'bad_xml' "
        "WHEN event_id % 103 = 0 THEN 'no_system' WHEN event_id % 101 = 0 THEN 'no_data' "
        "WHEN event_id % 107 = 0 THEN 'bad_time' END"
    ),
)

API = Rendering(
    fields={
        "timestamp": f"{YEAR} || '-' || {MONTH} || '-' || {DAY} || ' ' || {TIME} || '.' || "
                     f"{MILLIS} || ' +0700'",
        "method": pick("GET|POST|PUT|DELETE", "event_id % 4"),
        "endpoint": f"'/api/users/' || {text('user_id')}",
        "status_code": f"CAST({pick('200|301|403|404|500|422', '(event_id + user_id) % 6')} AS INT)",
        "response_time": f"CAST(100 + {WHOLE_VALUE} AS INT)",
        "ip": ADDRESS,
        "user_agent": "'curl/7.68.0'",
        "session_id": f"'s' || {text('event_id')}",
        "user_id_text": f"'u' || {text('user_id')}",
        "trace_id": f"'t' || {text('event_id * 31')}",
        "app_name": pick("auth-service|payment-service|gateway-api", "event_id % 3"),
        "env": pick("production|staging|qa", "user_id % 3"),
        "level": "CASE WHEN status_code >= 500 THEN 'ERROR' WHEN status_code >= 400 THEN 'WARN' "
                 "ELSE 'INFO' END",
    },
    line=(
        "CASE WHEN event_id % 97 = 0 THEN '{\"timestamp\": broken' ELSE "
        "'{\"timestamp\":\"' || timestamp || '\"' || "
        "CASE WHEN event_id % 5 = 0 THEN '' ELSE ',\"level\":\"' || level || '\"' END || "
        "',\"method\":\"' || method || '\",\"endpoint\":\"' || endpoint || '\",\"statusCode\":' || "
        f"{text('status_code')} || ',\"responseTime\":' || {text('response_time')} || "
        "',\"ip\":\"' || ip || '\",\"userAgent\":\"' || user_agent || '\",\"sessionId\":\"' || "
        "session_id || '\",\"userId\":\"' || user_id_text || '\",\"traceId\":\"' || trace_id || "
        "'\",\"appName\":\"' || app_name || '\",\"env\":\"' || env || '\"}' END"
    ),
    reject=(
        "CASE WHEN event_id % 193 = 0 THEN 'not_utf8' WHEN event_id % 97 = 0 THEN 'bad_json' END"
    ),
)

RENDERINGS = {
    V.ACCESS_LOG: ACCESS,
    V.ERROR_LOG: ERROR,
    V.CISCO_LOG: CISCO,
    V.WINDOW_LOG: WINDOW,
    V.API_LOG: API,
}
# fields computed from other fields
_LATER = ("error_message", "level")


def _later(rendering: Rendering) -> dict[str, str]:
    return {
        n: s for n, s in rendering.fields.items()
        if n in _LATER and ("action ||" in s or "status_code" in s)
    }


def fields_sql(log_type: str, table: str = "events") -> str:
    """SQL for the fields, the line and the reject reason; runs on DuckDB and on Spark."""
    r = RENDERINGS[log_type]
    later = _later(r)
    first = ", ".join(f"{s} AS {n}" for n, s in r.fields.items() if n not in later)
    second = "".join(f", {s} AS {n}" for n, s in later.items())
    return (
        f"SELECT *, {r.line} AS message, {r.reject} AS reject FROM ("
        f"SELECT *{second} FROM ("
        f"SELECT event_id, ts, user_id, value, {first} FROM {table}) a) b"
    )


def _instant(clock: str) -> Column:
    return F.expr(f"CAST(CAST({clock} AS STRING) || 'Z' AS TIMESTAMP)")


def rendered(events: DataFrame, log_type: str) -> DataFrame:
    """Raw rows of one log type: one line per event, some broken, some not UTF-8."""
    r = RENDERINGS[log_type]
    later = _later(r)
    df = events.select(
        "event_id", "ts", "user_id", "value",
        *[F.expr(s).alias(n) for n, s in r.fields.items() if n not in later],
    ).select("*", *[F.expr(s).alias(n) for n, s in later.items()])
    line = F.expr(r.line).cast("binary")
    return df.select(
        F.when(F.col("event_id") % 193 == 0, F.concat(line, F.expr("X'C328'")))
        .otherwise(line).alias("value"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(log_type).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        _instant("ts").alias("timestamp"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
