"""Parsers on single lines: captures, first match, rejects, and lines made to be slow."""

import time

import pytest

from siftline import fixed_values as V
from siftline.functions.names import snake_name
from siftline.operators.decoding import accepted, rejects
from siftline.operators.parse_access import parse_access
from siftline.operators.parse_api_json import parse_api_json
from siftline.operators.parse_cisco import parse_cisco
from siftline.operators.parse_error import parse_error
from siftline.operators.parse_windows import parse_windows
from siftline.plans.catalog import LOG_TYPES

ACCESS = '192.168.1.10 - - [25/05/2025:10:00:00 +0700] "{m} {u} HTTP/1.1" {s} 1234 "{a}" "{r}"'


def access(m="GET", u="/check", s=200, a="Mozilla/5.0", r="https://google.com"):
    return ACCESS.format(m=m, u=u, s=s, a=a, r=r)


def windows(event_id, data, system=True, time="2025-06-05T18:15:47.354Z", tail=""):
    names = "".join(
        f'<Data Name="{n}">{v}</Data>' if v is not None else f'<Data Name="{n}"/>'
        for n, v in data
    )
    head = (
        "  <System>\n    <Provider Name=\"Microsoft-Windows-Security-Auditing\"/>\n"
        f"    <EventID>{event_id}</EventID><Level>0</Level><TimeCreated SystemTime=\"{time}\"/>"
        "<EventRecordID>660934</EventRecordID><Channel>Security</Channel>"
        "<Computer>mcglynn.co</Computer>\n  </System>\n"
        if system else ""
    )
    body = f"  <EventData>{names}</EventData>\n" if data is not None and data != [] else ""
    return (
        '<Event xmlns="http://schemas.microsoft.com/win/2004/08/events/event">\n'
        f"{head}{body}</Event>{tail}"
    )


def one(df, lines, text):
    rows = df(lines([text])).collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("log_type, line, route", [
    (V.ACCESS_LOG, access(u="/assets/logo.png"), "sample"),
    (V.ACCESS_LOG, access(m="PUT", s=500), "dangerous"),
    (V.ACCESS_LOG, access(), "dedupe"),
    (V.ACCESS_LOG, access(u="/img/logo.png", s=500), "sample"),
    (V.ACCESS_LOG, access(u="/x.jsp"), "sample"),
    (V.ACCESS_LOG, access(u="/a.JS"), "dedupe"),
    (V.ACCESS_LOG, access(m="XPOSTX"), "dangerous"),
    (V.ACCESS_LOG, access(s=399), "dedupe"),
    (V.ACCESS_LOG, access(s=400), "dangerous"),
    (V.ACCESS_LOG, access(m="PUT", s="99999999999999999999"), "dedupe"),
    (V.ACCESS_LOG, "junk", "reject"),
    (V.ERROR_LOG, '2025/05/31 11:00:44 [notice] 7020#3: *109 open() "/favicon.ico" failed '
                  '(2: No such file or directory), client: 176.149.195.55', "sample"),
    (V.ERROR_LOG, '2025/05/30 17:20:39 [crit] 2767#9: *266 flush() "/opt/app/laravel.log" failed '
                  '(30: Read-only file system), client: 59.64.27.146', "dangerous"),
    (V.ERROR_LOG, '2025/05/30 17:20:39 [error] 2767#9: *266 connect() to "/etc/passwd" failed '
                  '(110: Connection timed out), client: 59.64.27.146', "dangerous"),
    (V.ERROR_LOG, '2025/05/30 17:20:39 [warn] 2767#9: *266 open() on directory "/favicon.ico" '
                  'failed (21: Is a directory), client: 1.1.1.1', "sample"),
    (V.CISCO_LOG, "%ASA-7-110002: No route to host", "sample"),
    (V.CISCO_LOG, "%ASA-6-302014: Teardown TCP connection 20534 for outside:18.242.207.157/16708 "
                  "to inside:192.168.234.151/57829 duration 0:04:29 bytes 1594", "dangerous"),
    (V.CISCO_LOG, "%ASA-6-305011: Built dynamic UDP translation from outside:231.88.244.11/43315 "
                  "to outside:208.218.171.35/57317", "dedupe"),
    (V.CISCO_LOG, '%ASA-4-106023: Deny TCP src outside:1.2.3.4/10 dst inside:9.9.9.9/443 '
                  'by access-group "outside_access_in"', "dangerous"),
    (V.CISCO_LOG, "%ASA-5-111111: Something else", "dedupe"),
    (V.CISCO_LOG, "%ASA-6-302013unknown", "reject"),
    (V.WINDOW_LOG, windows(4634, [("TargetUserName", "theo"), ("LogonID", "0xacdc6")]), "sample"),
    (V.WINDOW_LOG, windows(4625, [("TargetUserName", "wes"), ("IpPort", "1")]), "dangerous"),
    (V.WINDOW_LOG, windows(4723, [("TargetUserName", "wes"), ("IpPort", "1")]), "dangerous"),
    (V.WINDOW_LOG, windows(4624, [("TargetUserName", "dan"), ("IpPort", "1")]), "dedupe"),
    (V.WINDOW_LOG, "<bad", "reject"),
])
def test_route_of_a_line(lines, log_type, line, route):
    assert one(LOG_TYPES[log_type].staged, lines, line)["route"] == route


def test_access_fields_in_order(lines):
    r = one(parse_access, lines, "x " + access(u="/a?b=c", a="agent x", r="-") + " y")
    assert [r[f] for f in V.ACCESS_FIELDS] == [
        "192.168.1.10", "25/05/2025:10:00:00 +0700", "GET", "/a?b=c", "HTTP/1.1", "200", "1234",
        "agent x", "-",
    ]


def test_access_takes_the_first_match(lines):
    r = one(parse_access, lines, "noise\n" + access(u="/one") + "\n" + access(u="/two"))
    assert r["url"] == "/one"


def test_text_holding_the_separator_is_taken_whole(lines):
    agent = "a\x01b\x01\x01"
    r = one(parse_access, lines, "\x01" + access(a=agent, u="/\x01", r="\x01"))
    assert (r["user_agent"], r["url"], r["refer"]) == (agent, "/\x01", "\x01")
    assert r["reject_reason"] is None
    # as many separators as a match would give
    assert one(parse_access, lines, "\x01" * 8)["reject_reason"] == "no_match"


def test_unicode_words_and_digits_match_as_such(lines):
    r = one(parse_access, lines, access(m="GÉT"))
    assert r["method"] == "GÉT"
    # another script's digits are digits for the pattern but no number for a test
    r = one(LOG_TYPES[V.CISCO_LOG].staged, lines, "%ASA-٧-110002: x")
    assert r["reject_reason"] == "no_header"


def test_dot_stops_only_at_a_line_feed(lines):
    text = "part  still\r here"
    r = one(parse_cisco, lines, f"%ASA-7-1: {text}\nnext line")
    assert r["message_text"] == text


def test_error_fields_and_trailing_blank(lines):
    r = one(
        parse_error, lines,
        '2025/05/30 17:20:39 [error] 2767#9: *266 connect() to "/etc/passwd" failed '
        "(110: Connection timed out), client: 59.64.27.146, server: x",
    )
    assert r["timestamp"] == "2025/05/30 17:20:39 "
    assert (r["pid"], r["tid"], r["request_id"], r["level"]) == ("2767", "9", "266", "error")
    assert r["ip"] == "59.64.27.146, server: x"
    assert (r["action"], r["file_path"], r["errno"]) == ("connect", "/etc/passwd", "110")
    assert r["error_message"].startswith('connect() to "/etc')


@pytest.mark.parametrize("message, want", [
    ('open"file" x (32: y', ("ope", "file", "32")),  # one character left for the gap
    ('a"file" x (32: y', ("file", '" x (32: y', None)),  # no room: next segment, no second quote
    ('- (open) "f" failed (7)', ("open", "f", "7")),
    ('open "f" failed (32', ("open", "f", "3")),  # the last digit feeds the rest
    ('"q" open "f" failed (5: z)', ("q", " open ", "5")),
])
def test_error_detail_follows_a_backtracking_search(lines, message, want):
    """The fast pattern must give what the plain one gives; Python's engine is the judge."""
    import re

    plain = re.search(r'(\w+)[^"]+"([^"]+)"[^(]+\((\d+).+', message)
    r = one(parse_error, lines, f"t [error] 1#1: *1 {message}, client: 1.1.1.1")
    if plain is None:
        assert r["reject_reason"] == "no_detail"
    else:
        assert (r["action"], r["file_path"], r["errno"]) == plain.groups()


def test_error_patterns_against_plain_search(spark, lines):
    """Random texts over the patterns' own letters: fast and plain patterns agree."""
    import random
    import re

    from pyspark.sql import functions as F

    from siftline.functions.captures import captures, complete

    rng = random.Random(5)
    inner = [
        "".join(
            rng.choice(["a", "b1", '"', ' "', '" ', "(1", "(12", ")", " ", "-", "\n"])
            for _ in range(rng.randint(5, 14))
        )
        for _ in range(6000)
    ]
    outer = [
        "".join(
            rng.choice(["[", "]", "x", " ", "\n", "[a] 1#2: *3 ", "m,", "m", ", client: ", "c"])
            for _ in range(rng.randint(3, 9))
        )
        for _ in range(6000)
    ]
    for texts, fast, plain, width, literal in (
        (inner, V.ERROR_DETAIL_PATTERN, r'(\w+)[^"]+"([^"]+)"[^(]+\((\d+).+', 3,
         V.ERROR_DETAIL_LITERAL),
        (outer, V.ERROR_PATTERN,
         r'([^\[]+)\[(\w+)\] (\d+)#(\d+): \*(\d+) ([^,]+), client: (.+)', 7, V.ERROR_LITERAL),
    ):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = df.select("i", captures(F.col("t"), fast, range(1, width + 1), literal).alias("c"))
        got = {r["i"]: r["c"] for r in got.filter(complete(F.col("c"), width)).collect()}
        want = {i: list(m.groups()) for i, t in enumerate(texts) if (m := re.search(plain, t))}
        assert len(want) > 50
        assert got == want


CISCO_CASES = [
    ("%ASA-6-302014: Teardown TCP connection 20534 for outside:18.242.207.157/16708 to "
     "inside:192.168.234.151/57829 duration 0:04:29 bytes 1594",
     dict(event_type="connection_teardown", protocol="TCP", conn_id="20534", src_zone="outside",
          src_ip="18.242.207.157", src_port="16708", dst_zone="inside", dst_ip="192.168.234.151",
          dst_port="57829", duration="0:04:29", bytes="1594", message_text=None, nat_ip=None)),
    ('%ASA-4-106023: Deny TCP src outside:1.2.3.4/10 dst inside:9.9.9.9/443 by access-group "acl"',
     dict(event_type="connection_denied", access_group="acl", src_port="10", dst_port="443",
          conn_id=None)),
    ("%ASA-6-302013: Built outbound TCP connection 12345 for inside:192.168.1.2/80 (5.6.7.8/90) "
     "to outside:9.9.9.9/443",
     dict(event_type="connection_build", protocol="TCP", conn_id="12345", nat_ip="5.6.7.8",
          nat_port="90", src_ip="192.168.1.2", dst_ip="9.9.9.9")),
    ("%ASA-6-302013: Built inbound TCP connection 1 for outside:1.2.3.4/80 to inside:9.9.9.9/443",
     dict(event_type="connection_build", nat_ip=None, nat_port=None)),
    ("%ASA-6-302015: Built ICMP connection for faddr 1.1.1.1/0 gaddr 2.2.2.2/0 laddr 3.3.3.3/0",
     dict(event_type="icmp_connection", dst_ip="1.1.1.1", nat_ip="2.2.2.2", src_ip="3.3.3.3",
          src_port=None)),
    ("%ASA-7-999999: Debug trace — NAT translation skipped for ICMP",
     dict(event_type=None, severity="7", message_id="999999",
          message_text="Debug trace — NAT translation skipped for ICMP")),
    ("%ASA-7-302021: Teardown TCP connection for trace test",
     dict(event_type=None, message_text="Teardown TCP connection for trace test")),
    ("%ASA-5-111111: Something else",
     dict(event_type=None, severity="5", message_id="111111", message_text=None)),
    # severity is searched on its own and may come from an earlier place
    ("%ASA-7-x %ASA-6-302013: late", dict(severity="7", message_id="302013", message_text="late")),
]


@pytest.mark.parametrize("line, want", CISCO_CASES)
def test_cisco_fields(lines, line, want):
    r = one(parse_cisco, lines, line).asDict()
    assert r["reject_reason"] is None
    assert {k: r[k] for k in want} == want


def test_cisco_detail_that_does_not_fit_is_a_reject(lines):
    r = one(parse_cisco, lines, "%ASA-6-302014: Teardown TCP connection lost\x01")
    assert r["reject_reason"] == "no_detail" and r["severity"] is None
    assert bytes(r["raw_value"]).startswith(b"%ASA-6")


def test_windows_columns(lines):
    r = one(parse_windows, lines, windows(4624, [
        ("TargetUserName", "first"), ("TargetUserName", "last &amp; best"),
        ("IpAddress", "1.2.3.4"), ("Computer", "other"), ("Elevated", "no"),
        ("ElevatedToken", "a"), ("ElevatedToken", "b"), ("ProcessName", None),
    ]))
    assert r["target_user_name"] == "last & best"
    assert r["computer"] == "mcglynn.co"
    assert r["ip_address"] == "1.2.3.4" and r["process_name"] is None
    assert r["time_created_system_time"] == "2025-06-05 18:15:47"
    assert r["event_record_id"] == "660934" and r["provider_name"].startswith("Microsoft")
    assert r["extra"] == {"elevated": "no", "elevated_token": "b"}


def test_windows_names_can_be_added(lines):
    line = windows(4624, [("ClientIp", "1.2.3.4"), ("A", "x")])
    r = parse_windows(lines([line]), (*V.WINDOW_DATA_NAMES, "ClientIp")).first()
    assert r["client_ip"] == "1.2.3.4" and r["extra"] == {"a": "x"}


def test_windows_time_of_another_zone(lines):
    line = windows(4624, [("A", "x")], time="2025-06-05T01:15:47+07:00")
    assert one(parse_windows, lines, line)["time_created_system_time"] == "2025-06-04 18:15:47"


@pytest.mark.parametrize("line, reason", [
    ("<bad", "bad_xml"),
    ("", "bad_xml"),
    (windows(1, [("A", "x")], tail=" trailing <"), "bad_xml"),
    (windows(1, [("A", "x")], system=False), "no_system"),
    (windows(1, []), "no_data"),
    (windows(1, [("A", "x")], time="yesterday"), "bad_time"),
    (windows(1, [("A", "x")], time="2025-06-05T18:15:47"), "bad_time"),
    (windows(1, [("A", "x")]).replace(' Name="A"', ""), "unnamed_data"),
    (b"\xff\xfe", "not_utf8"),
])
def test_windows_rejects(lines, line, reason):
    assert one(parse_windows, lines, line)["reject_reason"] == reason


def test_names():
    assert [snake_name(n) for n in ("EventRecordID", "IpAddress", "@SystemTime", "LogonID")] == [
        "event_record_id", "ip_address", "system_time", "logon_id",
    ]


def test_api_json(lines):
    text = (
        '{"timestamp":"2025-06-05 18:15:47.354 +0700","method":"GET","endpoint":"/api",'
        '"statusCode":404,"responseTime":5,"ip":"1.2.3.4"}'
    )
    r = one(parse_api_json, lines, text)
    assert (r["level"], r["status_code"], r["ip"]) == ("WARN", 404, "1.2.3.4")
    assert one(parse_api_json, lines, "{")["reject_reason"] == "bad_json"


@pytest.mark.parametrize("parse", [parse_access, parse_error, parse_cisco, parse_windows])
def test_every_line_is_accepted_or_rejected_with_its_bytes(lines, parse):
    values = [access(), b"\xc3\x28", "", "x\x01y", "%ASA-6-1: ok", windows(1, [("A", "x")])]
    parsed = parse(lines(values))
    good, bad = accepted(parsed).collect(), rejects(parsed).collect()
    assert sorted(r["offset"] for r in good + bad) == list(range(len(values)))
    for r in bad:
        want = values[r["offset"]]
        assert bytes(r["value"]) == (want if isinstance(want, bytes) else want.encode())


@pytest.mark.parametrize("parse, text", [
    (parse_error, "x" * 300_000),
    (parse_error, "word " * 60_000),
    (parse_error, '[a] 1#1: *1 ' + 'word " ' * 20_000),
    (parse_error, "t [a] 1#1: *1 " + "word " * 40_000 + ", client: x"),
    (parse_access, "1.1.1.1 - - [" * 30_000),
    (parse_access, '1.1.1.1 - - [1] "G u p" 1 1 "' * 10_000),
    (parse_cisco, "%ASA-6-1" * 30_000),
    (parse_cisco, "%ASA-6-1: " + "Built x y connection " * 10_000),
    (parse_windows, "<Event>" * 20_000),
])
def test_long_lines_without_a_match_stay_cheap(lines, parse, text):
    start = time.time()
    one(parse, lines, text)
    assert time.time() - start < 30


def test_further_system_parts_are_gathered_once(lines):
    from siftline.operators.parse_windows import parse_windows

    plan = parse_windows(lines(["<Event/>"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("struct(name, version, value,") == 1


def test_windows_expressions_are_compiled_once(lines):
    """Generators, which interpret what they are given, get columns; the XML is read in one place."""
    parsed = parse_windows(lines(["<x/>"])).filter("reject_reason IS NULL")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    generators = [p for p in plan.splitlines() if "Generate explode" in p]
    assert len(generators) == 3 and not any("CASE" in p or "from_xml" in p for p in generators)
    assert plan.count("from_xml") == 1
