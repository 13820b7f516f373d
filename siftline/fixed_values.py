"""Patterns, word lists and formats the results depend on.

The patterns are written for Java's regex engine. They are searched (first
match wins), digits and word characters are Unicode, and ``.`` stops only at a
line feed (see ``functions.captures``). Possessive quantifiers and the look-
behinds in the two error patterns change no capture; they keep the search
linear on long lines that do not match.
"""

ACCESS_LOG = "access_log"
ERROR_LOG = "error_log"
CISCO_LOG = "cisco_log"
WINDOW_LOG = "window_log"
API_LOG = "api_log"

# ---- fixed values: access log ------------------------------------------------
ACCESS_PATTERN = (
    r'(\d{1,3}(?:\.\d{1,3}){3}) - - \[([0-9/:+\- ]+)\] '
    r'"(\w+) ([^ ]+) ([\w/.]+)" (\d+) (\d+) "([^"]+)" "([^"]+)"'
)
ACCESS_LITERAL = " - - ["
ACCESS_FIELDS = (
    "ip", "timestamp", "method", "url", "protocol", "status", "bytes", "user_agent", "refer",
)
STATIC_EXTENSIONS = (
    ".html", ".htm", ".css", ".js", ".mjs", ".jsx", ".tsx",
    ".png", ".jpg", ".jpeg", ".gif", ".webp", ".avif", ".svg", ".ico", ".bmp", ".tiff",
    ".mp3", ".wav", ".ogg", ".mp4", ".webm", ".mov", ".avi", ".mkv",
    ".woff", ".woff2", ".ttf", ".otf", ".eot", ".json", ".xml", ".txt",
)
WRITE_METHODS = ("POST", "PUT", "DELETE")
FIRST_FAILING_STATUS = 400

# ---- fixed values: error log -------------------------------------------------
ERROR_PATTERN = (
    r'(?:^|(?<=\[))([^\[]++)\[(\w+)\] (\d+)#(\d+): \*(\d+) ([^,]++), client: (.+)'
)
ERROR_LITERAL = ", client: "
ERROR_FIELDS = ("timestamp", "level", "pid", "tid", "request_id", "error_message", "ip")
ERROR_DETAIL_PATTERN = (
    r'(?:^|(?<="))[^"\w]*+(\w++(?!")|\w+(?=\w"))[^"]*+"([^"]++)"[^(]++\((\d+).+'
)
ERROR_DETAIL_LITERAL = '"'
ERROR_DETAIL_FIELDS = ("action", "file_path", "errno")
IMPORTANT_LEVELS = ("crit", "error", "alert")

# ---- fixed values: firewall log ----------------------------------------------
CISCO_SEVERITY_PATTERN = r'%ASA-(\d+)-.+'
CISCO_HEADER_PATTERN = r'%ASA-(\d+)-(\d+): (.+)'
CISCO_LITERAL = "%ASA-"
CISCO_DEBUG_SEVERITY = 7
CISCO_DETAIL_FIELDS = (
    "protocol", "conn_id", "src_zone", "src_ip", "src_port", "dst_zone", "dst_ip", "dst_port",
    "duration", "bytes", "access_group", "nat_ip", "nat_port",
)
# event type, phrase that selects it, detailed pattern, field of each group (in order)
CISCO_EVENTS = (
    (
        "connection_teardown",
        r'Teardown .+',
        r'Teardown (\w+) connection (\d+) for (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)'
        r' to (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)'
        r' duration (\d{1,2}(?::\d{1,2}){2}) bytes (\d+)',
        ("protocol", "conn_id", "src_zone", "src_ip", "src_port",
         "dst_zone", "dst_ip", "dst_port", "duration", "bytes"),
    ),
    (
        "connection_denied",
        r'Deny .+',
        r'Deny (\w+) src (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)'
        r' dst (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+) by access-group "([^"]+)"',
        ("protocol", "src_zone", "src_ip", "src_port",
         "dst_zone", "dst_ip", "dst_port", "access_group"),
    ),
    (
        "nat_translation",
        r'Built dynamic .+',
        r'Built dynamic (\w+) translation from (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)'
        r' to (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)',
        ("protocol", "src_zone", "src_ip", "src_port", "dst_zone", "dst_ip", "dst_port"),
    ),
    (
        "icmp_connection",
        r'Built ICMP connection .+',
        r'Built ICMP connection for faddr (\d{1,3}(?:\.\d{1,3}){3})/0'
        r' gaddr (\d{1,3}(?:\.\d{1,3}){3})/0 laddr (\d{1,3}(?:\.\d{1,3}){3})/0',
        ("dst_ip", "nat_ip", "src_ip"),
    ),
    (
        "connection_build",
        r'Built \w+ \w+ connection .+',
        r'Built \w+ (\w+) connection (\d+) for (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)'
        r'(?: \((\d{1,3}(?:\.\d{1,3}){3})/(\d+)\))?'
        r' to (\w+):(\d{1,3}(?:\.\d{1,3}){3})/(\d+)',
        ("protocol", "conn_id", "src_zone", "src_ip", "src_port", "nat_ip", "nat_port",
         "dst_zone", "dst_ip", "dst_port"),
    ),
)
CISCO_DANGEROUS_EVENTS = ("connection_denied", "connection_teardown")

# ---- fixed values: Windows security log --------------------------------------
WINDOW_SYSTEM_FIELDS = (
    "provider_name", "event_id", "level", "time_created_system_time",
    "event_record_id", "channel", "computer",
)
# Data names seen in events 4624, 4625, 4634 and 4723
WINDOW_DATA_NAMES = (
    "SubjectUserSid", "SubjectUserName", "SubjectDomainName", "TargetUserName",
    "TargetDomainName", "LogonType", "LogonProcessName", "AuthenticationPackageName",
    "WorkstationName", "IpAddress", "IpPort", "ProcessName", "Status", "FailureReason",
    "LogonID",
)
WINDOW_LOGOFF_EVENT = 4634
WINDOW_DANGEROUS_EVENTS = (4625, 4723)

# ---- fixed values: reduction -------------------------------------------------
SAMPLE_RATIO = 0.2
DEDUPE_KEYS = {
    ACCESS_LOG: ("method", "status", "url", "ip"),
    ERROR_LOG: ("timestamp",),
    CISCO_LOG: ("severity", "event_type", "src_ip", "dst_ip"),
    WINDOW_LOG: ("ip_address", "logon_type", "workstation_name", "target_user_name"),
}

# ---- fixed values: metadata removed after enrichment -------------------------
BROKER_METADATA = ("message_key", "offset", "partition", "topic", "source_type", "headers")

# ---- fixed values: time formats ----------------------------------------------
ACCESS_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss Z"
ERROR_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"
ERROR_TIME_OFFSET = "+0700"
API_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS Z"

# ---- fixed values: sinks -----------------------------------------------------
DEFAULT_BUCKET = "log-bucket"
DEFAULT_KEY_PREFIX = "year=%Y/month=%m/day=%d/{log_type}/"
FALLBACK_INDEX = "default_log"
OLAP_DATABASE = "log_database"
SINK_TYPES = ("elasticsearch", "aws_s3", "clickhouse")
MICRO_BATCH_INTERVAL = "10 seconds"
OLAP_BATCH_INTERVAL = "1 second"
