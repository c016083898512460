"""Schemas and fixed values shared by every layer."""

from pyspark.sql import types as T

# --- fixed values: event identifiers of the log format -----------------------
EVENT_LOGIN_SUCCESS = "cowrie.login.success"
EVENT_LOGIN_FAILED = "cowrie.login.failed"
EVENT_COMMAND = "cowrie.command.input"
EVENT_CLOSED = "cowrie.session.closed"
LOG_FILE_PATTERN = "cowrie.json*"
FINISHED_LOG_PATTERN = "cowrie.json.*"  # rotated files; the sensor still appends to the one without suffix

# --- fixed values: command patterns, their score weights and level cut-offs --
COMMAND_SEPARATOR = " | "
PATTERNS = {
    "has_download_command": r"wget|curl|tftp|scp|fetch",
    "has_privilege_escalation": r"sudo|su\s|chmod|chown",
    "has_file_access": r"cat|less|more|head|tail|nano|vi|vim",
    "has_reconnaissance": r"ls|dir|pwd|whoami|id|uname|ifconfig|ip\s",
    "has_persistence": r"crontab|systemctl|service|rc\.local|init\.d",
    "has_malware_indicators": r"\.sh|\.pl|\.py|\.bin|\.elf|chmod\s+[0-7]*x",
}
LOGIN_WEIGHT = 5
WEIGHTS = {
    "has_download_command": 3,
    "has_privilege_escalation": 4,
    "has_file_access": 1,
    "has_reconnaissance": 2,
    "has_persistence": 4,
    "has_malware_indicators": 3,
}
HIGH_SCORE = 10
MEDIUM_SCORE = 5
LEVELS = ["low", "medium", "high"]  # position = threat code
LEVEL_REPORT_ORDER = ["high", "medium", "low"]
COMMAND_TYPES = {
    "download": "has_download_command",
    "privilege_escalation": "has_privilege_escalation",
    "file_access": "has_file_access",
    "reconnaissance": "has_reconnaissance",
    "persistence": "has_persistence",
    "malware": "has_malware_indicators",
}
RESPONSES = ["low", "medium", "high"]  # position = response level
RECON_CLUSTERS = (0, 2)

# --- fixed values: column lists -----------------------------------------------
TRAINING_FEATURES = [
    "duration", "command_count", "unique_commands", "login_attempts",
    "login_success", "download_attempts",
]
SERVING_FEATURES = ["duration", "login_success", "command_count", *PATTERNS]
IDENTIFIERS = ["session_id", "src_ip", "username", "password", "commands"]
SESSION_COLUMNS = [
    "session_id", "src_ip", "start_time", "end_time", "duration", "commands",
    "command_count", "unique_commands", "login_attempts", "login_success",
    "download_attempts", "threat_level",
]
BACKFILL_COLUMNS = ["command_count", "login_success", "download_attempts", "threat_level"]

# Two patterns end in white space. In a session's joined text they also match a
# command that ends in one of these words and is followed by the separator.
TAIL_WORDS = {"has_privilege_escalation": "su", "has_reconnaissance": "ip"}

# White space as the log's producers understand it: Unicode separators and the
# ASCII information separators count, which plain \s of the JVM leaves out.
WHITE_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"

RAW_FIELDS = [
    "session", "eventid", "timestamp", "src_ip", "username", "password", "input",
    "version", "hassh", "hasshAlgorithms", "duration", "success",
]
# Every payload field is read as text, so that a value of an unexpected type never
# makes a whole line look corrupt; casts happen where the value is used.
RAW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in RAW_FIELDS])
CORRUPT = "_corrupt_record"

EVENTS_A_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("success", T.IntegerType()),
])
EVENTS_B_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("password", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
])
EMPTY_SESSIONS_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("commands", T.StringType()),
    T.StructField("command_count", T.LongType()),
    T.StructField("unique_commands", T.LongType()),
    T.StructField("login_attempts", T.LongType()),
    T.StructField("login_success", T.BooleanType()),
    T.StructField("download_attempts", T.LongType()),
    T.StructField("threat_level", T.StringType()),
])
FEATURES_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("login_success", T.BooleanType()),
    T.StructField("username", T.StringType()),
    T.StructField("password", T.StringType()),
    T.StructField("client_version", T.StringType()),
    T.StructField("hassh", T.StringType()),
    T.StructField("hassh_algorithms", T.StringType()),
    T.StructField("login_attempt_count", T.LongType()),
    T.StructField("command_count", T.LongType()),
    T.StructField("event_count", T.LongType()),
    *[T.StructField(n, T.IntegerType()) for n in PATTERNS],
    T.StructField("has_command_text", T.BooleanType()),
    T.StructField("threat_score", T.IntegerType()),
    T.StructField("threat_level", T.StringType()),
    T.StructField("threat_code", T.IntegerType()),
])
