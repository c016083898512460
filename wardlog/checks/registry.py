"""Every operator as a query on the test tables; most with SQL for an exact comparison."""

import os
from datetime import timedelta
from functools import partial, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.checks import oracles as O
from wardlog.functions import (
    command_flags, day, hour, int_or_zero, list_length, number_or_zero, parse_instant, parse_ts, percent,
    prettify, text_or_empty,
)
from wardlog.operators import events as E
from wardlog.operators import metrics as M
from wardlog.operators import respond as R
from wardlog.operators import sampling as SA
from wardlog.operators import scaling as SC
from wardlog.operators import sessions as SE
from wardlog.plans import charts as C
from wardlog.plans import learning as L
from wardlog.plans import profiles as P
from wardlog.plans import scoring
from wardlog.session import at_once, materialize, scratch_path
from wardlog.sources import growing, logs, sinks
from wardlog.streaming import live

QUERIES: dict = {}
ORACLES: dict = {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


# --- inputs ------------------------------------------------------------------------

_STORED: dict = {}


def stored(spark, sf_dir, what, build):
    """Builds a table or model once per application and test folder."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]


def raw(spark, d):
    return logs.load_events(spark, d)


def events(spark, d):
    return E.events_b(raw(spark, d))


def sessions(spark, d):
    return SE.session_features(raw(spark, d))


def kept(spark, d):
    """The session table, stored once: for operators that read their input several times."""
    return stored(spark, d, "sessions", lambda: materialize(sessions(spark, d)))


def tokens(spark, d):
    return SE.command_tokens(raw(spark, d))


def log_dir(spark, d):
    """The events written as JSON lines, with bad lines between them."""
    def write():
        e = raw(spark, d)
        line = F.to_json(F.struct(*S.RAW_FIELDS))
        number = F.col("ord").cast("string")

        def every(n, text):
            return F.when(F.col("ord") % n == 0, text)

        lines = F.filter(F.array(
            line,
            every(97, F.concat(F.lit("not json "), number)),
            every(101, F.concat(F.lit("["), number, F.lit(",2]"))),
            every(103, F.lit("")),
            every(107, F.concat(F.lit('{"eventid":"other'), number, F.lit('"}'))),
            every(109, F.concat(F.lit('{"session":"x'), number, F.lit('"}{"session":"y"}'))),
        ), lambda x: x.isNotNull())
        path = scratch_path(spark, "log")
        e.select(F.explode(lines).alias("value")).write.text(path)
        return path

    return stored(spark, d, "log", write)


LOG_FILES = "part-*"


# --- scans, sources, sinks -----------------------------------------------------------

@query("scan_jsonl", f"""WITH {O.DIRTY} SELECT session, eventid, timestamp, src_ip, username, password, input, version,
    hassh, "hasshAlgorithms", duration, success FROM lines""")
def _(spark, d):
    return logs.scan_jsonl(spark, log_dir(spark, d), pattern=LOG_FILES).select(
        *[n for n in S.RAW_FIELDS if n != "duration"], F.col("duration").cast("double").alias("duration")
    )


@query("scan_quarantine", f"WITH {O.DIRTY} SELECT text FROM bad")
def _(spark, d):
    return logs.scan_quarantine(spark, log_dir(spark, d), pattern=LOG_FILES).select(F.col(S.CORRUPT).alias("text"))


@query("scan_discover", O.on_log("SELECT (ord % 3)::INTEGER AS kind, sum(length(ord::VARCHAR) + 1)::BIGINT AS length FROM log GROUP BY 1"))
def _(spark, d):
    """Text files in three folders are found with their sizes; files of another name are not."""
    path = scratch_path(spark, "files")
    lines = raw(spark, d).select(F.col("ord").cast("string").alias("value"), (F.col("ord") % 3).alias("kind")).coalesce(1)
    lines.write.partitionBy("kind").text(path)
    lines.write.mode("append").json(path)
    found = logs.discover(spark, path, pattern="*.txt")
    return found.select(F.regexp_extract("path", r"kind=(\d)", 1).cast("int").alias("kind"), "length")


@query("scan_flat_dir", f"WITH {O.DIRTY} SELECT session, eventid, count(*) AS count FROM lines GROUP BY ALL")
def _(spark, d):
    out = scratch_path(spark, "flat")
    stream = live.stream_events(spark, log_dir(spark, d), pattern=LOG_FILES)
    stream.select("session", "eventid").writeStream.format("parquet").option(
        "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return spark.read.parquet(f"{out}/rows").groupBy("session", "eventid").agg(F.count(F.lit(1)).alias("count"))


def sessions_csv(spark, d):
    def write():
        path = scratch_path(spark, "sessions-csv")
        sinks.write_csv(sessions(spark, d), path)
        return path
    return stored(spark, d, "sessions-csv", write)


def events_csv(spark, d):
    def write():
        path = scratch_path(spark, "events-csv")
        sinks.write_csv(E.events_a(raw(spark, d)), path)
        return path
    return stored(spark, d, "events-csv", write)


@query("scan_sessions_csv", O.on_sessions("""SELECT session_id, src_ip, start_time, end_time, duration,
    NULL::VARCHAR AS commands, command_count, login_success, threat_level, NULL::BIGINT AS unique_commands FROM s"""))
def _(spark, d):
    return logs.scan_csv(spark, sessions_csv(spark, d), S.EMPTY_SESSIONS_SCHEMA).select(
        "session_id", "src_ip", "start_time", "end_time", "duration", "commands", "command_count", "login_success",
        "threat_level", "unique_commands",
    )


EVENTS_A_SQL = """SELECT session AS session_id, timestamp, eventid AS event_type, src_ip, {input} AS input,
    (eventid = 'cowrie.login.success')::INTEGER AS success FROM log"""


@query("scan_events_csv", O.on_log(EVENTS_A_SQL.format(input="nullif(input, '')")))
def _(spark, d):
    return logs.scan_csv(spark, events_csv(spark, d), S.EVENTS_A_SCHEMA)


@query("sink_sessions", O.on_sessions(f"SELECT {O.FEATURE_LIST} FROM s"))
def _(spark, d):
    path = scratch_path(spark, "sessions")
    sinks.write_table(sessions(spark, d), path)
    return sinks.read_table(spark, path)


@query("sink_events", O.on_log(EVENTS_A_SQL.format(input="coalesce(input, '')")))
def _(spark, d):
    path = scratch_path(spark, "events")
    sinks.write_table(E.events_a(raw(spark, d)), path)
    return sinks.read_table(spark, path)


DISTRIBUTION_SQL = """SELECT eventid AS event_id, count(*) AS count,
    count(*)::DOUBLE / (SELECT count(*) FROM log) * 100 AS percentage FROM log GROUP BY eventid"""


@query("sink_profile", O.on_log(DISTRIBUTION_SQL))
def _(spark, d):
    path = scratch_path(spark, "profile")
    sinks.write_json(P.event_distribution(events(spark, d)), path)
    return spark.read.schema("event_id string, count bigint, percentage double").json(path)


# --- flat events, filters, projections ------------------------------------------------

@query("events_a", O.on_log(EVENTS_A_SQL.format(input="coalesce(input, '')")))
def _(spark, d):
    return E.events_a(raw(spark, d))


@query("events_b", O.on_log("""SELECT timestamp, session AS session_id, eventid AS event_id, src_ip,
    coalesce(username, '') AS username, coalesce(password, '') AS password, coalesce(input, '') AS input,
    coalesce(duration, 0.0)::DOUBLE AS duration, event_type = 'signup' AS success FROM log"""))
def _(spark, d):
    return events(spark, d)


@query("backfill_columns", O.on_sessions("""SELECT session_id, command_count, login_success, threat_level,
    0::INTEGER AS download_attempts FROM s"""))
def _(spark, d):
    base = sessions(spark, d).select("session_id", "command_count", "login_success", "threat_level")
    return E.backfill(base, S.BACKFILL_COLUMNS)


@query("filter_event_type", O.on_log("""SELECT session AS session_id, username, password FROM log
    WHERE eventid = 'cowrie.login.failed'"""))
def _(spark, d):
    return E.of_type(events(spark, d), S.EVENT_LOGIN_FAILED).select("session_id", "username", "password")


@query("filter_active_sessions", O.on_sessions("SELECT session_id, command_count FROM s WHERE command_count > 0"))
def _(spark, d):
    return E.active(sessions(spark, d)).select("session_id", "command_count")


@query("filter_by_level", O.on_sessions("SELECT session_id, threat_score FROM s WHERE threat_level = 'high'"))
def _(spark, d):
    return E.by_level(sessions(spark, d), "high").select("session_id", "threat_score")


@query("filter_by_ip", O.on_sessions("""SELECT session_id, threat_level FROM s WHERE src_ip = (
    SELECT src_ip FROM s GROUP BY src_ip ORDER BY count(*) DESC, src_ip LIMIT 1)"""))
def _(spark, d):
    return P.top_ip_sessions(kept(spark, d), 1).select("session_id", "threat_level")


@query("filter_is_string", O.on_sessions("SELECT session_id, command_count FROM s WHERE command_count > 0 AND commands <> ''"))
def _(spark, d):
    return E.with_command_text(sessions(spark, d)).select("session_id", "command_count")


@query("filter_completed", O.on_sessions("SELECT session_id, end_time, duration FROM s WHERE end_time IS NOT NULL"))
def _(spark, d):
    return E.completed(sessions(spark, d)).select("session_id", "end_time", "duration")


TRAINING_SQL = """SELECT s.session_id AS id, duration, command_count::DOUBLE AS command_count,
    coalesce(u.n, 0)::DOUBLE AS unique_commands, login_attempt_count::DOUBLE AS login_attempts,
    login_success::INTEGER::DOUBLE AS login_success, has_download_command::DOUBLE AS download_attempts, {more}
    FROM s LEFT JOIN (SELECT session_id, count(DISTINCT command) AS n FROM tok GROUP BY session_id) u USING (session_id)"""


@query("select_features", O.on_tokens(TRAINING_SQL.format(
    more="threat_code AS label, command_count::DOUBLE AS commands_length, login_attempt_count::DOUBLE AS login_attempts_length")))
def _(spark, d):
    """The training columns, and the length of each list of a session, counted from its entries."""
    e = raw(spark, d)
    lengths = SE.session_entries(e).groupBy("session_id").agg(
        *[F.count_if(F.col("list") == c).alias(f"{c}_length") for c in ("commands", "login_attempts")])
    table = SE.training_table(SE.session_features(e), SE.command_tokens(e)).join(lengths, "session_id", "left")
    return L.training_matrix(table, L.feature_columns(table, S.TRAINING_FEATURES))


@query("drop_identifiers", O.on_sessions("SELECT duration, command_count, threat_score FROM s"))
def _(spark, d):
    columns = ["session_id", "src_ip", "duration", "username", "command_count", "password", "threat_score"]
    return sessions(spark, d).select(*SC.numeric_features(columns))


@query("serving_projection", O.on_sessions(
    f"SELECT session_id, duration, login_success::INTEGER AS login_success, command_count, {O.FLAG_LIST} FROM s"))
def _(spark, d):
    return scoring.serving_projection(sessions(spark, d))


@query("rule_response_predicates", O.on_sessions("""SELECT session_id,
    CASE threat_code WHEN 2 THEN 2 WHEN 1 THEN 1 ELSE 0 END::INTEGER AS plain,
    CASE WHEN threat_code = 2 THEN 2 WHEN threat_code = 1 THEN 1 WHEN least(command_count, 3) IN (0, 2) THEN 1 ELSE 0 END::INTEGER AS by_cluster
    FROM s"""))
def _(spark, d):
    cluster = F.least("command_count", F.lit(3))
    return sessions(spark, d).select(
        "session_id", R.rule_response(F.col("threat_code"), cluster).alias("plain"),
        R.rule_response(F.col("threat_code"), cluster, S.RECON_CLUSTERS).alias("by_cluster"),
    )


# --- sessions --------------------------------------------------------------------------

@query("sessionize", O.on_sessions("""SELECT session_id, src_ip, start_time, end_time, duration, login_success, username,
    password, client_version, hassh, hassh_algorithms FROM s"""))
def _(spark, d):
    return SE.sessionize(raw(spark, d)).select(
        "session_id", "src_ip", "start_time", "end_time", "duration", "login_success", "username", "password",
        "client_version", "hassh", "hassh_algorithms",
    )


@query("session_counts", O.on_sessions("SELECT session_id, login_attempt_count, command_count, event_count FROM s"))
def _(spark, d):
    return SE.sessionize(raw(spark, d)).select("session_id", "login_attempt_count", "command_count", "event_count")


@query("session_lists", O.on_log("""SELECT session AS session_id, ord AS position, timestamp,
    CASE WHEN event_type IN ('signup', 'error') THEN 'login_attempts' ELSE 'commands' END AS list,
    CASE WHEN event_type NOT IN ('signup', 'error') THEN coalesce(input, '') END AS input, username, password,
    CASE WHEN event_type IN ('signup', 'error') THEN event_type = 'signup' END AS success FROM log WHERE event_type <> 'purchase'"""))
def _(spark, d):
    return SE.session_entries(raw(spark, d))


@query("session_features", O.on_sessions(f"SELECT {O.FEATURE_LIST} FROM s"))
def _(spark, d):
    return sessions(spark, d)


@query("threat_score", O.on_sessions(f"SELECT session_id, {O.FLAG_LIST}, threat_score, threat_level, threat_code FROM s"))
def _(spark, d):
    return sessions(spark, d).select("session_id", *S.PATTERNS, "threat_score", "threat_level", "threat_code")


for _flag in S.PATTERNS:
    query(_flag, O.on_sessions(f"SELECT session_id, {_flag} FROM s"))(
        lambda spark, d, flag=_flag: sessions(spark, d).select("session_id", flag))


@query("threat_level", O.on_sessions("SELECT threat_score, threat_level, threat_code, count(*) AS count FROM s GROUP BY ALL"))
def _(spark, d):
    return sessions(spark, d).groupBy("threat_score", "threat_level", "threat_code").agg(F.count(F.lit(1)).alias("count"))


@query("command_flags", O.on_log("SELECT input, " + ", ".join(
    f"regexp_matches(input, '{p}')::INTEGER AS {n}" for n, p in S.PATTERNS.items()
) + ", count(*) AS count FROM log WHERE input IS NOT NULL GROUP BY ALL"))
def _(spark, d):
    """Flags of single commands; each different command is tested once."""
    counts = SE.commands(raw(spark, d)).groupBy("input").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("input", "count", *[f.alias(n) for n, f in command_flags(F.col("input")).items()])


@query("sessionize_conversations", "WITH turns AS (" + """
  SELECT conv_id::VARCHAR AS session, turn AS ord, '' AS timestamp, role AS src_ip, '' AS username, '' AS password, text AS input,
    '' AS version, '' AS hassh, '' AS hassh_algorithms, NULL::DOUBLE AS duration,
    CASE role WHEN 'user' THEN 'cowrie.command.input' WHEN 'system' THEN 'cowrie.login.success' ELSE 'cowrie.session.closed' END AS eventid
  FROM conversations), """ + O.folded("turns") + O.SCORED +
  f" SELECT session_id, src_ip, login_success, command_count, event_count, {O.FLAG_LIST}, threat_score, threat_level FROM s")
def _(spark, d):
    """The same folding over conversations: user turns are the commands."""
    t = spark.read.parquet(f"{d}/conversations.parquet")
    kind = F.when(F.col("role") == "user", S.EVENT_COMMAND).when(
        F.col("role") == "system", S.EVENT_LOGIN_SUCCESS).otherwise(S.EVENT_CLOSED)
    turns = t.select(
        F.col("conv_id").cast("string").alias("session"), F.col("turn").alias("ord"), kind.alias("eventid"),
        F.col("role").alias("src_ip"), F.col("text").alias("input"),
        *[F.lit("").alias(n) for n in S.RAW_FIELDS if n not in ("session", "eventid", "src_ip", "input")],
    )
    return SE.session_features(turns).select(
        "session_id", "src_ip", "login_success", "command_count", "event_count", *S.PATTERNS, "threat_score", "threat_level"
    )


@query("union_events", O.on_log("SELECT eventid AS event_type, count(*) AS count FROM log GROUP BY 1"))
def _(spark, d):
    e = raw(spark, d)
    files = [E.events_a(e.where(F.col("file") == f"part-{i}")) for i in range(3)]
    return E.union_events(files).groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


@query("merge_sessions_last_file", "WITH " + O.LOG + "," + O.folded(by="session, file") + """
    SELECT session_id, start_time, end_time, duration, login_success, command_count, event_count FROM base
    QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY file DESC) = 1""")
def _(spark, d):
    return SE.sessionize(raw(spark, d), per_file=True).select(
        "session_id", "start_time", "end_time", "duration", "login_success", "command_count", "event_count"
    )


# --- profiles ----------------------------------------------------------------------------

@query("basic_statistics", O.on_sessions("""SELECT count(*) AS total_sessions,
    (SELECT count(*) FROM log) AS total_events, count(*) FILTER (login_success) AS successful_logins,
    count(*) FILTER (command_count > 0) AS sessions_with_commands, count(*) FILTER (threat_code = 0) AS low_threat,
    count(*) FILTER (threat_code = 1) AS medium_threat, count(*) FILTER (threat_code = 2) AS high_threat FROM s"""))
def _(spark, d):
    return P.basic_statistics(sessions(spark, d), events(spark, d))


@query("event_distribution", O.on_log(DISTRIBUTION_SQL))
def _(spark, d):
    return P.event_distribution(events(spark, d))


@query("pct_of_total", O.on_sessions("""SELECT src_ip, count(*) AS count,
    count(*)::DOUBLE / (SELECT count(*) FROM s) * 100 AS percentage FROM s GROUP BY src_ip"""))
def _(spark, d):
    return P.pct_of_total(P.ip_counts(sessions(spark, d)))


LOGIN_SQL = """SELECT count(*) AS total_attempts, count(*) FILTER (event_type = 'signup') AS successful_logins,
    count(*) FILTER (event_type = 'error') AS failed_logins,
    coalesce(count(*) FILTER (event_type = 'signup')::DOUBLE / nullif(count(*), 0) * 100, 0.0) AS success_rate
    FROM log WHERE event_type IN ('signup', 'error')"""


@query("login_summary", O.on_log(LOGIN_SQL))
def _(spark, d):
    return P.login_summary(events(spark, d))


CREDENTIALS = """,
cred AS (
  SELECT CASE event_type WHEN 'signup' THEN 'success' ELSE 'failed' END AS outcome, 'username' AS field, username AS value FROM log WHERE username <> ''
  UNION ALL SELECT CASE event_type WHEN 'signup' THEN 'success' ELSE 'failed' END, 'password', password FROM log WHERE password <> ''
),
counted AS (SELECT outcome, field, value, count(*) AS count FROM cred GROUP BY ALL),
top_cred AS (
  SELECT *, row_number() OVER (PARTITION BY outcome, field ORDER BY count DESC, value)::INTEGER AS rank FROM counted
)"""


@query("top_credentials", f"WITH {O.LOG}{CREDENTIALS} SELECT outcome, field, value, count, rank FROM top_cred WHERE rank <= 10")
def _(spark, d):
    return P.top_credentials(events(spark, d))


TYPES = ",\ntypes AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS command_type, count(*) FILTER ({flag} = 1) AS count FROM s WHERE commands <> ''"
    for name, flag in S.COMMAND_TYPES.items()
) + " UNION ALL SELECT 'other', count(*) FILTER (" + " + ".join(S.PATTERNS) + " = 0) FROM s WHERE commands <> '')"


@query("command_type_counts", O.on_sessions("SELECT * FROM types", TYPES))
def _(spark, d):
    return P.command_type_counts(sessions(spark, d))


@query("command_type_distribution", O.on_sessions(
    "SELECT *, count::DOUBLE / (SELECT sum(count) FROM types)::DOUBLE * 100 AS percentage FROM types", TYPES))
def _(spark, d):
    return P.command_type_distribution(sessions(spark, d))


@query("command_tokens", O.on_tokens("SELECT session_id, command, count(*) AS count FROM tok GROUP BY ALL"))
def _(spark, d):
    return tokens(spark, d).groupBy("session_id", "command").agg(F.count(F.lit(1)).alias("count"))


@query("command_list", O.on_log("SELECT session AS session_id, timestamp, input FROM log WHERE input IS NOT NULL"))
def _(spark, d):
    return SE.commands(raw(spark, d)).drop("position")


@query("command_frequency", O.on_tokens("SELECT command, count(*) AS count FROM tok GROUP BY command"))
def _(spark, d):
    return P.command_frequency(tokens(spark, d))


@query("command_totals", O.on_tokens("""SELECT (SELECT count(*) FROM s WHERE command_count > 0) AS total_command_sessions,
    count(*) AS total_commands, count(DISTINCT command) AS unique_commands FROM tok"""))
def _(spark, d):
    return P.command_totals(sessions(spark, d), tokens(spark, d))


@query("command_totals_approximate", O.on_tokens("""SELECT (SELECT count(*) FROM s WHERE command_count > 0) AS total_command_sessions,
    count(*) AS total_commands, true AS unique_within_5_percent FROM tok"""))
def _(spark, d):
    """The sketch against the exact number."""
    exact = tokens(spark, d).agg(F.countDistinct("command")).first()[0]
    found = P.command_totals(sessions(spark, d), tokens(spark, d), approximate=True)
    return found.select("total_command_sessions", "total_commands",
                        (F.abs(F.col("unique_commands") - exact) <= 0.05 * exact).alias("unique_within_5_percent"))


LEVEL_SHARE_SQL = """SELECT threat_level, count(*) AS count,
    count(*)::DOUBLE / (SELECT count(*) FROM s) * 100 AS percentage FROM s GROUP BY threat_level"""


@query("threat_distribution", O.on_sessions(LEVEL_SHARE_SQL))
def _(spark, d):
    return P.threat_distribution(sessions(spark, d))


CHARACTER = """,
levels AS (
  SELECT l.threat_level, count(s.session_id) AS count,
    count(s.session_id)::DOUBLE / (SELECT count(*) FROM s) * 100 AS percentage,
    round(avg(duration), 6) AS avg_duration, avg(command_count) AS avg_command_count,
    avg(login_success::INTEGER) * 100 AS login_success_rate, """ + ", ".join(
    f"avg({n}) * 100 AS {n}" for n in P.FLAGS_BY_LEVEL) + """
  FROM (VALUES ('high'), ('medium'), ('low')) l(threat_level) LEFT JOIN s USING (threat_level) GROUP BY 1
)"""


@query("threat_characteristics", O.on_sessions("SELECT * FROM levels", CHARACTER))
def _(spark, d):
    return P.threat_characteristics(sessions(spark, d)).withColumn("avg_duration", F.round("avg_duration", 6))


for _name, _sql in {
    "sessions_by_day": "SELECT substr(start_time, 1, 10) AS day, count(*) AS count FROM s GROUP BY 1",
    "sessions_by_hour": "SELECT substr(start_time, 12, 2)::INTEGER AS hour, count(*) AS count FROM s GROUP BY 1",
}.items():
    query(_name, O.on_sessions(_sql))(lambda spark, d, f=getattr(P, _name): _plain_day(f(sessions(spark, d))))
for _name, _sql in {
    "events_by_day": "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count FROM log GROUP BY 1",
    "events_by_hour": "SELECT hour(ts)::INTEGER AS hour, count(*) AS count FROM log GROUP BY 1",
}.items():
    query(_name, O.on_log(_sql))(lambda spark, d, f=getattr(P, _name): _plain_day(f(events(spark, d))))


def _plain_day(df: DataFrame) -> DataFrame:
    """Dates as text, so that both engines print them alike."""
    return df.withColumn("day", F.col("day").cast("string")) if "day" in df.columns else df


@query("unique_ips", O.on_sessions("SELECT count(DISTINCT src_ip) AS unique_ips FROM s"))
def _(spark, d):
    return P.unique_ips(sessions(spark, d))


IP_SQL = """SELECT src_ip, count(*) AS total_sessions, count(*) FILTER (threat_code = 2) AS high_threat,
    count(*) FILTER (threat_code = 1) AS medium_threat, count(*) FILTER (threat_code = 0) AS low_threat,
    avg(login_success::INTEGER) * 100 AS login_success_rate, avg(command_count) AS avg_command_count
    FROM s GROUP BY src_ip ORDER BY total_sessions DESC, src_ip LIMIT {k}"""


@query("top_ip_profile", O.on_sessions(IP_SQL.format(k=20)))
def _(spark, d):
    return P.top_ip_profile(sessions(spark, d))


@query("top_ip_sessions", O.on_sessions("""SELECT src_ip, session_id, threat_level FROM s WHERE src_ip IN (
    SELECT src_ip FROM s GROUP BY src_ip ORDER BY count(*) DESC, src_ip LIMIT 20)"""))
def _(spark, d):
    return P.top_ip_sessions(kept(spark, d)).select("src_ip", "session_id", "threat_level")


# --- ranked lists --------------------------------------------------------------------------

@query("top_k_event_types", O.on_log(DISTRIBUTION_SQL + " ORDER BY count DESC, event_id LIMIT 15"))
def _(spark, d):
    return P.event_distribution(events(spark, d)).orderBy(F.desc("count"), "event_id").limit(15)


@query("top_k_credentials", f"WITH {O.LOG}{CREDENTIALS} SELECT outcome, field, value, count FROM top_cred WHERE rank <= 5")
def _(spark, d):
    return P.top_credentials(events(spark, d), 5).drop("rank")


@query("top_k_commands", O.on_tokens("SELECT command, count(*) AS count FROM tok GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"))
def _(spark, d):
    return P.top_k(P.command_frequency(tokens(spark, d)), "command", 20)


@query("top_k_ips", O.on_sessions("SELECT src_ip, count(*) AS count FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"))
def _(spark, d):
    return P.top_k(P.ip_counts(sessions(spark, d)), "src_ip", 20)


@query("sort_desc", O.on_sessions("""SELECT command_type, count, row_number() OVER (ORDER BY count DESC, command_type)::INTEGER AS position
    FROM types""", TYPES))
def _(spark, d):
    """Seven rows, so their position comes from an unpartitioned window."""
    ordered = P.command_type_counts(sessions(spark, d))
    return ordered.withColumn("position", F.row_number().over(W.orderBy(F.desc("count"), "command_type")))


@query("head_n", O.on_sessions("SELECT session_id, duration, command_count FROM s ORDER BY session_id LIMIT 5"))
def _(spark, d):
    return sinks.sample_rows(sessions(spark, d).select("session_id", "duration", "command_count"), "session_id")


@query("sink_sample", O.on_sessions("SELECT session_id, duration, command_count, threat_level FROM s ORDER BY session_id LIMIT 5"))
def _(spark, d):
    path = scratch_path(spark, "sample")
    first = sinks.sample_rows(sessions(spark, d).select("session_id", "duration", "command_count", "threat_level"), "session_id")
    sinks.write_table(first, path)
    return sinks.read_table(spark, path)


# --- scalar functions -------------------------------------------------------------------------

@query("joined_commands", O.on_log("""SELECT session AS session_id, ord AS position,
    CASE WHEN ord = min(ord) OVER (PARTITION BY session) THEN '' ELSE ' | ' END || coalesce(input, '') AS piece
    FROM log WHERE eventid = 'cowrie.command.input'"""))
def _(spark, d):
    return SE.joined_commands(raw(spark, d))


@query("split_commands", O.on_log("""SELECT ord AS position, len(string_split(text, ' | '))::INTEGER AS pieces, string_split(text, ' | ')[-1] AS last_piece
    FROM (SELECT ord, repeat(input || ' | ', (ord % 4)::INTEGER) || input AS text FROM log WHERE eventid = 'cowrie.command.input')"""))
def _(spark, d):
    from wardlog.functions import split_commands

    typed = SE.commands(raw(spark, d))
    text = F.concat(F.expr("repeat(input || ' | ', int(position % 4))"), "input")
    pieces = typed.withColumn("p", split_commands(text))
    return pieces.select("position", F.size("p").alias("pieces"), F.element_at("p", -1).alias("last_piece"))


@query("list_length", O.on_log("""SELECT ord AS position, (ord % 4)::INTEGER AS json_length, (ord % 4)::INTEGER AS printed_length,
    2::INTEGER AS map_length, 0::INTEGER AS plain_length FROM log WHERE event_type IN ('signup', 'error')"""))
def _(spark, d):
    """Lengths of a list stored as JSON and as a printed Python list: 0 to 3 times an entry."""
    logins = SE.session_entries(raw(spark, d)).where("list = 'login_attempts'")
    entry = F.struct("username", "password", "success")
    entries = F.filter(F.array_repeat(entry, 3), lambda _, i: i < F.col("position") % 4)

    def printed(a):
        return F.concat(F.lit("{'username': '"), a["username"], F.lit("', 'end': None, 'success': "),
                        F.when(a["success"], "True").otherwise("False"), F.lit("}"))

    text = F.concat(F.lit("["), F.array_join(F.transform(entries, printed), ", "), F.lit("]"))
    return logins.select(
        "position", list_length(F.to_json(entries)).alias("json_length"), list_length(text).alias("printed_length"),
        list_length(F.concat(F.lit("{'a': True, 'b': '"), "session_id", F.lit("'}"))).alias("map_length"),
        list_length(F.col("session_id")).alias("plain_length"),
    )


@query("to_numeric_coerce", """SELECT event_id, CASE event_id % 6 WHEN 1 THEN value WHEN 3 THEN 1000.0 WHEN 4 THEN 1e17 ELSE 0.0 END::DOUBLE AS number,
    CASE event_id % 6 WHEN 1 THEN trunc(value)::INTEGER WHEN 3 THEN 1000 ELSE 0 END::INTEGER AS whole FROM events""")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    kind = F.col("event_id") % 6
    text = F.when(kind == 0, F.col("event_type")).when(kind == 1, F.col("value").cast("string")).when(kind == 3, F.lit("1e3")).when(
        kind == 4, F.lit("1e17")).when(kind == 5, F.lit("Infinity"))
    return e.select("event_id", number_or_zero(text).alias("number"), int_or_zero(text).alias("whole"))


@query("fillna0", O.on_sessions("""SELECT session_id, coalesce(CASE WHEN end_time IS NOT NULL THEN duration END, 0.0)::DOUBLE AS duration,
    CASE threat_level WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END::INTEGER AS target FROM s"""))
def _(spark, d):
    s = sessions(spark, d)
    gaps = s.select("session_id", F.when(F.col("end_time").isNotNull(), F.col("duration")).alias("duration"),
                    F.when(F.col("threat_level") != "low", F.col("threat_code")).alias("target"))
    return gaps.na.fill(0).withColumn("target", F.col("target").cast("int"))


@query("parse_ts", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE hour(ts) END::INTEGER AS hour FROM events""")
def _(spark, d):
    text = F.when(F.col("ord") % 5 == 0, F.concat(F.lit("bad "), "timestamp")).otherwise(F.col("timestamp"))
    out = raw(spark, d).select(F.col("ord").alias("event_id"), parse_ts(text).alias("ts"))
    return out.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"),
        F.to_date("ts").cast("string").alias("day"), F.hour("ts").alias("hour"),
    )


@query("day_hour", """SELECT strftime(ts, '%Y-%m-%d') AS day, hour(ts)::INTEGER AS hour, count(*) AS count FROM events GROUP BY ALL""")
def _(spark, d):
    ts = parse_ts("timestamp")
    cells = events(spark, d).groupBy(day(ts).alias("day"), hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("count"))
    return _plain_day(cells)


@query("dict_get_default", O.on_log("""SELECT ord AS event_id, coalesce(username, '') AS username, coalesce(input, '-') AS input,
    coalesce(duration, 0.0)::DOUBLE AS duration FROM log"""))
def _(spark, d):
    return raw(spark, d).select(
        F.col("ord").alias("event_id"), text_or_empty("username").alias("username"),
        F.coalesce("input", F.lit("-")).alias("input"), number_or_zero("duration").alias("duration"),
    )


@query("bool_to_int", O.on_sessions("SELECT session_id, login_success::INTEGER AS login_success, (end_time IS NOT NULL)::INTEGER AS closed FROM s"))
def _(spark, d):
    return sessions(spark, d).select(
        "session_id", F.col("login_success").cast("int").alias("login_success"), F.col("end_time").isNotNull().cast("int").alias("closed"))


@query("now", O.on_sessions("SELECT session_id, true AS later_than_start FROM s"))
def _(spark, d):
    """The decision time lies after every session's start."""
    return sessions(spark, d).select("session_id", (F.current_timestamp() > parse_instant("start_time")).alias("later_than_start"))


@query("percent", """SELECT user_id, count(*) FILTER (event_type = 'error')::DOUBLE / count(*)::DOUBLE * 100 AS error_share,
    count(*) FILTER (event_type = 'error')::DOUBLE / nullif(count(*) FILTER (event_type = 'signup'), 0)::DOUBLE * 100 AS per_signup
    FROM events GROUP BY user_id""")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("event_type") == "signup").alias("signups"), F.count(F.lit(1)).alias("n"))
    return e.select("user_id", percent(F.col("errors"), F.col("n")).alias("error_share"),
                    percent(F.col("errors"), F.col("signups")).alias("per_signup"))


@query("noise", O.on_sessions("""SELECT session_id, round(command_count + sqrt(-2 * ln(ua)) * cos(ub * 2 * pi()) * 0.05, 6) AS command_count
    FROM (SELECT session_id, command_count,
      (('0x' || substr(md5('42|' || session_id || '|command_counta'), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS ua,
      (('0x' || substr(md5('42|' || session_id || '|command_countb'), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS ub FROM s)"""))
def _(spark, d):
    out = SA.with_noise(sessions(spark, d), ["command_count"], "session_id")
    return out.select("session_id", F.round("command_count", 6).alias("command_count"))


@query("map_key_parse", O.on_sessions("""SELECT DISTINCT threat_code, least(command_count, 3)::INTEGER AS cluster,
    threat_code AS response_level, threat_code AS named_level FROM s"""))
def _(spark, d):
    """Both text forms of the map, written and parsed again."""
    mapping = R.response_map(labelled(spark, d))
    numbers = R.map_from_keys(R.map_to_keys(mapping))
    names = R.map_from_keys(R.map_to_keys(mapping, named=True)).withColumnRenamed("response_level", "named_level")
    seen = labelled(spark, d).select("threat_code", "cluster").distinct()
    return numbers.join(names, ["threat_code", "cluster"]).join(seen, ["threat_code", "cluster"], "left_semi")


@query("label_prettify", O.on_sessions("""SELECT command_type, CASE command_type WHEN 'privilege_escalation' THEN 'Privilege Escalation'
    WHEN 'file_access' THEN 'File Access' ELSE upper(command_type[1]) || command_type[2:] END AS label, count FROM types""", TYPES))
def _(spark, d):
    return P.command_type_counts(sessions(spark, d)).withColumn("label", prettify(F.col("command_type")))


@query("json_record", O.on_sessions("""SELECT session_id, src_ip, threat_code AS threat_level, least(command_count, 3)::INTEGER AS cluster,
    threat_code AS response_level, login_success::INTEGER AS feature_login, command_count AS feature_commands, duration AS feature_duration,
    has_persistence AS feature_persistence FROM s"""))
def _(spark, d):
    scored = scoring.score_with_rules(sessions(spark, d), F.least("command_count", F.lit(3)), R.response_map(labelled(spark, d)))
    record = R.decision_record(scored, F.current_timestamp())

    def part(name):
        return F.get_json_object("features", f"$.{name}")

    return record.select(
        "session_id", "src_ip", "threat_level", "cluster", "response_level",
        part("login_success").cast("int").alias("feature_login"), part("command_count").cast("bigint").alias("feature_commands"),
        part("duration").cast("double").alias("feature_duration"), part("has_persistence").cast("int").alias("feature_persistence"),
    )


# --- response ---------------------------------------------------------------------------------

def labelled(spark, d):
    """Sessions with a cluster number; the checked queries use the command count up to 3."""
    return kept(spark, d).withColumn("cluster", F.least("command_count", F.lit(3)).cast("int"))


LABELLED = """,
labelled AS (SELECT *, least(command_count, 3)::INTEGER AS cluster FROM s),
grid AS (SELECT t.threat_code, c.cluster FROM (SELECT DISTINCT threat_code FROM labelled) t CROSS JOIN (SELECT DISTINCT cluster FROM labelled) c),
plain AS (SELECT *, threat_code AS response_level, CASE threat_code WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS strategy FROM grid),
ruled AS (SELECT *, CASE WHEN threat_code > 0 THEN threat_code WHEN cluster IN (0, 2) THEN 1 ELSE 0 END::INTEGER AS response_level FROM grid)"""


@query("response_grid", O.on_sessions("SELECT * FROM grid", LABELLED))
def _(spark, d):
    return R.response_grid(labelled(spark, d))


@query("response_map", O.on_sessions("SELECT * FROM plain", LABELLED))
def _(spark, d):
    return R.response_map(labelled(spark, d))


@query("response_map_cluster_rule", O.on_sessions("""SELECT *, CASE response_level WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS strategy
    FROM ruled""", LABELLED))
def _(spark, d):
    return R.response_map_cluster_rule(labelled(spark, d))


@query("response_lookup", O.on_sessions("""SELECT session_id, threat_code, cluster, CASE WHEN threat_code < 2 THEN response_level ELSE 0 END AS response_level
    FROM labelled JOIN ruled USING (threat_code, cluster)""", LABELLED))
def _(spark, d):
    """The map without its rows for high threat, so that the default is used as well."""
    rows = labelled(spark, d)
    partial = R.response_map_cluster_rule(rows).where(F.col("threat_code") < 2)
    return R.response_lookup(rows, partial).select("session_id", "threat_code", "cluster", "response_level")


@query("strategy_decode", O.on_sessions("""SELECT session_id, command_count, CASE command_count WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'low' END AS strategy
    FROM s"""))
def _(spark, d):
    return R.strategy_decode(sessions(spark, d), "command_count").select("session_id", "command_count", "strategy")


@query("response_report_table", O.on_sessions("""SELECT CASE threat_code WHEN 2 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS threat_level, cluster,
    CASE response_level WHEN 2 THEN 'High Interaction' WHEN 1 THEN 'Medium Interaction' ELSE 'Low Interaction' END AS response_strategy FROM ruled""", LABELLED))
def _(spark, d):
    return R.report_table(R.response_map_cluster_rule(labelled(spark, d)))


@query("unseen_sessions", O.on_sessions("""SELECT session_id, end_time FROM s WHERE end_time IS NOT NULL
    AND substr(start_time, 1, 10) > '2024-01-15'"""))
def _(spark, d):
    s = sessions(spark, d)
    processed = s.where(F.substring("start_time", 1, 10) <= "2024-01-15")
    return E.unseen(s, processed).select("session_id", "end_time")


# --- splits, folds, repair ----------------------------------------------------------------------

@query("class_distribution", O.on_sessions("SELECT threat_code AS label, count(*) AS count FROM s GROUP BY 1"))
def _(spark, d):
    return SA.class_counts(kept(spark, d).withColumnRenamed("threat_code", "label"))


@query("distinct_classes", O.on_sessions("""SELECT count(DISTINCT threat_score) AS classes, min(n) AS smallest, min(n) < 10 AS stratify,
    count(DISTINCT threat_score) < 2 AS single FROM (SELECT threat_score, count(*) AS n FROM s GROUP BY 1)"""))
def _(spark, d):
    counts = SA.class_counts(kept(spark, d), "threat_score")
    return counts.agg(
        F.count(F.lit(1)).alias("classes"), F.min("count").alias("smallest"), (F.min("count") < 10).alias("stratify"),
        (F.count(F.lit(1)) < 2).alias("single"),
    )


@query("stratified_split", O.on_sessions("""SELECT session_id, threat_code,
    row_number() OVER (PARTITION BY threat_code ORDER BY md5('42|' || session_id), session_id)
      <= floor(count(*) OVER (PARTITION BY threat_code) * 0.25::DOUBLE + 0.5) AS is_test FROM s"""))
def _(spark, d):
    return SA.stratified_split(kept(spark, d).select("session_id", "threat_code"), "threat_code", "session_id")


@query("stratified_split_labels", """SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || doc_id), doc_id)
      <= floor(count(*) OVER (PARTITION BY quality) * 0.25::DOUBLE + 0.5) AS is_test FROM labels""")
def _(spark, d):
    return SA.stratified_split(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), "quality", "doc_id")


PLAIN = "row_number() OVER (ORDER BY md5('42|' || session_id), session_id) <= floor(count(*) OVER () * {share}::DOUBLE + 0.5)"


@query("random_split", O.on_sessions(f"SELECT session_id, {PLAIN.format(share=0.25)} AS is_test FROM s"))
def _(spark, d):
    return SA.random_split(kept(spark, d).select("session_id"), "session_id")


@query("kfold_assign", O.on_sessions("""SELECT session_id, threat_code,
    (ntile(5) OVER (PARTITION BY threat_code ORDER BY md5('42|' || session_id), session_id) - 1)::INTEGER AS fold FROM s"""))
def _(spark, d):
    return SA.kfold(kept(spark, d).select("session_id", "threat_code"), "threat_code", "session_id")


@query("kfold_assign_embeddings", """SELECT vec_id, label,
    (ntile(5) OVER (PARTITION BY label ORDER BY md5('42|' || vec_id), vec_id) - 1)::INTEGER AS fold FROM embeddings""")
def _(spark, d):
    return SA.kfold(spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "label"), "label", "vec_id")


# A small test share over 23 score classes leaves some of them out of the test rows.
REPAIR = f""",
split AS (SELECT session_id, threat_score AS label, {PLAIN.format(share=0.02)} AS is_test FROM s),
lack AS (SELECT label, count(*) FILTER (NOT is_test) AS n FROM split GROUP BY label HAVING NOT bool_or(is_test)),
moved AS (
  SELECT session_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || session_id), session_id) AS r
    FROM split WHERE NOT is_test) JOIN lack USING (label) WHERE r <= 5 AND r <= floor(n * 0.1::DOUBLE)
)"""


def rare_split(spark, d):
    rows = kept(spark, d).select("session_id", F.col("threat_score").alias("label"))
    return SA.random_split(rows, "session_id", test_size=0.02)


@query("missing_classes", O.on_sessions("""SELECT label, bool_or(is_test) AS in_test, bool_or(NOT is_test) AS in_train FROM split GROUP BY label
    HAVING NOT bool_or(is_test) OR NOT bool_or(NOT is_test)""", REPAIR))
def _(spark, d):
    return SA.missing_classes(rare_split(spark, d))


@query("repair_test_classes", O.on_sessions("SELECT session_id, label FROM moved", REPAIR))
def _(spark, d):
    return SA.repaired_rows(rare_split(spark, d), id_col="session_id").select("session_id", "label")


@query("except_moved", O.on_sessions("""SELECT session_id, label FROM split WHERE NOT is_test
    AND session_id NOT IN (SELECT session_id FROM moved)""", REPAIR))
def _(spark, d):
    return SA.repair_test_classes(rare_split(spark, d), id_col="session_id").where(~F.col("is_test")).drop("is_test")


@query("union_augmented", O.on_sessions("""SELECT session_id, label FROM split WHERE is_test
    UNION ALL SELECT session_id, label FROM moved""", REPAIR))
def _(spark, d):
    return SA.repair_test_classes(rare_split(spark, d), id_col="session_id").where("is_test").drop("is_test")


# Both branches and the repair, whichever the classes ask for.
IMPROVED = """,
labelled AS (SELECT session_id, {label} AS label FROM s),
small AS (SELECT min(n) BETWEEN 2 AND 9 AS stratified FROM (SELECT count(*) AS n FROM labelled GROUP BY label)),
first AS (
  SELECT session_id, label, CASE WHEN (SELECT stratified FROM small)
    THEN row_number() OVER (PARTITION BY label ORDER BY md5('42|' || session_id), session_id) <= floor(count(*) OVER (PARTITION BY label) * {share}::DOUBLE + 0.5)
    ELSE row_number() OVER (ORDER BY md5('42|' || session_id), session_id) <= floor(count(*) OVER () * {share}::DOUBLE + 0.5) END AS is_test
  FROM labelled
),
lacking AS (SELECT label, count(*) AS n FROM first GROUP BY label HAVING NOT bool_or(is_test)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label, is_test ORDER BY md5('42|' || session_id), session_id) AS r FROM first)
"""
IMPROVED_SELECT = "SELECT session_id, ranked.label, is_test OR coalesce(r <= 5 AND r <= floor(n * 0.1::DOUBLE), false) AS is_test FROM ranked LEFT JOIN lacking USING (label)"
FEW = "CASE WHEN row_number() OVER (ORDER BY session_id) <= 5 THEN 9 ELSE threat_code END"


@query("improved_split", O.on_sessions(IMPROVED_SELECT, IMPROVED.format(label="threat_code", share=0.25)))
def _(spark, d):
    """Three large classes: the plain split."""
    rows = kept(spark, d).select("session_id", F.col("threat_code").alias("label"))
    return SA.improved_split(rows, id_col="session_id")


@query("improved_split_stratified", O.on_sessions(IMPROVED_SELECT, IMPROVED.format(label=FEW, share=0.25)))
def _(spark, d):
    """A class of five rows: the stratified split."""
    s = kept(spark, d).select("session_id", F.col("threat_code").alias("label"))
    few = sinks.sample_rows(s, "session_id", 5).select("session_id", F.lit(9).alias("label"))
    rows = few.unionByName(s.join(few, "session_id", "left_anti"))
    return SA.improved_split(materialize(rows), id_col="session_id")


@query("improved_split_repair", O.on_sessions(IMPROVED_SELECT, IMPROVED.format(label="threat_score", share=0.02)))
def _(spark, d):
    """Many classes and few test rows: classes that the test rows lack are moved there."""
    rows = kept(spark, d).select("session_id", F.col("threat_score").alias("label"))
    return SA.improved_split(rows, id_col="session_id", test_size=0.02)


@query("synthesize_minority_several_classes", O.on_sessions("SELECT session_id, threat_code AS label FROM s"))
def _(spark, d):
    """A table of several classes stays as it is."""
    return SA.synthesize_minority(kept(spark, d).select("session_id", F.col("threat_code").alias("label")), id_col="session_id")


@query("synthesize_minority", O.on_sessions("""SELECT session_id, command_count, 0::INTEGER AS label FROM low
    UNION ALL SELECT low.session_id, low.command_count, 1 FROM draws JOIN low ON draws.pick = low.i""", """,
low AS (SELECT session_id, command_count, row_number() OVER (ORDER BY md5('42|' || session_id), session_id) - 1 AS i,
    count(*) OVER () AS n FROM s WHERE threat_level = 'low'),
draws AS (SELECT ('0x' || substr(md5('42|draw|' || j), 1, 15))::BIGINT % (SELECT max(n) FROM low) AS pick
  FROM (SELECT unnest(range(greatest(5, floor((SELECT max(n) FROM low) * 0.1::DOUBLE)::BIGINT))) AS j))"""))
def _(spark, d):
    low = kept(spark, d).where(F.col("threat_level") == "low")
    return SA.synthesize_minority(low.select("session_id", "command_count", F.lit(0).alias("label")), id_col="session_id")


# --- preparation ----------------------------------------------------------------------------------

@query("impute_median", O.on_sessions("""SELECT 'duration' AS feature, median(CASE WHEN end_time IS NOT NULL THEN duration END)::DOUBLE AS median FROM s
    UNION ALL SELECT 'event_count', median(event_count)::DOUBLE FROM s
    UNION ALL SELECT 'threat_score', median(threat_score)::DOUBLE FROM s"""))
def _(spark, d):
    s = kept(spark, d).withColumn("duration", F.when(F.col("end_time").isNotNull(), F.col("duration")))
    return SC.exact_medians(s, ["duration", "event_count", "threat_score"])


@query("impute_fill", O.on_sessions("""SELECT session_id, coalesce(CASE WHEN end_time IS NOT NULL THEN duration END,
    (SELECT median(duration) FROM s WHERE end_time IS NOT NULL))::DOUBLE AS duration FROM s"""))
def _(spark, d):
    s = kept(spark, d).select("session_id", F.when(F.col("end_time").isNotNull(), F.col("duration")).alias("duration"))
    medians = {r["feature"]: r["median"] for r in SC.exact_medians(s, ["duration"]).collect()}
    return SC.impute(s, medians)


@query("standard_scale", O.on_sessions("""SELECT session_id,
    round((duration - (SELECT avg(duration) FROM s)) / (SELECT stddev_pop(duration) FROM s), 6) AS duration,
    round((command_count - (SELECT avg(command_count) FROM s)) / (SELECT stddev_pop(command_count) FROM s), 6) AS command_count,
    0.0::DOUBLE AS constant FROM s"""))
def _(spark, d):
    s = kept(spark, d).select("session_id", "duration", "command_count", F.lit(7).alias("constant"))
    columns = ["duration", "command_count", "constant"]
    out = SC.standard_scale(s, columns)
    return out.select("session_id", *[F.round(c, 6).alias(c) for c in columns])


# --- metrics over a prediction table -----------------------------------------------------------------

def guesses(spark, d):
    """(session_id, label, position, model, prediction): three simple rules as models."""
    s = kept(spark, d)
    flags = F.col("has_download_command") + F.col("has_persistence") + F.col("has_privilege_escalation")
    rules = [
        (0, "by_commands", F.least("command_count", F.lit(2))),
        (1, "by_login", F.col("login_success").cast("int") * 2),
        (2, "by_flags", F.least(flags, F.lit(2))),
    ]
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("model"), p.cast("int").alias("prediction")) for i, n, p in rules
    ]
    return s.select("session_id", F.col("threat_code").alias("label"), F.explode(F.array(*entries)).alias("g")).select(
        "session_id", "label", "g.*")


RULES = ["by_commands", "by_login", "by_flags"]


def rule_metrics(spark, d, measure=M.weighted_metrics):
    g = guesses(spark, d)
    return reduce(DataFrame.unionByName, [
        measure(g.where(F.col("model") == n)).withColumns({"model": F.lit(n), "position": F.lit(i)}) for i, n in enumerate(RULES)
    ])


def rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


ROUND4 = ", ".join(f"round({m}, 9) AS {m}" for m in M.WEIGHTED)


def by_rule(spark, d, measure):
    """A table per rule, one below the other."""
    g = guesses(spark, d)
    return reduce(DataFrame.unionByName, [measure(g.where(F.col("model") == n)).withColumn("model", F.lit(n)) for n in RULES])


@query("confusion_matrix", f"WITH {O.GUESSES} SELECT model, label, prediction, n AS count FROM cells")
def _(spark, d):
    return by_rule(spark, d, M.confusion_matrix)


@query("metrics_weighted", f"WITH {O.GUESSES} SELECT model, {ROUND4} FROM weighted")
def _(spark, d):
    return rounded(rule_metrics(spark, d).drop("position"))


@query("metrics_macro", f"WITH {O.GUESSES} SELECT model, {ROUND4} FROM macro")
def _(spark, d):
    return rounded(rule_metrics(spark, d, M.macro_metrics).drop("position"))


@query("metrics_per_class", f"""WITH {O.GUESSES}
    SELECT model, class::VARCHAR AS name, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM per_class
    UNION ALL SELECT model, 'macro avg', round(precision, 9), round(recall, 9), round(f1, 9), (SELECT count(*) FROM s) FROM macro
    UNION ALL SELECT model, 'weighted avg', round(precision, 9), round(recall, 9), round(f1, 9), (SELECT count(*) FROM s) FROM weighted
    UNION ALL SELECT model, 'accuracy', NULL, NULL, round(accuracy, 9), (SELECT count(*) FROM s) FROM weighted""")
def _(spark, d):
    return rounded(by_rule(spark, d, M.classification_report))


def scores(spark, d):
    s = kept(spark, d)
    entries = [
        (0, F.lit(1.0) / (1 + F.col("event_count"))),
        (1, F.col("login_attempt_count").cast("double") / F.col("event_count")),
        (2, F.col("event_count") + F.lit(0.5) * F.col("command_count") + F.col("duration") / 1000),
    ]
    array = F.array(*[F.struct(F.lit(c).alias("class"), v.cast("double").alias("score")) for c, v in entries])
    return s.select(F.col("threat_code").alias("label"), F.explode(array).alias("e")).select("e.class", "label", "e.score")


@query("roc_points", f"""WITH {O.SCORES} SELECT class, score AS threshold, cum_neg::DOUBLE / all_neg AS fpr, cum_pos::DOUBLE / all_pos AS tpr FROM run
    UNION ALL SELECT DISTINCT class, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM run""")
def _(spark, d):
    return M.roc_points(scores(spark, d))


@query("roc_auc", f"""WITH {O.SCORES}, curve AS (
      SELECT class, cum_neg::DOUBLE / all_neg AS fpr, cum_pos::DOUBLE / all_pos AS tpr, score FROM run
      UNION ALL SELECT DISTINCT class, 0.0::DOUBLE, 0.0::DOUBLE, 1e300 FROM run),
    gaps AS (SELECT class, fpr - lag(fpr) OVER w AS width, (tpr + lag(tpr) OVER w) / 2 AS height FROM curve WINDOW w AS (PARTITION BY class ORDER BY score DESC))
    SELECT class, round(sum(width * height), 9) AS auc FROM gaps GROUP BY class""")
def _(spark, d):
    return rounded(M.roc_auc(scores(spark, d)))


@query("roc_auc_documents", """WITH j AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id))
    SELECT 1::INTEGER AS class, round((sum(CASE WHEN a.n_chars > b.n_chars THEN 1.0 WHEN a.n_chars = b.n_chars THEN 0.5 ELSE 0.0 END)
      / count(*))::DOUBLE, 9) AS auc FROM j a, j b WHERE a.quality = 1 AND b.quality = 0""")
def _(spark, d):
    """Length as a score for the quality label of documents."""
    lengths = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "n_chars")
    rows = spark.read.parquet(f"{d}/labels.parquet").join(lengths, "doc_id")
    return rounded(M.roc_auc(rows.select(F.lit(1).alias("class"), F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"))))


@query("best_model", f"""WITH {O.GUESSES} SELECT model, round(f1, 9) AS f1 FROM weighted
    JOIN (SELECT DISTINCT model, position FROM guess) USING (model) ORDER BY weighted.f1 DESC, position LIMIT 1""")
def _(spark, d):
    return rounded(M.best_model(rule_metrics(spark, d)))


@query("model_leaderboard", f"""WITH {O.GUESSES} SELECT model, {ROUND4}, row_number() OVER (ORDER BY f1 DESC, model)::INTEGER AS rank FROM weighted""")
def _(spark, d):
    """One row per model."""
    board = M.leaderboard(rule_metrics(spark, d).drop("position"))
    return rounded(board.withColumn("rank", F.row_number().over(W.orderBy(F.desc("f1"), "model"))))


@query("align_metrics", f"""WITH {O.GUESSES} SELECT w.model, round(w.accuracy, 9) AS accuracy, round(w.f1, 9) AS f1, round(m.accuracy, 9) AS cv_accuracy,
    round(m.precision, 9) AS cv_precision, round(m.recall, 9) AS cv_recall, round(m.f1, 9) AS cv_f1 FROM weighted w FULL JOIN macro m USING (model)""")
def _(spark, d):
    both = M.align_metrics(rule_metrics(spark, d).drop("position"), rule_metrics(spark, d, M.macro_metrics))
    return rounded(both.drop("precision", "recall"))


@query("sink_metrics", f"WITH {O.GUESSES}, w AS (SELECT model, {ROUND4} FROM weighted) UNPIVOT w ON {', '.join(M.WEIGHTED)} INTO NAME metric VALUE value")
def _(spark, d):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(rounded(rule_metrics(spark, d).drop("position")), path)
    return sinks.read_table(spark, path)


@query("scan_metrics", f"""WITH {O.GUESSES} SELECT model, {ROUND4} FROM weighted""")
def _(spark, d):
    path = scratch_path(spark, "metrics-json")
    sinks.write_json(rounded(rule_metrics(spark, d).drop("position")), path)
    return spark.read.schema("model string, " + ", ".join(f"{m} double" for m in M.WEIGHTED)).json(path)


# Inertia of grouping sessions by min(event_count, k), as a stand-in for fitted clusters.
INERTIA = """,
inertia AS (
  SELECT k, sum((n * sxx - sx * sx)::DOUBLE / n) AS inertia FROM (
    SELECT k, least(event_count, k) AS g, count(*) AS n, sum(event_count) AS sx, sum(event_count * event_count) AS sxx
    FROM s, (SELECT unnest(range(2, 11)) AS k) GROUP BY ALL) GROUP BY k)"""


def simple_inertia(spark, d):
    sizes = kept(spark, d).groupBy(F.col("event_count").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(10)))).groupBy("k", F.least("x", "k").alias("g")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("x")).alias("sx"), F.sum(F.col("n") * F.col("x") * F.col("x")).alias("sxx"))
    part = (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double") / F.col("n")
    return groups.groupBy("k").agg(F.sum(part).alias("inertia"))


@query("elbow_k", O.on_sessions("""SELECT k::INTEGER AS k, round(bend, 6) AS bend FROM (
    SELECT k, abs(lead(inertia) OVER (ORDER BY k) - 2 * inertia + lag(inertia) OVER (ORDER BY k)) AS bend FROM inertia)
    WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1""", INERTIA))
def _(spark, d):
    return M.elbow(simple_inertia(spark, d)).select("k", F.round("bend", 6).alias("bend"))


# --- chart tables -----------------------------------------------------------------------------------

@query("chart_event_distribution", O.on_log("""SELECT eventid AS event_id, count(*)::DOUBLE / (SELECT count(*) FROM log) * 100 AS percentage
    FROM log GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""))
def _(spark, d):
    return C.event_bars(events(spark, d))


@query("chart_login_outcomes", O.on_log(f"""SELECT 'Failed' AS outcome, failed_logins AS count, 100 - success_rate AS percentage FROM ({LOGIN_SQL})
    UNION ALL SELECT 'Successful', successful_logins, success_rate FROM ({LOGIN_SQL})"""))
def _(spark, d):
    return C.login_outcomes(events(spark, d))


@query("chart_credentials", f"WITH {O.LOG}{CREDENTIALS} SELECT field, value, count FROM top_cred WHERE rank <= 10 AND outcome = 'success'")
def _(spark, d):
    return C.credential_bars(events(spark, d))


PRETTY = "array_to_string(list_transform(string_split(command_type, '_'), lambda w: upper(w[1]) || w[2:]), ' ')"


@query("chart_command_types", O.on_sessions(
    f"SELECT {PRETTY} AS label, count::DOUBLE / (SELECT sum(count) FROM types)::DOUBLE * 100 AS percentage FROM types", TYPES))
def _(spark, d):
    return C.command_type_bars(sessions(spark, d))


@query("chart_top_commands", O.on_tokens("SELECT command, count(*) AS count FROM tok GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"))
def _(spark, d):
    return C.command_bars(tokens(spark, d))


@query("chart_threat_levels", O.on_sessions(f"SELECT threat_level, percentage FROM ({LEVEL_SHARE_SQL})"))
def _(spark, d):
    return C.threat_level_bars(sessions(spark, d))


@query("chart_threat_metric", O.on_sessions(" UNION ALL ".join(
    f"SELECT threat_level, '{m}' AS metric, '{m.replace('_', ' ').title()}' AS label, {m} AS value FROM levels" for m in C.LEVEL_METRICS), CHARACTER))
def _(spark, d):
    return C.threat_metric_bars(sessions(spark, d))


@query("chart_temporal", O.on_sessions("""SELECT 'sessions_by_day' AS series, substr(start_time, 1, 10) AS x, count(*) AS count FROM s GROUP BY 2
    UNION ALL SELECT 'sessions_by_hour', (substr(start_time, 12, 2)::INTEGER)::VARCHAR, count(*) FROM s GROUP BY 2
    UNION ALL SELECT 'events_by_day', strftime(ts, '%Y-%m-%d'), count(*) FROM log GROUP BY 2
    UNION ALL SELECT 'events_by_hour', hour(ts)::VARCHAR, count(*) FROM log GROUP BY 2"""))
def _(spark, d):
    return C.temporal_series(kept(spark, d), events(spark, d))


@query("chart_ip_threat_stack", O.on_sessions(
    f"SELECT src_ip, low_threat AS low, medium_threat AS medium, high_threat AS high FROM ({IP_SQL.format(k=10)})"))
def _(spark, d):
    return C.ip_threat_stack(sessions(spark, d))


@query("chart_model_comparison", f"""WITH {O.GUESSES} SELECT model, 'accuracy' AS metric, round(accuracy, 9) AS value FROM weighted
    UNION ALL SELECT model, 'precision', round(precision, 9) FROM weighted UNION ALL SELECT model, 'recall', round(recall, 9) FROM weighted
    UNION ALL SELECT model, 'f1', round(f1, 9) FROM weighted""")
def _(spark, d):
    return rounded(sinks.long_metrics(rule_metrics(spark, d).drop("position")))


@query("chart_confusion", f"""WITH {O.GUESSES} SELECT model, label, coalesce(sum(n) FILTER (prediction = 0), 0)::BIGINT AS "0",
    coalesce(sum(n) FILTER (prediction = 1), 0)::BIGINT AS "1", coalesce(sum(n) FILTER (prediction = 2), 0)::BIGINT AS "2"
    FROM cells GROUP BY model, label""")
def _(spark, d):
    cells = by_rule(spark, d, M.confusion_matrix)
    return cells.groupBy("model", "label").pivot("prediction", [0, 1, 2]).agg(F.sum("count")).na.fill(0)


@query("summary_metrics", O.on_tokens(f"""
    SELECT 'login' AS section, unnest(['total_attempts', 'successful_logins', 'success_rate', 'failed_logins', 'failure_rate']) AS metric,
      unnest([total_attempts::DOUBLE, successful_logins, success_rate, failed_logins, 100 - success_rate]) AS value FROM ({LOGIN_SQL})
    UNION ALL SELECT 'top_credentials', field || ':' || value, count FROM top_cred WHERE rank <= 5 AND outcome = 'success'
    UNION ALL SELECT 'commands', 'total_command_sessions', count(*) FROM s WHERE command_count > 0
    UNION ALL SELECT 'commands', 'total_commands', count(*) FROM tok
    UNION ALL SELECT 'commands', 'unique_commands', count(DISTINCT command) FROM tok
    UNION ALL SELECT 'command_type_count', {PRETTY}, count FROM types
    UNION ALL SELECT 'command_type_percentage', {PRETTY}, count::DOUBLE / (SELECT sum(count) FROM types)::DOUBLE * 100 FROM types
    UNION ALL (SELECT 'top_commands', command, count(*) FROM tok GROUP BY command ORDER BY count(*) DESC, command LIMIT 5)
    UNION ALL SELECT 'threat_count', threat_level, count FROM levels
    UNION ALL SELECT 'threat_percentage', threat_level, percentage FROM levels
    UNION ALL SELECT 'threat_' || threat_level, 'avg_command_count', avg_command_count FROM levels
    UNION ALL SELECT 'threat_' || threat_level, 'login_success_rate', login_success_rate FROM levels
    UNION ALL SELECT 'threat_high', 'has_download_command', has_download_command FROM levels WHERE threat_level = 'high'
    UNION ALL SELECT 'threat_high', 'has_privilege_escalation', has_privilege_escalation FROM levels WHERE threat_level = 'high'
    UNION ALL SELECT 'source_ips', 'unique_ips', count(DISTINCT src_ip) FROM s
    UNION ALL (SELECT 'top_source_ips', src_ip, count(*) FROM s GROUP BY src_ip ORDER BY count(*) DESC, src_ip LIMIT 5)""",
    CREDENTIALS + TYPES + CHARACTER))
def _(spark, d):
    frequency = materialize(P.command_frequency(tokens(spark, d)))
    return C.summary_metrics(kept(spark, d), events(spark, d), frequency=frequency)


# --- learning ------------------------------------------------------------------------------------------

# What fitted models give depends on the engine. Their queries return, per row, truth values that are computed
# from the result by another formula; the SQL has the rows and `true`.

def split_table(spark, d):
    def build():
        matrix = L.training_matrix(kept(spark, d), S.SERVING_FEATURES)
        return materialize(SA.stratified_split(L.store_rows(matrix)))
    return stored(spark, d, "split", build)


def parts(spark, d):
    table = split_table(spark, d)
    return table.where(~F.col("is_test")).drop("is_test"), table.where("is_test").drop("is_test")


def preparation(spark, d):
    return stored(spark, d, "preparation", lambda: L.fit_preparation(parts(spark, d)[0], S.SERVING_FEATURES))


def classifier(spark, d, name):
    return stored(spark, d, name, lambda: L.fit_classifier(
        name, parts(spark, d)[0], S.SERVING_FEATURES, preparation(spark, d)))


def clusters(spark, d):
    return stored(spark, d, "clusters", lambda: L.train_clusters(split_table(spark, d), S.SERVING_FEATURES))


SPLIT = """,
split AS (SELECT *, row_number() OVER (PARTITION BY threat_code ORDER BY md5('42|' || session_id), session_id)
    <= floor(count(*) OVER (PARTITION BY threat_code) * 0.25::DOUBLE + 0.5) AS is_test FROM s)"""


def scaled_sql(column):
    return f"""round((({column}) - (SELECT avg({column}) FROM split WHERE NOT is_test))
      / (SELECT stddev_pop({column}) FROM split WHERE NOT is_test), 6) AS "x_{column.split('::')[0]}\""""


ASSEMBLED = ["duration", "login_success::INTEGER", "command_count", *S.PATTERNS]


@query("assemble", O.on_sessions(f"SELECT session_id AS id, {', '.join(scaled_sql(c) for c in ASSEMBLED)} FROM split", SPLIT))
def _(spark, d):
    """The vector's entries: filled, scaled by the training rows."""
    ready = L.apply_stages(preparation(spark, d), split_table(spark, d)).withColumn("v", vector_to_array("features"))
    return ready.select("id", *[F.round(F.col("v")[i], 6).alias(f"x_{c}") for i, c in enumerate(S.SERVING_FEATURES)])


def majority_share(df):
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n") / F.sum("n")).first()[0]


def evaluated(predictions, macro=False):
    """The weighted metrics by another library, as numbers."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    doubles = predictions.select(F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    return {
        mine: MulticlassClassificationEvaluator(metricName=theirs).evaluate(doubles)
        for mine, theirs in zip(M.WEIGHTED, ("accuracy", "weightedPrecision", "weightedRecall", "f1"))
    }


def same(column, value):
    return F.abs(F.col(column) - F.lit(float(value))) < 1e-9


def judged(spark, d, name):
    """Metrics of a model on the test rows, and whether the other library agrees and a constant guess does worse."""
    test = parts(spark, d)[1]
    predictions = materialize(classifier(spark, d, name).transform(test).select("label", "prediction"))
    theirs = evaluated(predictions)
    return M.weighted_metrics(predictions).select(
        F.lit(name).alias("model"), reduce(lambda a, b: a & b, [same(m, v) for m, v in theirs.items()]).alias("metrics_agree"),
        (F.col("accuracy") > majority_share(test)).alias("beats_majority"), F.lit(predictions.count()).alias("rows"))


KEYS = {"logistic_regression": "clf_logistic", "neural_network": "clf_mlp"}
for _name in L.MODELS:
    query(KEYS.get(_name, f"clf_{_name}"), O.on_sessions(
        f"SELECT '{_name}' AS model, true AS metrics_agree, true AS beats_majority, count(*)::INTEGER AS rows FROM split WHERE is_test", SPLIT))(
        lambda spark, d, name=_name: judged(spark, d, name))


def all_models(spark, d):
    """Metrics of all six models."""
    def run():
        train, test = parts(spark, d)
        return materialize(L.bake_off(train, test, S.SERVING_FEATURES, preparation=preparation(spark, d), fit=partial(classifier, spark, d))[0])
    return stored(spark, d, "bake_off", run)


def folds(spark, d):
    return stored(spark, d, "folds", lambda: materialize(L.cross_validate(parts(spark, d)[0], S.SERVING_FEATURES)))


MODEL_LIST = ", ".join(f"({i}, '{n}')" for i, n in enumerate(L.MODELS))


@query("bake_off", f"SELECT position::INTEGER AS position, model, true AS metrics_agree, NULL::VARCHAR AS error FROM (VALUES {MODEL_LIST}) m(position, model)")
def _(spark, d):
    test, metrics = parts(spark, d)[1], all_models(spark, d)  # trains them side by side

    def measured(name):
        return name, evaluated(materialize(classifier(spark, d, name).transform(test).select("label", "prediction")))

    theirs = dict(at_once([partial(measured, n) for n in L.MODELS]))
    agree = F.lit(False)
    for n, values in theirs.items():
        agree = F.when(F.col("model") == n, reduce(lambda a, b: a & b, [same(m, v) for m, v in values.items()])).otherwise(agree)
    return metrics.select("position", "model", agree.alias("metrics_agree"), "error")


@query("best_fitted_model", "SELECT true AS is_model, true AS none_better")
def _(spark, d):
    best, metrics = M.best_model(all_models(spark, d)).first(), all_models(spark, d)
    return metrics.agg(
        F.max((F.col("model") == best["model"]) & (F.col("f1") == best["f1"])).alias("is_model"),
        F.min(F.col("f1") <= best["f1"]).alias("none_better"))


@query("cv_metrics", f"SELECT model, true AS in_range, true AS beats_majority FROM (VALUES {MODEL_LIST}) m(position, model)")
def _(spark, d):
    found = folds(spark, d)
    ranges = [F.col(m).between(0, 1) & F.col(f"{m}_std").between(0, 0.5) for m in M.WEIGHTED]
    return found.select("model", reduce(lambda a, b: a & b, ranges).alias("in_range"),
                        (F.col("accuracy") > majority_share(parts(spark, d)[0])).alias("beats_majority"))


@query("chart_cv_comparison", f"""SELECT model, unnest(['accuracy', 'precision', 'recall', 'f1', 'cv_accuracy', 'cv_precision', 'cv_recall', 'cv_f1']) AS metric,
    true AS as_measured FROM (VALUES {MODEL_LIST}) m(position, model)""")
def _(spark, d):
    """Cross-validation means next to the hold-out metrics, long form."""
    both = M.align_metrics(all_models(spark, d).drop("position", "error"), folds(spark, d))
    held = all_models(spark, d).unpivot("model", M.WEIGHTED, "metric", "expected")
    crossed = folds(spark, d).unpivot("model", M.WEIGHTED, "metric", "expected").withColumn("metric", F.concat(F.lit("cv_"), "metric"))
    bars = sinks.long_metrics(both).where(F.col("value").isNotNull())
    return bars.join(held.unionByName(crossed), ["model", "metric"]).select("model", "metric", (F.col("value") == F.col("expected")).alias("as_measured"))


@query("predict", O.on_sessions("SELECT session_id AS id, threat_code AS label, true AS most_likely, true AS sums_to_one FROM split WHERE is_test", SPLIT))
def _(spark, d):
    scored = classifier(spark, d, "random_forest").transform(parts(spark, d)[1])
    largest = F.array_max("probabilities")
    return scored.select("id", "label", (F.element_at("probabilities", F.col("prediction") + 1) == largest).alias("most_likely"),
                         (F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p) - 1) < 1e-9).alias("sums_to_one"))


@query("predict_proba", O.on_sessions("SELECT session_id AS id, 3 AS classes, true AS in_range, true AS sums_to_one FROM split WHERE is_test", SPLIT))
def _(spark, d):
    scored = classifier(spark, d, "logistic_regression").transform(parts(spark, d)[1])
    return scored.select("id", F.size("probabilities").alias("classes"), F.forall("probabilities", lambda p: p.between(0, 1)).alias("in_range"),
                         (F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p) - 1) < 1e-9).alias("sums_to_one"))


@query("chart_roc", O.on_sessions("SELECT DISTINCT threat_code AS class, true AS never_falls, true AS area_agrees FROM split WHERE is_test", SPLIT))
def _(spark, d):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    model = classifier(spark, d, "random_forest")
    scored = materialize(L.class_scores(model.transform(parts(spark, d)[1]), model.classes))
    order = W.partitionBy("class").orderBy("fpr", "tpr")  # different scores of a few thousand test rows
    steps = M.roc_points(scored).withColumns({"x": F.lag("fpr").over(order), "y": F.lag("tpr").over(order)})
    areas = {}
    for c in model.classes:
        own = scored.where(F.col("class") == c).select((F.col("label") == c).cast("double").alias("label"), F.col("score").alias("rawPrediction"))
        areas[c] = BinaryClassificationEvaluator(numBins=0).evaluate(own)
    expected = F.element_at(F.create_map(*[F.lit(v) for pair in areas.items() for v in pair]), F.col("class"))
    return steps.groupBy("class").agg(
        F.min(F.coalesce(F.col("tpr") >= F.col("y"), F.lit(True))).alias("never_falls"),
        F.sum(F.coalesce((F.col("fpr") - F.col("x")) * (F.col("tpr") + F.col("y")) / 2, F.lit(0.0))).alias("area"),
    ).select("class", "never_falls", (F.abs(F.col("area") - expected) < 1e-6).alias("area_agrees"))


def importance(spark, d):
    return stored(spark, d, "importance", lambda: L.feature_importance(split_table(spark, d).drop("is_test"), S.SERVING_FEATURES))


FEATURES_SQL = "SELECT unnest([" + ", ".join(f"'{c}'" for c in S.SERVING_FEATURES) + "]) AS feature, true AS in_range, true AS sums_to_one"


def importance_checked(table):
    """One row per feature; its share lies between 0 and 1, and all shares sum to 1."""
    total = F.sum("importance").over(W.partitionBy())  # nine rows
    return table.select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query("feature_importance", FEATURES_SQL)
def _(spark, d):
    return importance_checked(importance(spark, d))


@query("chart_importance", "SELECT unnest(range(1, 10))::INTEGER AS position, true AS not_above_the_one_before")
def _(spark, d):
    """The bars in order."""
    order = W.orderBy(F.desc("importance"), "feature")  # nine rows
    bars = importance(spark, d).withColumns({"position": F.row_number().over(order), "before": F.lag("importance").over(order)})
    return bars.select("position", F.coalesce(F.col("importance") <= F.col("before"), F.lit(True)).alias("not_above_the_one_before"))


@query("top_k_features", FEATURES_SQL.replace("in_range", "of_the_table").replace(", true AS sums_to_one", ""))
def _(spark, d):
    """The ten best, which are all nine."""
    best = importance(spark, d).orderBy(F.desc("importance"), "feature").limit(10)
    return best.join(importance(spark, d).withColumnRenamed("importance", "whole"), "feature").select(
        "feature", (F.col("importance") == F.col("whole")).alias("of_the_table"))


@query("best_model_importance", FEATURES_SQL)
def _(spark, d):
    return importance_checked(L.importance_table(spark, S.SERVING_FEATURES, classifier(spark, d, "random_forest")))


def squared_distance(columns, center):
    return reduce(lambda a, b: a + b, [(F.col(f"x_{c}") - float(v)) * (F.col(f"x_{c}") - float(v)) for c, v in zip(columns, center)])


@query("kmeans_sweep_elbow", "SELECT unnest(range(2, 11))::INTEGER AS k, true AS as_assigned, true AS not_rising")
def _(spark, d):
    """Inertia of every k, recomputed from distances to the centres."""
    ready = materialize(L.apply_stages(L.fit_preparation(split_table(spark, d), S.SERVING_FEATURES), split_table(spark, d)).select(
        "features", *[f"x_{c}" for c in S.SERVING_FEATURES]))
    models = L.fit_kmeans(ready.select("features"), range(2, 11))
    sums = ready.agg(*[
        F.sum(F.least(*[squared_distance(S.SERVING_FEATURES, c) for c in m.clusterCenters()])).alias(str(k)) for k, m in models.items()
    ]).first()
    expected = F.element_at(F.create_map(*[F.lit(v) for k in models for v in (k, float(sums[str(k)]))]), F.col("k"))
    before = F.lag("inertia").over(W.orderBy("k"))  # nine rows
    return L.inertia_table(models).select(
        "k", (F.abs(F.col("inertia") - expected) <= expected * 1e-6 + 1e-6).alias("as_assigned"),
        F.coalesce(F.col("inertia") <= before * 1.000001, F.lit(True)).alias("not_rising"))


@query("chart_elbow", "SELECT unnest(range(2, 11))::INTEGER AS k, true AS largest_bend_chosen")
def _(spark, d):
    """The sweep, and the chosen k: no other inertia bends more."""
    found, sweep = clusters(spark, d)
    inertia = {r["k"]: r["inertia"] for r in sweep.collect()}  # nine rows
    bends = {k: abs(inertia[k + 1] - 2 * inertia[k] + inertia[k - 1]) for k in range(3, 10)}
    chosen = len(found.centers)
    return sweep.select("k", F.lit(bends[chosen] == max(bends.values())).alias("largest_bend_chosen"))


@query("kmeans_sweep_silhouette", O.on_sessions("SELECT unnest(range(2, least(6, count(*) // 10 + 1)))::INTEGER AS k, true AS in_range, true AS best_chosen FROM split", SPLIT))
def _(spark, d):
    found, sweep = L.train_clusters(split_table(spark, d), S.SERVING_FEATURES, method="silhouette")
    top = F.max_by("k", F.struct("score", -F.col("k"))).over(W.partitionBy())  # four rows
    return sweep.select("k", F.col("score").between(-1, 1).alias("in_range"), (top == len(found.centers)).alias("best_chosen"))


@query("cluster_assign", O.on_sessions("SELECT session_id AS id, true AS none_nearer FROM split", SPLIT))
def _(spark, d):
    """Distances from the stored preparation; no centre is nearer than the assigned one."""
    found = clusters(spark, d)[0]
    ready = L.apply_stages(found.stages, split_table(spark, d))
    distances = F.array(*[squared_distance(S.SERVING_FEATURES, c) for c in found.centers])
    own = F.element_at(distances, F.col("cluster") + 1)
    return ready.select("id", (own <= F.array_min(distances) + 1e-9).alias("none_nearer"))


@query("cluster_distribution", O.on_sessions("SELECT count(*) AS sessions, true AS every_cluster FROM split", SPLIT))
def _(spark, d):
    found = clusters(spark, d)[0]
    counts = found.transform(split_table(spark, d)).groupBy("cluster").agg(F.count(F.lit(1)).alias("count"))
    return counts.agg(F.sum("count").alias("sessions"), (F.count(F.lit(1)) == len(found.centers)).alias("every_cluster"))


@query("pca_2d", O.on_sessions("SELECT count(*) AS sessions, true AS centred, true AS uncorrelated, true AS largest_variances FROM split", SPLIT))
def _(spark, d):
    """The components' variances are the two largest eigenvalues of the correlations."""
    import numpy as np

    table, names = split_table(spark, d), S.SERVING_FEATURES
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    row = table.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")) for a, b in pairs]).first()
    matrix = np.zeros((len(names), len(names)))
    for (a, b), v in zip(pairs, row):
        matrix[names.index(a), names.index(b)] = matrix[names.index(b), names.index(a)] = 0.0 if v is None or np.isnan(v) else v
    top = sorted(np.linalg.eigvalsh(matrix))[-2:]
    points = L.pca_2d(table, names)
    return points.agg(
        F.count(F.lit(1)).alias("sessions"),
        ((F.abs(F.avg("pc1")) < 1e-6) & (F.abs(F.avg("pc2")) < 1e-6)).alias("centred"), (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
        ((F.abs(F.var_pop("pc1") - float(top[1])) < 1e-6) & (F.abs(F.var_pop("pc2") - float(top[0])) < 1e-6)).alias("largest_variances"))


@query("chart_clusters", O.on_sessions("SELECT session_id AS id, true AS placed, true AS a_cluster FROM split", SPLIT))
def _(spark, d):
    found = clusters(spark, d)[0]
    points = L.pca_2d(split_table(spark, d), S.SERVING_FEATURES)
    both = points.join(found.transform(split_table(spark, d)).select("id", "cluster"), "id")
    finite = ~F.isnan("pc1") & ~F.isnan("pc2") & F.col("pc1").isNotNull() & F.col("pc2").isNotNull()
    return both.select("id", finite.alias("placed"), F.col("cluster").between(0, len(found.centers) - 1).alias("a_cluster"))


NEAREST = """,
center AS (SELECT threat_code AS c, avg(command_count) AS x, avg(login_attempt_count) AS y, avg(event_count) AS z FROM s GROUP BY 1),
ordered AS (SELECT row_number() OVER (ORDER BY x, y, z) - 1 AS cluster, x, y, z FROM center)"""


@query("cluster_nearest_center", O.on_sessions("""SELECT session_id, arg_min(cluster,
    (command_count - x) * (command_count - x) + (login_attempt_count - y) * (login_attempt_count - y) + (event_count - z) * (event_count - z))::INTEGER AS cluster
    FROM s, ordered GROUP BY session_id""", NEAREST))
def _(spark, d):
    """Sessions assigned to the nearest of the three level averages."""
    s = kept(spark, d)
    columns = ["command_count", "login_attempt_count", "event_count"]
    centers = s.groupBy("threat_code").agg(*[F.avg(c).alias(c) for c in columns]).select(*columns).collect()
    stages = [SC.prepare_stage(columns), L.nearest_center_stage(columns, sorted(tuple(c) for c in centers))]
    return L.apply_stages(stages, s).select("session_id", "cluster")


def saved_model(spark, d):
    def save():
        path = scratch_path(spark, "model")
        classifier(spark, d, "random_forest").save(path)
        return path
    return stored(spark, d, "saved-model", save)


@query("model_save", O.on_sessions("""SELECT 'random_forest' AS name, '[' || string_agg(DISTINCT threat_code::VARCHAR, ',' ORDER BY threat_code::VARCHAR) || ']' AS classes,
    true AS every_stage FROM split WHERE NOT is_test""", SPLIT))
def _(spark, d):
    """The stored description of a saved classifier, and whether all its stages were stored."""
    path, stages = saved_model(spark, d), classifier(spark, d, "random_forest").stages
    names = spark.read.text(f"{path}/pipeline/metadata").select(F.size(F.from_json(
        F.get_json_object("value", "$.paramMap.stageUids"), "array<string>")).alias("n"))
    spec = spark.read.text(f"{path}/spec")
    return spec.select(
        F.get_json_object("value", "$.name").alias("name"), F.get_json_object("value", "$.classes").alias("classes"),
        (names.scalar() == len(stages)).alias("every_stage"))


@query("model_load", O.on_sessions("SELECT session_id AS id, threat_code AS label, true AS same FROM split WHERE is_test", SPLIT))
def _(spark, d):
    """Whether the reloaded model predicts what the model itself predicts."""
    test = parts(spark, d)[1]
    again = L.Fitted.load(saved_model(spark, d)).transform(test).select("id", F.col("prediction").alias("reloaded"))
    both = classifier(spark, d, "random_forest").transform(test).join(again, "id")
    return both.select("id", "label", (F.col("prediction") == F.col("reloaded")).alias("same"))


def trained_scorer(spark, d):
    """The trained classifier, clusters and map."""
    found = clusters(spark, d)[0]
    rows = split_table(spark, d).select(F.col("label").alias("threat_code"), *S.SERVING_FEATURES)
    mapping = stored(spark, d, "trained-map", lambda: materialize(R.response_map_cluster_rule(found.transform(rows))))
    return classifier(spark, d, "random_forest"), found, mapping


@query("score_session", O.on_sessions("""SELECT session_id, true AS threat_of_the_model, true AS none_nearer, true AS by_rule
    FROM s WHERE end_time IS NOT NULL"""))
def _(spark, d):
    """Threat as the classifier alone gives it, cluster as the distances give it, response as the rule gives it."""
    model, found, mapping = trained_scorer(spark, d)
    done = E.completed(kept(spark, d))
    scored = scoring.score_with_models(done, model, found, mapping).select("session_id", "threat_code", "cluster", "response_level")
    alone = L.apply_stages(found.stages, model.transform(done))
    distances = F.array(*[squared_distance(S.SERVING_FEATURES, c) for c in found.centers])
    expected = alone.select("session_id", F.col("prediction").alias("threat"), distances.alias("distances"))
    rule = R.rule_response(F.col("threat_code"), F.col("cluster"), S.RECON_CLUSTERS)
    return scored.join(expected, "session_id").select(
        "session_id", (F.col("threat_code") == F.col("threat")).alias("threat_of_the_model"),
        (F.element_at("distances", F.col("cluster") + 1) <= F.array_min("distances") + 1e-9).alias("none_nearer"),
        (F.col("response_level") == rule).alias("by_rule"))


def embeddings(spark, d):
    vectors = spark.read.parquet(f"{d}/embeddings.parquet")
    return vectors.select(F.col("vec_id").alias("id"), "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])


VECTOR = [f"e{i}" for i in range(64)]


EMBEDDING_MODELS = ["random_forest", "logistic_regression", "neural_network"]


@query("clf_embeddings", "SELECT unnest([" + ", ".join(f"'{n}'" for n in EMBEDDING_MODELS) + "]) AS model, true AS fitted, true AS in_range")
def _(spark, d):
    """The models of several classes on vectors; one against the rest would be ten boosted models."""
    split = materialize(SA.stratified_split(embeddings(spark, d)))
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    metrics, _models = L.bake_off(train, test, VECTOR, EMBEDDING_MODELS, trees_in_tasks=True)
    ranges = reduce(lambda a, b: a & b, [F.col(m).between(0, 1) for m in M.WEIGHTED])
    return metrics.select("model", F.col("error").isNull().alias("fitted"), ranges.alias("in_range"))


@query("kmeans_embeddings", "SELECT label, count(*) AS vectors, true AS known_clusters FROM embeddings GROUP BY label")
def _(spark, d):
    found, _sweep = L.train_clusters(embeddings(spark, d), VECTOR, k=10, impute=False)
    counts = found.transform(embeddings(spark, d)).groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("count"))
    return counts.groupBy("label").agg(F.sum("count").alias("vectors"), F.min(F.col("cluster").between(0, 9)).alias("known_clusters"))


# --- live query ----------------------------------------------------------------------------------------

def decided(spark, d):
    """Runs the live query over the written log until everything is handled; returns its folder."""
    def run():
        out = scratch_path(spark, "live")
        mapping = materialize(R.response_map_cluster_rule(labelled(spark, d)))

        def scorer(batch):
            return scoring.score_with_rules(batch, F.least("command_count", F.lit(3)), mapping)

        live.start_decisions(spark, log_dir(spark, d), out, scorer, pattern=LOG_FILES, once=True).awaitTermination()
        return out
    return stored(spark, d, "live", run)


DECIDED = LABELLED + """,
decided AS (SELECT session_id, src_ip, threat_code AS threat_level, cluster, response_level, command_count, duration
  FROM labelled JOIN ruled USING (threat_code, cluster) WHERE end_time IS NOT NULL)"""


@query("stream_decision_log", O.on_sessions("SELECT session_id, src_ip, threat_level, cluster, response_level FROM decided", DECIDED))
def _(spark, d):
    return live.read_decisions(spark, decided(spark, d)).select("session_id", "src_ip", "threat_level", "cluster", "response_level")


@query("stream_sessionize", O.on_sessions(f"SELECT {O.FEATURE_LIST} FROM s"))
def _(spark, d):
    """Session rows of the streaming aggregate, after all files were read in one batch."""
    out = scratch_path(spark, "stream-sessions")
    sessions_stream = live.stream_sessions(live.stream_events(spark, log_dir(spark, d), pattern=LOG_FILES)).drop("closed_at")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    sessions_stream.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


@query("stream_source", f"WITH {O.DIRTY} SELECT session, timestamp, input FROM lines WHERE input IS NOT NULL")
def _(spark, d):
    """Command lines as the live source reads them."""
    out = scratch_path(spark, "stream-source")
    found = live.stream_events(spark, log_dir(spark, d), pattern=LOG_FILES).where(F.col("input").isNotNull())
    found.select("session", "timestamp", "input").writeStream.format("parquet").option(
        "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def decided_in_steps(spark, d, **options):
    """The live query over the log in four parts, one batch each."""
    def run():
        folder, out = scratch_path(spark, "log-steps"), scratch_path(spark, "live-steps")
        e = raw(spark, d)
        first, last = e.agg(F.min("ord"), F.max("ord")).first()
        part = F.call_function("div", (F.col("ord") - first) * 4, F.lit(last - first + 1))
        mapping = materialize(R.response_map(labelled(spark, d)))
        for n in range(4):
            sinks.write_log_lines(e.where(part == n), folder, "append")
            decide(spark, folder, out, mapping, **options)
        return out
    return stored(spark, d, f"live-steps {sorted(options)}", run)


def decide(spark, folder, out, mapping, **options):
    def scorer(batch):
        return scoring.score_with_rules(batch, F.least("command_count", F.lit(3)), mapping)

    live.start_decisions(spark, folder, out, scorer, pattern=LOG_FILES, once=True, **options).awaitTermination()


DECISION = """session_id, src_ip, threat_code AS threat_level, least(command_count, 3)::INTEGER AS cluster, threat_code AS response_level,
    login_success::INTEGER AS feature_login, command_count AS feature_commands, duration AS feature_duration, has_persistence AS feature_persistence"""


def decision_rows(decisions):
    def feature(name, kind):
        return F.get_json_object("features", f"$.{name}").cast(kind)

    return decisions.select(
        "session_id", "src_ip", "threat_level", "cluster", "response_level", feature("login_success", "int").alias("feature_login"),
        feature("command_count", "bigint").alias("feature_commands"), feature("duration", "double").alias("feature_duration"),
        feature("has_persistence", "int").alias("feature_persistence"))


@query("stream_completed", f"WITH {O.STEPS} SELECT {DECISION} FROM s")
def _(spark, d):
    """Decisions of four batches: each with what was known when the session was first closed."""
    return decision_rows(live.read_decisions(spark, decided_in_steps(spark, d)))


@query("stream_bounded", f"WITH {O.STEPS} SELECT {DECISION} FROM s")
def _(spark, d):
    """The same with a bound of a day on the state, which no session of the table exceeds."""
    return decision_rows(live.read_decisions(spark, decided_in_steps(spark, d, bound=timedelta(days=1))))


@query("stream_followed", f"WITH {O.STEPS} SELECT {DECISION} FROM s")
def _(spark, d):
    """The same from the source that follows growing files."""
    return decision_rows(live.read_decisions(spark, decided_in_steps(spark, d, follow=True)))


@query("stream_dedupe", f"""WITH {O.STEPS} SELECT session_id, 1::BIGINT AS decisions, threat_code AS response_level, {O.named('threat_code')} AS strategy FROM s""")
def _(spark, d):
    """Sessions may close several times and in several batches; each has one decision."""
    decisions = R.strategy_decode(live.read_decisions(spark, decided_in_steps(spark, d)))
    return decisions.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("decisions"), F.max("response_level").alias("response_level"), F.max("strategy").alias("strategy"))


@query("stream_active_state", f"""WITH {O.STEPS} SELECT session_id, src_ip, threat_code AS response_level, {O.named('threat_code')} AS strategy FROM s""")
def _(spark, d):
    """Latest state per session from a snapshot and the batch after it, with the address of its decision."""
    out = decided_in_steps(spark, d, compact_every=3)
    decisions = live.read_decisions(spark, out)
    return live.current_state(spark, out).join(decisions.select("session_id", "src_ip"), "session_id").drop("timestamp")


def grow(spark, d, folder, share):
    """A file per day of the log grows to a share of its bytes, wherever that cuts a line; tasks append what is missing."""
    line = F.to_json(F.struct(*S.RAW_FIELDS))
    lines = raw(spark, d).select(F.to_date("ts").cast("string").alias("part"), "ord", line.alias("value"))
    place = growing.local_path(folder)

    def append(rows):
        text = "".join(v + "\n" for v in rows.sort_values("ord")["value"]).encode()
        os.makedirs(place, exist_ok=True)
        path = f"{place}/part-{rows['part'].iloc[0]}"
        with open(path, "ab") as file:
            file.write(text[os.path.getsize(path):int(len(text) * share)])
        return rows[["part"]].head(1)

    lines.groupBy("part").applyInPandas(append, "part string").count()


@query("stream_source_growing", O.on_log("SELECT session, timestamp, input FROM log WHERE input IS NOT NULL"))
def _(spark, d):
    """Command lines of files that grow between three batches and are cut inside a line."""
    folder, out = scratch_path(spark, "log-growing"), scratch_path(spark, "stream-growing")
    for share in (0.3, 0.71, 1.0):
        grow(spark, d, folder, share)
        found = live.stream_events(spark, folder, pattern=LOG_FILES, follow=True).where(F.col("input").isNotNull())
        found.select("session", "timestamp", "input").writeStream.format("parquet").option(
            "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


@query("scan_line_counts", f"""WITH {O.DIRTY} SELECT (SELECT count(*) FROM lines) AS good, (SELECT count(*) FROM bad) AS bad,
    (SELECT count(*) FROM log WHERE ord % 103 = 0) AS blank""")
def _(spark, d):
    """Lines by kind, counted while the good ones are written."""
    counts = Observation("lines")
    parsed = logs.count_lines(logs.parse_lines(logs.scan_lines(spark, log_dir(spark, d), pattern=LOG_FILES), blank=True), counts)
    materialize(parsed.where(F.col(S.CORRUPT).isNull()))
    return spark.createDataFrame([tuple(counts.get[k] for k in ("good", "bad", "blank"))], "good long, bad long, blank long")


@query("stream_score", O.on_sessions("SELECT session_id, true AS as_in_batch FROM s WHERE end_time IS NOT NULL"))
def _(spark, d):
    """The live query with the trained classifier, clusters and map gives what the batch gives."""
    out = scratch_path(spark, "live-models")
    model, found, mapping = trained_scorer(spark, d)
    live.start_decisions(spark, log_dir(spark, d), out, lambda batch: scoring.score_with_models(batch, model, found, mapping),
                         pattern=LOG_FILES, once=True).awaitTermination()
    streamed = live.read_decisions(spark, out).select("session_id", F.struct("threat_level", "cluster", "response_level").alias("live"))
    batch = scoring.score_with_models(E.completed(kept(spark, d)), model, found, mapping).select(
        "session_id", F.struct("threat_code", "cluster", "response_level").alias("batch"))
    return streamed.join(batch, "session_id").select(
        "session_id", (F.to_json("live") == F.regexp_replace(F.to_json("batch"), "threat_code", "threat_level")).alias("as_in_batch"))


@query("sink_decisions", O.on_sessions("""SELECT session_id, command_count AS feature_commands, duration AS feature_duration FROM decided""", DECIDED))
def _(spark, d):
    features = live.read_decisions(spark, decided(spark, d))
    return features.select(
        "session_id", F.get_json_object("features", "$.command_count").cast("bigint").alias("feature_commands"),
        F.get_json_object("features", "$.duration").cast("double").alias("feature_duration"),
    )


@query("sink_processed", O.on_sessions("SELECT session_id FROM decided", DECIDED))
def _(spark, d):
    return live.processed_sessions(live.read_decisions(spark, decided(spark, d)))


@query("sink_active_sessions", O.on_sessions("""SELECT session_id, response_level,
    CASE response_level WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS strategy FROM decided""", DECIDED))
def _(spark, d):
    return live.current_state(spark, decided(spark, d)).drop("timestamp")


ADDRESS_LEVELS = LABELLED + """,
latest AS (SELECT src_ip, arg_max(threat_code, start_time) AS response_level FROM s GROUP BY src_ip)"""


@query("active_sessions_batch", O.on_sessions("""SELECT src_ip AS session_id, response_level,
    CASE response_level WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS strategy FROM latest""", ADDRESS_LEVELS))
def _(spark, d):
    """Latest level per address over its sessions: several records per key."""
    records = sessions(spark, d).select(
        F.col("src_ip").alias("session_id"), F.col("threat_code").alias("response_level"), F.col("start_time").alias("timestamp"))
    return R.active_sessions(records).drop("timestamp")


NAMED = "CASE max(response_level) WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS strategy"


@query("highest_level", O.on_sessions(f"""SELECT max(response_level) AS response_level, {NAMED} FROM decided""", DECIDED))
def _(spark, d):
    return live.current_level(live.read_decisions(spark, decided(spark, d)))


@query("stream_desired_profile_changes", O.on_sessions(f"""SELECT step, highest_level, {O.named('highest_level')} AS strategy,
    coalesce(highest_level <> lag(highest_level) OVER (ORDER BY step), true) AS changed FROM (
      SELECT row_number() OVER (ORDER BY batch)::INTEGER AS step, max(level) OVER (ORDER BY batch) AS highest_level FROM (
        SELECT least(threat_code * 2 + command_count % 2, 4) AS batch, max(threat_code) AS level FROM s WHERE end_time IS NOT NULL GROUP BY 1))"""))
def _(spark, d):
    """The strategy after each of five batches, in which sessions of low, medium and high threat come one after the other."""
    def run():
        folder, out = scratch_path(spark, "log-levels"), scratch_path(spark, "live-levels")
        batch = kept(spark, d).select("session_id", F.least(F.col("threat_code") * 2 + F.col("command_count") % 2, F.lit(4)).alias("batch"))
        e = materialize(raw(spark, d).join(batch, F.col("session") == F.col("session_id")))
        mapping = materialize(R.response_map(labelled(spark, d)))
        for n in range(5):
            sinks.write_log_lines(e.where(F.col("batch") == n), folder, "append")
            decide(spark, folder, out, mapping)
        return out

    changes = live.profile_changes(spark, stored(spark, d, "live-levels", run))
    return changes.withColumn("step", F.row_number().over(W.orderBy("step")))  # one row per batch


@query("desired_profile_by_day", O.on_sessions("""SELECT step, highest_level, CASE highest_level WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS strategy,
    coalesce(highest_level <> lag(highest_level) OVER (ORDER BY step), true) AS changed FROM (
      SELECT step, max(level) OVER (ORDER BY step ROWS UNBOUNDED PRECEDING) AS highest_level FROM (
        SELECT substr(end_time, 1, 13) AS step, max(threat_code) AS level FROM s WHERE end_time IS NOT NULL GROUP BY 1))"""))
def _(spark, d):
    """The desired strategy when each hour is one batch."""
    hours = E.completed(sessions(spark, d)).groupBy(F.substring("end_time", 1, 13).alias("step")).agg(
        F.max("threat_code").alias("response_level"))
    return R.desired_profile(hours)
