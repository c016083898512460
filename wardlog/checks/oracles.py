"""Reference SQL for the registered queries, written independently of the Spark plans.

The SQL folds each session into its whole joined text and applies the patterns to that text.
"""

from wardlog import schema as S
from wardlog.sources.logs import VOCABULARY

_WORDS = ", ".join("'" + c + "'" for c in VOCABULARY)

LOG = rf"""
log AS (
  SELECT event_id AS ord, ts, user_id, value, k, event_type,
    user_id::VARCHAR || '-' || strftime(ts, '%Y-%m-%d') AS session,
    CASE event_type WHEN 'signup' THEN 'cowrie.login.success' WHEN 'error' THEN 'cowrie.login.failed'
      WHEN 'purchase' THEN 'cowrie.session.closed' ELSE 'cowrie.command.input' END AS eventid,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS timestamp,
    '10.0.0.' || user_id AS src_ip,
    CASE WHEN event_type IN ('signup', 'error') THEN 'u' || (k % 10) END AS username,
    CASE WHEN event_type IN ('signup', 'error') THEN 'p' || (k % 7) END AS password,
    CASE WHEN event_type IN ('click', 'view') THEN ([{_WORDS}])[k % 20 + 1] END AS input,
    'v' || (k % 5) AS version, 'h' || (k % 9) AS hassh, 'a' || (k % 3) AS hassh_algorithms,
    CASE WHEN event_type = 'purchase' THEN value END AS duration,
    'part-' || (hour(ts) // 8) AS file
  FROM (SELECT *, regexp_extract(props, '"k": (\d+)', 1)::BIGINT AS k FROM events)
)"""

_FLAGS = ",\n    ".join(f"regexp_matches(commands, '{p}')::INTEGER AS {n}" for n, p in S.PATTERNS.items())


def folded(source="log", by="session"):
    """CTEs base -> s: sessions with joined text, flags, score and level."""
    return f"""
base AS (
  SELECT session AS session_id{', file' if 'file' in by else ''},
    arg_min(src_ip, ord) AS src_ip, arg_min(timestamp, ord) AS start_time,
    arg_max(timestamp, ord) FILTER (eventid = 'cowrie.session.closed') AS end_time,
    coalesce(arg_max(duration, ord) FILTER (eventid = 'cowrie.session.closed'), 0.0)::DOUBLE AS duration,
    bool_or(eventid = 'cowrie.login.success') AS login_success,
    arg_max(username, ord) FILTER (eventid = 'cowrie.login.success') AS username,
    arg_max(password, ord) FILTER (eventid = 'cowrie.login.success') AS password,
    arg_min(version, ord) AS client_version, arg_min(hassh, ord) AS hassh,
    arg_min(hassh_algorithms, ord) AS hassh_algorithms,
    count(*) FILTER (eventid IN ('cowrie.login.success', 'cowrie.login.failed')) AS login_attempt_count,
    count(*) FILTER (eventid = 'cowrie.command.input') AS command_count,
    count(*) AS event_count,
    coalesce(string_agg(input, ' | ' ORDER BY ord) FILTER (eventid = 'cowrie.command.input'), '') AS commands
  FROM {source} GROUP BY {by}
)"""


SCORED = f""",
flagged AS (SELECT *, {_FLAGS}, commands <> '' AS has_command_text FROM base),
points AS (
  SELECT *, (5 * login_success::INTEGER + 3 * has_download_command + 4 * has_privilege_escalation
    + has_file_access + 2 * has_reconnaissance + 4 * has_persistence + 3 * has_malware_indicators)::INTEGER AS threat_score
  FROM flagged
),
s AS (
  SELECT *, CASE WHEN threat_score >= 10 THEN 'high' WHEN threat_score >= 5 THEN 'medium' ELSE 'low' END AS threat_level,
    (CASE WHEN threat_score >= 10 THEN 2 WHEN threat_score >= 5 THEN 1 ELSE 0 END)::INTEGER AS threat_code
  FROM points
)"""
SESSIONS = LOG + "," + folded() + SCORED

# Four parts of the log by event number; `s` holds each closed session as it stands after the part that first closes it.
STEPS = LOG + """,
parts AS (SELECT *, ((ord - (SELECT min(ord) FROM log)) * 4 // (SELECT max(ord) - min(ord) + 1 FROM log))::INTEGER AS part FROM log),
closing AS (SELECT session, min(part) AS closed_in FROM parts WHERE eventid = 'cowrie.session.closed' GROUP BY session),
seen AS (SELECT p.* FROM parts p JOIN closing c ON p.session = c.session AND p.part <= c.closed_in),""" + folded("seen") + SCORED
TOKENS = SESSIONS + """,
tok AS (SELECT session_id, unnest(string_split(commands, ' | ')) AS command FROM s WHERE commands <> '')"""

FEATURE_LIST = (
    "session_id, src_ip, start_time, end_time, duration, login_success, username, password, client_version, hassh, "
    "hassh_algorithms, login_attempt_count, command_count, event_count, " + ", ".join(S.PATTERNS) +
    ", has_command_text, threat_score, threat_level, threat_code"
)
FLAG_LIST = ", ".join(S.PATTERNS)


def named(code):
    return f"CASE {code} WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END"


def on_log(body):
    return f"WITH {LOG} {body}"


def on_sessions(body, extra=""):
    return f"WITH {SESSIONS}{extra} {body}"


def on_tokens(body, extra=""):
    return f"WITH {TOKENS}{extra} {body}"


# Rows of a written log: the good lines, a line without a session, and the bad lines.
DIRTY = LOG + """,
lines AS (
  SELECT ord, session, eventid, timestamp, src_ip, username, password, input, version, hassh,
    hassh_algorithms AS "hasshAlgorithms", CASE WHEN event_type = 'purchase' THEN value END AS duration,
    CASE WHEN event_type = 'signup' THEN 'true' END AS success FROM log
  UNION ALL
  SELECT ord, NULL, 'other' || ord, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM log WHERE ord % 107 = 0
),
bad AS (
  SELECT 'not json ' || ord AS text FROM log WHERE ord % 97 = 0
  UNION ALL SELECT '[' || ord || ',2]' FROM log WHERE ord % 101 = 0
  UNION ALL SELECT '{"session":"x' || ord || '"}{"session":"y"}' FROM log WHERE ord % 109 = 0
)"""

# Simple rules as stand-ins for model outputs, so that metric formulas can be compared exactly.
GUESSES = SESSIONS + """,
guess AS (
  SELECT session_id, threat_code AS label, 0 AS position, 'by_commands' AS model, least(command_count, 2)::INTEGER AS prediction FROM s
  UNION ALL SELECT session_id, threat_code, 1, 'by_login', (login_success::INTEGER * 2) FROM s
  UNION ALL SELECT session_id, threat_code, 2, 'by_flags', least(has_download_command + has_persistence + has_privilege_escalation, 2)::INTEGER FROM s
),
cells AS (SELECT model, any_value(position) AS position, label, prediction, count(*) AS n FROM guess GROUP BY model, label, prediction),
classes AS (SELECT DISTINCT model, label AS class FROM cells UNION SELECT DISTINCT model, prediction FROM cells),
report AS (
  SELECT c.model, c.class,
    coalesce((SELECT sum(n) FROM cells x WHERE x.model = c.model AND x.label = c.class), 0)::BIGINT AS support,
    coalesce((SELECT sum(n) FROM cells x WHERE x.model = c.model AND x.prediction = c.class), 0)::BIGINT AS guessed,
    coalesce((SELECT sum(n) FROM cells x WHERE x.model = c.model AND x.label = c.class AND x.prediction = c.class), 0)::BIGINT AS hit
  FROM classes c
),
shares AS (
  SELECT *, CASE WHEN guessed = 0 THEN 0.0::DOUBLE ELSE hit::DOUBLE / guessed END AS precision,
    CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hit::DOUBLE / support END AS recall FROM report
),
per_class AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM shares
),
weighted AS (
  SELECT model, sum(hit)::DOUBLE / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision,
    sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1 FROM per_class GROUP BY model
),
macro AS (
  SELECT model, sum(hit)::DOUBLE / sum(support) AS accuracy, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1
  FROM per_class GROUP BY model
)"""

SCORES = SESSIONS + """,
scores AS (
  SELECT 0 AS class, threat_code AS label, 1.0::DOUBLE / (1 + event_count) AS score FROM s
  UNION ALL SELECT 1, threat_code, login_attempt_count::DOUBLE / event_count FROM s
  UNION ALL SELECT 2, threat_code, event_count + 0.5::DOUBLE * command_count + duration / 1000 FROM s
),
steps AS (
  SELECT class, score, count(*) FILTER (label = class) AS pos, count(*) FILTER (label <> class) AS neg FROM scores GROUP BY class, score
),
run AS (
  SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
    sum(pos) OVER (PARTITION BY class) AS all_pos, sum(neg) OVER (PARTITION BY class) AS all_neg
  FROM steps WINDOW w AS (PARTITION BY class ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
)"""
