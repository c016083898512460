import json

import pytest

from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.operators import events as E
from wardlog.operators import sessions as SE
from wardlog.sources import logs, sinks


def test_quarantine_takes_bad_lines_only(spark, micro_dir):
    got = {r[S.CORRUPT] for r in logs.scan_quarantine(spark, micro_dir).collect()}
    assert got == {"not json", "[1,2]"}
    assert logs.scan_jsonl(spark, micro_dir).count() == 12


def test_lines_that_the_json_parser_alone_would_accept(spark, tmp_path):
    good = [
        '{"session": "a", "input": "x } y"}', '  {"session": "b", "data": {"k": [1, {"z": 2}]}, "eventid": "e"}  ',
        '{"session": "c", "duration": 3, "success": true, "src_ip": {"odd": 1}}', '{}', '{"session": "d", "input": "} {"}',
    ]
    bad = [
        '{"session": "x"}{"session": "y"}', '{"session": "x"},{"session": "y"}', '{"session": "x"} trailing', "5", '"text"',
        "{'session': 'x'}", '{"session": "x"', "null", '[{"session": "x"}]',
    ]
    (tmp_path / "cowrie.json").write_text("\n".join([*good, "", "   ", *bad]))
    parsed = logs.scan_jsonl(spark, str(tmp_path))
    assert {r["session"] for r in parsed.collect()} == {"a", "b", "c", "d", None}
    assert {r[S.CORRUPT] for r in logs.scan_quarantine(spark, str(tmp_path)).collect()} == set(bad)
    c = parsed.where("session = 'c'").first()
    assert (c["duration"], c["success"]) == ("3", "true")


def test_discovery_follows_roots_and_prefix(spark, tmp_path):
    for name in ["a/cowrie.json", "a/deep/cowrie.json.2024-01-01", "a/other.json", "b/cowrie.json.1"]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"session": name}) + "\n")
    roots = [str(tmp_path / "a"), str(tmp_path / "b")]
    assert {r["session"] for r in logs.scan_jsonl(spark, roots).collect()} == {
        "a/cowrie.json", "a/deep/cowrie.json.2024-01-01", "b/cowrie.json.1"}
    assert logs.discover(spark, roots).count() == 3
    assert logs.scan_jsonl(spark, str(tmp_path / "a"), recursive=False).count() == 1


def test_equal_times_keep_the_line_order(spark, tmp_path):
    lines = [json.dumps({"session": "a", "eventid": S.EVENT_COMMAND, "timestamp": "2024-01-01T00:00:00Z", "input": f"c{i}"})
             for i in range(300)]
    (tmp_path / "cowrie.json").write_text("\n".join(lines))
    pieces = SE.joined_commands(logs.scan_jsonl(spark, str(tmp_path))).orderBy("position").collect()
    assert "".join(r["piece"] for r in pieces).split(" | ") == [f"c{i}" for i in range(300)]


def test_a_line_without_a_time_decides_nothing(spark, tmp_path):
    """Neither the first values nor the last ones, as long as the session has lines with a time."""
    lines = [("2024-01-01T00:00:01Z", "1.1.1.1", S.EVENT_COMMAND), ("bad", "2.2.2.2", S.EVENT_CLOSED),
             ("2024-01-01T00:00:03Z", "3.3.3.3", S.EVENT_CLOSED), ("", "4.4.4.4", S.EVENT_COMMAND)]
    (tmp_path / "cowrie.json").write_text("\n".join(
        [json.dumps({"session": "a", "eventid": k, "timestamp": t, "src_ip": ip}) for t, ip, k in lines]
        + [json.dumps({"session": "b", "eventid": "x", "timestamp": "bad", "src_ip": "5.5.5.5"})]))
    got = {r["session_id"]: r for r in SE.sessionize(logs.scan_jsonl(spark, str(tmp_path))).collect()}
    assert (got["a"]["src_ip"], got["a"]["start_time"], got["a"]["end_time"]) == ("1.1.1.1", "2024-01-01T00:00:01Z", "2024-01-01T00:00:03Z")
    assert got["b"]["src_ip"] == "5.5.5.5"


def test_times_of_any_year_are_ordered(spark, tmp_path):
    times = ["0001-01-01T00:00:00Z", "1969-12-31T23:59:59.999999Z", "1970-01-01T00:00:00Z", "2024-01-01T00:00:00.5+02:00", "9999-12-31T23:59:59.999999Z"]
    (tmp_path / "cowrie.json").write_text("\n".join(json.dumps({"session": "a", "eventid": "x", "timestamp": t}) for t in reversed(times)))
    events = logs.scan_jsonl(spark, str(tmp_path))
    assert [r["timestamp"] for r in events.orderBy("ord").collect()] == times == [r["timestamp"] for r in events.orderBy("first_ord").collect()]


def test_numeric_profile_of_a_log_needs_no_sort(spark, micro_dir):
    from wardlog.plans import profiles as P

    sessions = SE.session_features(logs.scan_jsonl(spark, micro_dir))
    for profile in (P.threat_characteristics(sessions), P.basic_statistics(sessions, E.events_b(logs.scan_jsonl(spark, micro_dir)))):
        plan = profile._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_key_presence(spark, tmp_path):
    (tmp_path / "cowrie.json").write_text("\n".join([
        '{"session": null, "eventid": "e"}', '{"session": "", "eventid": "e"}', '{"eventid": "e"}', '{"session": "s", "eventid": ""}']))
    parsed = logs.parse_lines(logs.scan_lines(spark, str(tmp_path)), keys=True)
    assert E.events_a(parsed).count() == 3
    assert E.events_b(parsed).count() == 0


def test_csv_round_trip(spark, micro_dir, tmp_path):
    table = SE.session_features(logs.scan_jsonl(spark, micro_dir))
    sinks.write_csv(table, str(tmp_path / "csv"))
    back = logs.scan_csv(spark, str(tmp_path / "csv"), S.EMPTY_SESSIONS_SCHEMA)
    assert back.columns == S.SESSION_COLUMNS
    s2 = back.where("session_id = 's2'").first()
    assert s2["commands"] is None and s2["duration"] == 1.0 and s2["login_success"] is False
    entries = SE.session_entries(logs.scan_jsonl(spark, micro_dir)).where("list = 'login_attempts'")
    nested = entries.groupBy("session_id").agg(F.collect_list(F.struct("username", "success")).alias("login_attempts"))
    sinks.write_csv(nested, str(tmp_path / "nested"))
    raw = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "nested"))
    from wardlog.functions import list_length

    lengths = {r["session_id"]: r["n"] for r in raw.select("session_id", list_length(F.col("login_attempts")).alias("n")).collect()}
    assert lengths == {"s1": 2, "s2": 1, "s3": 1}


def test_csv_cells_with_line_breaks_stay_on_one_line(spark, tmp_path):
    texts = ["a\nb", "c\r\nd", "back\\slash", "literal \\n", "\\\\n\n\\", 'quote " and , comma', "plain", None]
    df = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "session_id string, commands string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "csv"))
    part = next((tmp_path / "csv").glob("part-*"))
    assert len(part.read_text().splitlines()) == len(texts) + 1
    back = logs.scan_csv(spark, str(tmp_path / "csv"), S.EMPTY_SESSIONS_SCHEMA)
    assert {r["session_id"]: r["commands"] for r in back.collect()} == {f"s{i}": t for i, t in enumerate(texts)}


def test_foreign_csv_over_several_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text('session_id,commands\ns1,"a\nb \\n"\n')
    back = logs.scan_csv(spark, str(tmp_path / "x.csv"), S.EMPTY_SESSIONS_SCHEMA, multi_line=True, escaped=False)
    assert back.first()["commands"] == "a\nb \\n"


def test_csv_files_with_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("session_id,src_ip\ns1,1.1.1.1\n")
    (tmp_path / "b.csv").write_text("src_ip,session_id\n2.2.2.2,s2\n")
    with pytest.raises(Exception, match="(?i)header"):
        logs.scan_csv(spark, str(tmp_path), S.EMPTY_SESSIONS_SCHEMA).collect()
