import itertools

import pytest
from pyspark.sql import functions as F

from tests.conftest import MICRO_LOG, event
from wardlog import schema as S
from wardlog.operators import respond as R
from wardlog.plans import scoring
from wardlog.streaming import live


@pytest.fixture(scope="module")
def scorer(spark):
    rows = spark.createDataFrame([(t, c) for t in (0, 1, 2) for c in range(4)], "threat_code int, cluster int")
    mapping = R.response_map(rows)
    return lambda batch: scoring.score_with_rules(batch, F.least("command_count", F.lit(3)), mapping)


def run(spark, folder, out, scorer, **more):
    live.start_decisions(spark, str(folder), str(out), scorer, once=True, **more).awaitTermination()
    return {r["session_id"]: r for r in live.read_decisions(spark, str(out)).collect()}, live.read_decisions(spark, str(out)).count()


FILES = [MICRO_LOG[:5], MICRO_LOG[5:8], MICRO_LOG[8:]]


@pytest.mark.parametrize("arrival", [(0, 1, 2), (1, 0, 2), (2, 1, 0)])
def test_files_in_any_order_give_each_decision_once(spark, tmp_path, scorer, arrival):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in arrival:
        (folder / f"cowrie.json.{n}").write_text("\n".join(FILES[n]) + "\n")
        got, count = run(spark, folder, tmp_path / "out", scorer)
    assert set(got) == {"s1", "s2"} and count == 2
    assert got["s2"]["threat_level"] == 0
    if arrival == (0, 1, 2):
        assert (got["s1"]["threat_level"], got["s1"]["response_level"], got["s1"]["cluster"]) == (2, 2, 2)
        assert '"command_count":2' in got["s1"]["features"] and got["s1"]["src_ip"] == "10.0.0.1"


def test_restart_and_later_events_decide_nothing_again(spark, tmp_path, scorer):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "cowrie.json.1").write_text("\n".join(MICRO_LOG) + "\n")
    (folder / "other.json").write_text(event("zz", S.EVENT_CLOSED, 1))
    _, first = run(spark, folder, tmp_path / "out", scorer)
    (folder / "cowrie.json.2").write_text("\n".join([
        event("s1", S.EVENT_COMMAND, 20, input="ls"), event("s1", S.EVENT_CLOSED, 21, duration=3),
        event("s3", S.EVENT_CLOSED, 22, duration=4),
    ]))
    got, second = run(spark, folder, tmp_path / "out", scorer)
    _, third = run(spark, folder, tmp_path / "out", scorer)
    assert (first, second, third) == (2, 3, 3) and set(got) == {"s1", "s2", "s3"}
    levels = {r["session_id"]: r["strategy"] for r in live.active_state(live.read_decisions(spark, str(tmp_path / "out"))).collect()}
    assert levels == {"s1": "high", "s2": "low", "s3": "medium"}
    assert live.current_level(live.read_decisions(spark, str(tmp_path / "out"))).first()["strategy"] == "high"
    changes = [(r["strategy"], r["changed"]) for r in live.profile_changes(spark, str(tmp_path / "out")).orderBy("step").collect()]
    assert changes == [("high", True), ("high", False)]
    assert live.processed_sessions(live.read_decisions(spark, str(tmp_path / "out"))).count() == 3


def test_one_file_per_batch_equals_the_batch_answer_for_whole_sessions(spark, tmp_path, scorer):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(6):
        lines = [event(f"x{n}", S.EVENT_LOGIN_SUCCESS, 1, username="u", password="p"), event(f"x{n}", S.EVENT_COMMAND, 2, input="curl a" if n % 2 else "echo"),
                 event(f"x{n}", S.EVENT_CLOSED, 3, duration=n)]
        (folder / f"cowrie.json.{n}").write_text("\n".join(lines))
    got, count = run(spark, folder, tmp_path / "out", scorer, files_per_batch=2)
    assert count == 6 and {k: r["threat_level"] for k, r in got.items()} == {f"x{n}": 1 for n in range(6)}
    assert len({r["batch_id"] for r in got.values()}) >= 3


def test_restart_policy_waits_after_a_failure():
    pauses, attempts = [], itertools.count()

    class Query:
        def __init__(self, fails):
            self.fails = fails

        def awaitTermination(self):
            if self.fails:
                raise RuntimeError("stream failed")

    live.keep_running(lambda: Query(next(attempts) < 2), pause=300, wait=pauses.append)
    assert pauses == [300, 300]


def test_a_growing_log_is_taken_when_it_is_rotated(spark, tmp_path, scorer):
    """Nothing of a file is lost that is appended to, or whose last line is half written, while the query runs."""
    folder = tmp_path / "in"
    folder.mkdir()
    growing = folder / "cowrie.json"
    late = event("s3", S.EVENT_CLOSED, 30, duration=4)
    (folder / "cowrie.json.0").write_text(event("s0", S.EVENT_CLOSED, 1, duration=1))
    growing.write_text("\n".join(MICRO_LOG) + "\n" + late[:20])
    got, _ = run(spark, folder, tmp_path / "out", scorer)
    assert set(got) == {"s0"}
    with growing.open("a") as log:
        log.write(late[20:] + "\n" + event("s4", S.EVENT_CLOSED, 31, duration=1) + "\n")
    run(spark, folder, tmp_path / "out", scorer)
    growing.rename(folder / "cowrie.json.2024-01-01")
    got, count = run(spark, folder, tmp_path / "out", scorer)
    assert set(got) == {"s0", "s1", "s2", "s3", "s4"} and count == 5


def test_the_state_store_of_the_session_comes_back(spark, tmp_path, scorer):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "cowrie.json.1").write_text("\n".join(MICRO_LOG))
    run(spark, folder, tmp_path / "out", scorer)
    assert spark.conf.get(key, None) == before


def test_errors_that_a_restart_cannot_mend_are_raised(spark, tmp_path, scorer):
    with pytest.raises(Exception, match="(?i)path"):
        live.keep_running(lambda: live.start_decisions(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"), scorer, once=True),
                          wait=lambda _: pytest.fail("waited"))


def follow(spark, folder, out, scorer, **more):
    return run(spark, folder, out, scorer, follow=True, settle=0, pattern=S.LOG_FILE_PATTERN, **more)


def test_lines_are_decided_once_while_the_log_grows(spark, tmp_path, scorer):
    """Appended lines, a last line cut in the middle, rotation by name, a new file under the old name, an emptied file."""
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    live_log = folder / "cowrie.json"
    text = "\n".join(MICRO_LOG) + "\n"
    live_log.write_text(text[:700])
    seen = []

    def look():
        got, count = follow(spark, folder, out, scorer)
        seen.append((sorted(got), count))
        return got

    look()
    live_log.write_text(text[:-30])  # the same file, longer
    got = look()
    assert (got["s1"]["threat_level"], got["s1"]["cluster"]) == (2, 2) and '"command_count":2' in got["s1"]["features"]
    with live_log.open("a") as log:
        late = event("s3", S.EVENT_CLOSED, 30, duration=4)
        log.write(text[-30:] + late[:25])
    look()
    with live_log.open("a") as log:
        log.write(late[25:])
    look()  # complete but for its line break, which may still belong to a longer line
    live_log.rename(folder / "cowrie.json.2024-01-01")
    live_log.write_text(event("s4", S.EVENT_CLOSED, 40, duration=1) + "\n" + event("s1", S.EVENT_CLOSED, 41, duration=1) + "\n")
    look()
    live_log.write_text(event("s5", S.EVENT_CLOSED, 42, duration=1) + "\n")  # emptied and written anew
    look()
    assert seen == [([], 0), (["s1", "s2"], 2), (["s1", "s2"], 2), (["s1", "s2"], 2), (["s1", "s2", "s3", "s4"], 4), (["s1", "s2", "s3", "s4", "s5"], 5)]


def test_ranges_of_a_file_give_every_line_once(tmp_path, monkeypatch):
    from wardlog.sources import growing as G

    lines = [f"line {n} " + "x" * (n * 7 % 90) for n in range(300)] + ["", "é" * 40, "last without end"]
    (tmp_path / "cowrie.json.1").write_bytes("\n".join(lines).encode())
    (tmp_path / "other").write_text("not matched\n")
    monkeypatch.setattr(G, "SPLIT", 101)
    monkeypatch.setattr(G, "BLOCK", 37)
    reader = G.GrowingReader({"path": f"file://{tmp_path}", "pattern": "cowrie.json*", "finished": "cowrie.json.*", "settle": "0"})

    def read(start, end):
        return [(r["row"], r["value"]) for span in reader.partitions(start, end) for batch in reader.read(span) for r in batch.to_pylist()]

    everything = read({}, reader.latestOffset())
    assert [v for _, v in everything] == lines and everything == sorted(everything)
    limited = G.GrowingReader({"path": str(tmp_path), "pattern": "cowrie.json*", "bytesPerBatch": "500"})
    at, parts = {}, []
    while (to := limited.latestOffset()) != at:
        parts.append(read(at, to))
        limited.known, at = to, to
    assert [v for part in parts for _, v in part] == lines[:-1] and len(parts) > 20


def test_files_that_are_gone_stay_known_and_then_leave_the_offset(tmp_path, monkeypatch):
    from wardlog.sources import growing as G

    reader = G.GrowingReader({"path": str(tmp_path), "pattern": "*"})
    (tmp_path / "a").write_text("one\n")
    first = reader.latestOffset()
    (tmp_path / "a").rename(tmp_path.parent / f"{tmp_path.name}-away")
    second = reader.latestOffset()
    assert set(second) == set(first) and reader.partitions(first, second) == []
    (tmp_path.parent / f"{tmp_path.name}-away").rename(tmp_path / "b")
    assert reader.partitions(second, reader.latestOffset()) == []
    (tmp_path / "b").unlink()
    reader.latestOffset()
    monkeypatch.setattr(G, "GONE", -1)
    assert reader.latestOffset() == {}


BOUND = __import__("datetime").timedelta(seconds=10)


def steps(folder, *batches):
    """Writes one file per batch, to be read one by one."""
    folder.mkdir()
    for n, lines in enumerate(batches):
        yield (folder / f"cowrie.json.{n}").write_text("\n".join(lines) + "\n")


def test_a_bound_gives_the_same_decisions_and_state_falls_again(spark, tmp_path, scorer):
    def session(name, at):
        return [event(name, S.EVENT_LOGIN_SUCCESS, at, "10.0.0.9", username="u", password="p"), event(name, S.EVENT_COMMAND, at + 1, input="curl a"),
                event(name, S.EVENT_COMMAND, at + 2, input="crontab -l"), event(name, S.EVENT_CLOSED, at + 3, duration=at)]

    batches = [MICRO_LOG, session("a", 8) + session("b", 9)[:2], session("b", 9)[2:] + [event("b", S.EVENT_CLOSED, 13, duration=1)], session("c", 50),
               session("late", 1) + [event("s2", S.EVENT_CLOSED, 9, duration=1.0), event("a", S.EVENT_CLOSED, 55, duration=1)], session("d", 56)]
    folder = tmp_path / "in"
    queries, decisions = [], {}
    for _ in steps(folder, *batches):
        for name, more in (("open", {}), ("bound", {"bound": BOUND})):
            query = live.start_decisions(spark, str(folder), str(tmp_path / name), scorer, once=True, **more)
            query.awaitTermination()
            queries.append((name, [live.batch_counts(p) for p in query.recentProgress if p["numInputRows"]][-1], query.lastProgress))
    for name in ("open", "bound"):
        rows = live.read_decisions(spark, str(tmp_path / name)).select("session_id", "src_ip", "threat_level", "cluster", "response_level", "features").collect()
        decisions[name] = sorted(map(tuple, rows))
        assert len(rows) == len({r["session_id"] for r in rows}) or name == "bound"
    # `late` came after the watermark; the id `a` came back long after it was decided, and counts as new
    kept = [d for d in decisions["bound"] if not (d[0] == "a" and '"command_count":0' in d[5])]
    assert kept == [d for d in decisions["open"] if d[0] != "late"] and len(decisions["bound"]) == len(kept) + 1
    bound = [c for n, c, _ in queries if n == "bound"]
    assert bound[0]["good"] == 12 and bound[0]["bad"] == 2 and bound[0]["untimed"] == 0
    assert max(c["state_rows"] for c in bound) >= 6
    last = [live.batch_counts(p)["state_rows"] for n, _, p in queries if n == "bound"]
    assert last[-1] < max(last) and last[-1] <= 6  # the windows of the last sessions only
    assert sum(c["late_rows"] for c in bound) > 0
    open_state = [c["state_rows"] for n, c, _ in queries if n == "open"]
    assert open_state == sorted(open_state) and open_state[-1] == 8


def test_closing_events_in_any_order_decide_once_within_the_bound(spark, tmp_path, scorer):
    first, second = event("x", S.EVENT_CLOSED, 9, duration=1), event("x", S.EVENT_CLOSED, 12, duration=2)
    for name, batches in (("forward", [[first], [second]]), ("back", [[second], [first]]), ("at once", [[second, first]])):
        folder = tmp_path / f"in {name}"
        for _ in steps(folder, *batches):
            got, count = run(spark, folder, tmp_path / name, scorer, bound=BOUND)
        assert count == 1, name


def test_lines_that_come_twice_count_once(spark, tmp_path, scorer):
    lines = [event("s", S.EVENT_COMMAND, 1, input="ls"), event("s", S.EVENT_COMMAND, 2, input="ls"), event("s", S.EVENT_CLOSED, 3, duration=1)]
    folder = tmp_path / "in"
    for _ in steps(folder, lines[:2], lines):
        got, _ = run(spark, folder, tmp_path / "out", scorer, bound=BOUND, drop_repeats=True)
    assert '"command_count":2' in got["s"]["features"]
    with pytest.raises(ValueError, match="bound"):
        live.start_decisions(spark, str(folder), str(tmp_path / "no"), scorer, drop_repeats=True)


def test_snapshot_and_tail_equal_all_decisions(spark, tmp_path, scorer):
    """Seven batches, a snapshot every second one; a repeated batch changes nothing; few files are read."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    for n, _ in enumerate(steps(folder, *[[event(f"s{n}", S.EVENT_LOGIN_SUCCESS, n, username="u", password="p"), event(f"s{n}", S.EVENT_CLOSED, n + 1, duration=n)] for n in range(7)])):
        run(spark, folder, out, scorer, compact_every=2)
        everything = sorted(map(tuple, live.active_state(live.read_decisions(spark, out)).collect()))
        assert sorted(map(tuple, live.current_state(spark, out).collect())) == everything and len(everything) == n + 1
    live.compact(spark, out, 5)
    assert sorted(map(tuple, live.current_state(spark, out).collect())) == everything
    assert live._snapshots(spark, out) == [3, 5]
    read = live.current_state(spark, out).inputFiles()
    assert not any(f"decisions/batch_id={n}/" in f for f in read for n in range(6)) and any("batch_id=6" in f for f in read)


def test_the_carried_level_goes_up_and_says_so(spark):
    row, seen = None, []
    for levels in ([], [0], [1, 0], [0], [], [2, 1], [2]):
        batch = spark.createDataFrame([(n,) for n in levels], "response_level int")
        row = R.carried_level(batch, row).first()
        seen.append((row["response_level"], row["highest_level"], row["strategy"], row["changed"]))
    assert seen == [(None, None, None, False), (0, 0, "low", True), (1, 1, "medium", True), (0, 1, "medium", False), (None, 1, "medium", False),
                    (2, 2, "high", True), (2, 2, "high", False)]
