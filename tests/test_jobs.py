import pytest

from wardlog.checks import registry
from wardlog.plans import jobs
from wardlog.sources import sinks
from wardlog.streaming import live

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    sinks.write_log_lines(registry.raw(spark, D), str(folder / "logs"))
    return str(folder)


def test_all_jobs_in_order(spark, data):
    stats = jobs.preprocess(spark, [f"{data}/logs"], data, pattern="part-*").first()
    assert (stats["total_sessions"], stats["total_events"], stats["high_threat"]) == (397, 1000, 29)

    assert jobs.stored_events(spark, data).count() == 1000 and jobs.stored_quarantine(spark, data).count() == 0

    profiles = jobs.explore(spark, data)
    levels = {r["threat_level"]: r["count"] for r in profiles["threat_characteristics"].collect()}
    assert levels == {"high": 29, "medium": 157, "low": 211}
    expected = registry.QUERIES["summary_metrics"](spark, D)
    assert sorted(map(tuple, profiles["summary"].collect())) == sorted(map(tuple, expected.collect()))

    names = ["random_forest", "logistic_regression"]
    metrics = jobs.train(spark, data, names=names, trees=10, depth=6, iterations=50).collect()
    assert len(metrics) == 2 and all(r["f1"] > 0.6 for r in metrics)
    tables = jobs.report(spark, data)
    assert tables["leaderboard"].count() == 2 and tables["importance"].count() == 9
    assert {r["threat_level"] for r in tables["responses"].collect()} == {"Low", "Medium", "High"}

    compared = jobs.evaluate(spark, data, names=names, folds=3, trees=10, depth=6, iterations=50).collect()
    assert len(compared) == 2 and all(r["cv_accuracy"] > 0.5 for r in compared)

    jobs.watch(spark, f"{data}/logs", data, pattern="part-*", once=True).awaitTermination()
    decisions = live.read_decisions(spark, f"{data}/live")
    closed = sinks.read_table(spark, f"{data}/sessions").where("end_time is not null").count()
    assert decisions.count() == closed and decisions.select("session_id").distinct().count() == closed


def test_a_day_is_read_alone(spark, data):
    plan = jobs.stored_events(spark, data).where("day = date'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(readable" in plan.split("PartitionFilters")[1] and "day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_bad_lines_are_kept_apart(spark, micro_dir, tmp_path):
    jobs.preprocess(spark, micro_dir, str(tmp_path / "data"))
    assert {r[0] for r in jobs.stored_quarantine(spark, str(tmp_path / "data")).collect()} == {"not json", "[1,2]"}
    assert jobs.stored_events(spark, str(tmp_path / "data")).count() == 12


def test_command_line(spark, micro_dir, tmp_path, monkeypatch, capsys):
    from wardlog import __main__ as command

    for job in (["preprocess", "--logs", micro_dir], ["explore"]):
        monkeypatch.setattr("sys.argv", ["wardlog", *job, "--data", str(tmp_path / "data")])
        command.main()
    shown = capsys.readouterr().out
    assert "total_sessions" in shown and "threat_percentage" in shown


def test_switches_of_the_command_line(monkeypatch):
    from wardlog import __main__ as command

    seen = {}

    class Table:
        def show(self, *_, **__):
            pass

    def note(name):
        return lambda spark, *args, **options: seen.update({name: (args, options)}) or Table()

    for name in ("preprocess", "evaluate", "watch"):
        monkeypatch.setattr(command.jobs, name, note(name))
    monkeypatch.setattr("wardlog.streaming.live.keep_running", lambda start: start())
    command.main(["preprocess", "--logs", "a", "b", "--data", "d", "--per-file", "--pattern", "x*"])
    command.main(["evaluate", "--data", "d", "--noise", "0", "--folds", "3", "--scale-scope", "fold"])
    command.main(["watch", "--logs", "a", "--data", "d"])
    assert seen["preprocess"] == ((["a", "b"], "d"), {"per_file": True, "pattern": "x*"})
    assert seen["evaluate"] == (("d",), {"noise": 0.0, "folds": 3, "scale_scope": "fold"})
    assert seen["watch"] == (("a", "d"), {"pattern": "cowrie.json.*", "interval": "60 seconds"})


def test_a_job_deletes_its_scratch_tables(spark):
    import os

    from wardlog.session import materialize, scratch_path, shared_dir, tidy

    kept, made = materialize(spark.range(3)), []

    @tidy
    def outer(spark, n):
        made.append(scratch_path(spark, "mine"))
        spark.range(n).write.parquet(made[0])
        return inner(spark)

    @tidy
    def inner(spark):
        made.append(scratch_path(spark, "inner"))
        return materialize(spark.range(2)).count()

    before = set(os.listdir(os.path.join(shared_dir(spark), "wardlog")))
    assert outer(spark, 2) == 2 and kept.count() == 3
    assert set(os.listdir(os.path.join(shared_dir(spark), "wardlog"))) == before and len(set(made)) == 2
