"""Times the headline queries and prints one JSON line.

Every query starts with an empty memo, so its time holds all the work a user waits for: what it stores, trains or
writes on the way. "build" is the part before the result's own plan runs. "log" queries read JSON lines, written
before the clock starts.

BENCH_SF_DIR: test folder (default sf0.1). BENCH_CPUS: local threads.
"""

import json
import os
import time

from pyspark.sql import functions as F

from wardlog.checks import registry
from wardlog.operators import events as E
from wardlog.operators import sessions as SE
from wardlog.plans import charts as C
from wardlog.plans import profiles as P
from wardlog.session import local_session, materialize
from wardlog.sources import logs

HEADLINE = [
    "threat_characteristics", "session_features", "scan_jsonl", "basic_statistics", "event_distribution",
    "login_summary", "top_credentials", "command_type_distribution", "command_frequency", "command_totals",
    "sessions_by_day", "events_by_hour", "top_ip_profile", "summary_metrics", "stratified_split", "kfold_assign",
    "standard_scale", "impute_median", "metrics_weighted", "roc_auc", "response_lookup", "stream_decision_log",
    "clf_logistic", "clf_random_forest", "feature_importance", "kmeans_sweep_elbow", "pca_2d", "score_session",
]


def on_logs(spark, sf_dir):
    """Queries over the log files of a folder: name -> plan."""
    folder = registry.log_dir(spark, sf_dir)

    def scan():
        return logs.scan_jsonl(spark, folder, pattern=registry.LOG_FILES)

    def summary():
        stored = materialize(SE.session_features(scan()))
        frequency = materialize(P.command_frequency(SE.command_tokens(scan())))
        return C.summary_metrics(stored, E.events_b(scan()), frequency=frequency)

    return {
        "log_threat_characteristics": lambda: P.threat_characteristics(SE.session_features(scan())),
        "log_session_features": lambda: SE.session_features(scan()),
        "log_events_by_hour": lambda: P.events_by_hour(E.events_b(scan())),
        "log_summary_metrics": summary,
    }


def timed(build):
    start = time.perf_counter()
    df = build()
    built = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3), round(built - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    log_queries = on_logs(spark, sf_dir)
    # start the executors and compile before the clock
    P.threat_characteristics(registry.sessions(spark, sf_dir)).agg(F.count(F.lit(1))).collect()
    times, build = {}, {}
    for name in HEADLINE:
        if name in ("scan_jsonl", "stream_decision_log"):  # their log is an input
            registry._STORED.clear()
            registry.log_dir(spark, sf_dir)
        else:
            registry._STORED.clear()
        times[name], build[name] = timed(lambda name=name: registry.QUERIES[name](spark, sf_dir))
    for name, plan in log_queries.items():
        times[name], build[name] = timed(plan)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "build": build,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
