"""The five jobs a user starts: preprocess, explore, train, evaluate and watch.

Each reads and writes Parquet folders below one data folder:

    lines/ (events and bad lines), sessions/, commands/    preprocess
    profiles/<name>/                                       explore
    models/ (classifier/, clusters/, metrics/, ...)        train
    evaluation/                                            evaluate
    live/ (decisions/, levels/, checkpoint/)               watch
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.functions import day
from wardlog.operators import events as E
from wardlog.operators import metrics as M
from wardlog.operators import respond as R
from wardlog.operators import sampling as SA
from wardlog.operators import sessions as SE
from wardlog.plans import charts as C
from wardlog.plans import learning as L
from wardlog.plans import profiles as P
from wardlog.plans import scoring
from wardlog.session import materialize, tidy
from wardlog.sources import logs
from wardlog.sources.sinks import read_table, sample_rows, write_metrics, write_table
from wardlog.streaming import live


def stored_events(spark: SparkSession, data: str) -> DataFrame:
    return read_table(spark, f"{data}/lines").where(F.col("readable") == 1).drop("readable", S.CORRUPT)


def stored_quarantine(spark: SparkSession, data: str) -> DataFrame:
    return read_table(spark, f"{data}/lines").where(F.col("readable") == 0).select(S.CORRUPT, "file")


@tidy
def preprocess(spark: SparkSession, roots, data: str, per_file=False, pattern=S.LOG_FILE_PATTERN) -> DataFrame:
    """Raw logs to stored events, bad lines, sessions and joined texts; returns the basic statistics and the
    numbers of good, bad and blank lines, which are counted while the lines are written.

    The text is read and parsed once. Lines are stored by readability and day, so that later reads
    of a period skip the rest; the rebalance splits days that are too large for one task and
    merges small ones.
    """
    counts = Observation("lines")
    found = logs.count_lines(logs.parse_lines(logs.scan_lines(spark, roots, pattern=pattern), blank=True), counts)
    parsed = logs.with_order(found.where(~F.col("blank")).drop("blank")).withColumns({
        "readable": F.col(S.CORRUPT).isNull().cast("int"), "day": day(F.col("ts")),
    })
    write_table(parsed.hint("rebalance", "readable", "day"), f"{data}/lines", ["readable", "day"])
    events = stored_events(spark, data)
    write_table(SE.session_features(events, per_file), f"{data}/sessions")
    write_table(SE.commands(events), f"{data}/commands")
    statistics = P.basic_statistics(read_table(spark, f"{data}/sessions"), E.events_b(events))
    return statistics.withColumns({f"{kind}_lines": F.lit(counts.get[kind]).cast("long") for kind in ("good", "bad", "blank")})


@tidy
def explore(spark: SparkSession, data: str) -> dict[str, DataFrame]:
    """Writes every profile and the summary; returns them as read back."""
    raw = stored_events(spark, data)
    events, sessions = E.events_b(raw), read_table(spark, f"{data}/sessions")
    # Counts per command are far smaller than the tokens, and three profiles use them.
    frequency = materialize(P.command_frequency(SE.command_tokens(raw)))
    profiles = {
        "event_distribution": P.event_distribution(events),
        "login_summary": P.login_summary(events),
        "top_credentials": P.top_credentials(events),
        "command_types": P.command_type_distribution(sessions),
        "top_commands": P.top_k(frequency, "command", 20),
        "command_totals": P.totals_from_frequency(sessions, frequency),
        "threat_distribution": P.threat_distribution(sessions),
        "threat_characteristics": P.threat_characteristics(sessions),
        "sessions_by_day": P.sessions_by_day(sessions), "sessions_by_hour": P.sessions_by_hour(sessions),
        "events_by_day": P.events_by_day(events), "events_by_hour": P.events_by_hour(events),
        "unique_ips": P.unique_ips(sessions), "top_ips": C.ip_bars(sessions), "top_ip_profile": P.top_ip_profile(sessions),
        "summary": C.summary_metrics(sessions, events, frequency=frequency),
    }
    for name, profile in profiles.items():
        write_table(profile, f"{data}/profiles/{name}")
    return {name: read_table(spark, f"{data}/profiles/{name}") for name in profiles}


def _training_rows(spark, data, columns):
    return L.store_rows(L.training_matrix(read_table(spark, f"{data}/sessions"), columns))


@tidy
def train(spark: SparkSession, data: str, columns=S.SERVING_FEATURES, names=L.MODELS, **options) -> DataFrame:
    """Split, bake-off, importance, clusters and response map; stores them and returns the metrics.

    Training uses the features that scoring has. The stored classifier is the best by F1.
    """
    out = f"{data}/models"
    rows = _training_rows(spark, data, columns)
    split = materialize(SA.stratified_split(rows))
    train_rows, test = split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")
    train_rows = SA.synthesize_minority(train_rows)
    metrics, models = L.bake_off(train_rows, test, columns, names, **options)
    best = M.best_model(metrics).first()["model"]
    if best is not None:
        models[best].save(f"{out}/classifier")
    clusters, sweep = L.train_clusters(rows, columns)
    clusters.save(f"{out}/clusters")
    labelled = clusters.transform(rows).withColumnRenamed("label", "threat_code")
    write_table(metrics, f"{out}/metrics")
    write_metrics(metrics, f"{out}/metrics_long")
    write_table(sweep, f"{out}/sweep")
    write_table(L.feature_importance(rows, columns), f"{out}/importance")
    write_table(R.response_map_cluster_rule(labelled), f"{out}/response_map")
    write_table(sample_rows(train_rows), f"{out}/sample")
    spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "position int, feature string").write.mode(
        "overwrite").parquet(f"{out}/features")
    return read_table(spark, f"{out}/metrics")


@tidy
def evaluate(spark: SparkSession, data: str, columns=S.SERVING_FEATURES, names=L.MODELS, noise=0.05, folds=5,
             scale_scope="train", **options) -> DataFrame:
    """Noise, checked split, hold-out and cross-validated metrics side by side, importances."""
    out = f"{data}/evaluation"
    rows = _training_rows(spark, data, columns)
    if noise:
        rows = materialize(SA.with_noise(rows, columns, level=noise))
    split = materialize(SA.improved_split(rows))
    train_rows, test = split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")
    metrics, _ = L.bake_off(train_rows, test, columns, names, **options)
    done = [r["model"] for r in metrics.where(F.col("error").isNull()).collect()]
    crossed = L.cross_validate(train_rows, columns, done, folds, scale_scope, **options)
    write_table(M.align_metrics(metrics, crossed), f"{out}/comparison")
    write_table(L.feature_importance(rows, columns), f"{out}/importance")
    return M.leaderboard(read_table(spark, f"{out}/comparison"))


def report(spark: SparkSession, data: str) -> dict[str, DataFrame]:
    """Tables of the trained models: leaderboard, importances, decoded response map."""
    out = f"{data}/models"
    return {
        "leaderboard": M.leaderboard(read_table(spark, f"{out}/metrics")),
        "importance": read_table(spark, f"{out}/importance").orderBy(F.desc("importance"), "feature"),
        "responses": R.report_table(read_table(spark, f"{out}/response_map")),
    }


def watch(spark: SparkSession, directory: str, data: str, **options):
    """Starts the live query with the stored models. Options are those of `live.start_decisions`."""
    classifier, clusters = L.Fitted.load(f"{data}/models/classifier"), L.Clusters.load(f"{data}/models/clusters")
    mapping = R.lookup_side(read_table(spark, f"{data}/models/response_map"))
    return live.start_decisions(
        spark, directory, f"{data}/live", lambda batch: scoring.score_with_models(batch, classifier, clusters, mapping), **options
    )
