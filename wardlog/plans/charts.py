"""Data behind the charts, as tables, and the long table of headline numbers."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.functions import day, hour, parse_ts, prettify
from wardlog.plans import profiles as P


def event_bars(events: DataFrame, k=15) -> DataFrame:
    return P.event_distribution(events).orderBy(F.desc("percentage"), "event_id").limit(k).select(
        "event_id", "percentage"
    )


def login_outcomes(events: DataFrame) -> DataFrame:
    """Two bars; the share of failures is 100 minus the success rate."""
    one = P.login_summary(events)
    return one.select(F.explode(F.array(
        F.struct(F.lit("Failed").alias("outcome"), F.col("failed_logins").alias("count"),
                 (100 - F.col("success_rate")).alias("percentage")),
        F.struct(F.lit("Successful").alias("outcome"), F.col("successful_logins").alias("count"),
                 F.col("success_rate").alias("percentage")),
    )).alias("bar")).select("bar.*")


def credential_bars(events: DataFrame, k=10) -> DataFrame:
    top = P.top_credentials(events, k)
    return top.where(F.col("outcome") == "success").select("field", "value", "count")


def command_type_bars(sessions: DataFrame) -> DataFrame:
    return P.command_type_distribution(sessions).select(
        prettify(F.col("command_type")).alias("label"), "percentage"
    )


def command_bars(tokens: DataFrame, k=20) -> DataFrame:
    return P.top_k(P.command_frequency(tokens), "command", k)


def threat_level_bars(sessions: DataFrame) -> DataFrame:
    return P.threat_distribution(sessions).select("threat_level", "percentage")


LEVEL_METRICS = ["avg_command_count", "login_success_rate", *P.FLAGS_BY_LEVEL]


def threat_metric_bars(sessions: DataFrame) -> DataFrame:
    """Seven metrics by three levels, long form."""
    table = P.threat_characteristics(sessions)
    return table.unpivot("threat_level", LEVEL_METRICS, "metric", "value").select(
        "threat_level", "metric", prettify(F.col("metric")).alias("label"), "value"
    )


def temporal_series(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Four series; the x value is text, because days and hours share the column. Each table is read once."""
    def series(name, df, column):
        ts = parse_ts(column)
        keys = df.select(day(ts).cast("string").alias("day"), hour(ts).cast("string").alias("hour")).where("day IS NOT NULL")
        counts = keys.groupingSets([["day"], ["hour"]], "day", "hour").agg(F.count(F.lit(1)).alias("count"))
        kind = F.when(F.col("day").isNotNull(), F.lit(f"{name}_by_day")).otherwise(F.lit(f"{name}_by_hour"))
        return counts.select(kind.alias("series"), F.coalesce("day", "hour").alias("x"), "count")

    return series("sessions", sessions, "start_time").unionByName(series("events", events, "timestamp"))


def ip_threat_stack(sessions: DataFrame, k=10) -> DataFrame:
    return P.top_ip_profile(sessions, k).select(
        "src_ip", *[F.col(f"{level}_threat").alias(level) for level in S.LEVELS]
    )


def ip_bars(sessions: DataFrame, k=20) -> DataFrame:
    return P.top_k(P.ip_counts(sessions), "src_ip", k)


def summary_metrics(sessions: DataFrame, events: DataFrame, tokens: DataFrame | None = None, k=5, frequency=None) -> DataFrame:
    """All headline numbers as (section, metric, value), from tokens or from counts per command.

    Every profile is taken once; one with several numbers per row is spread by an array.
    """
    def entry(section, metric, value):
        text = [F.lit(x) if isinstance(x, str) else x for x in (section, metric)]
        return F.struct(text[0].alias("section"), text[1].alias("metric"), value.cast("double").alias("value"))

    def spread(df, *entries):
        return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")

    def one_section(section, df, names):
        return spread(df, *[entry(section, n, F.col(n)) for n in names])

    frequency = frequency if frequency is not None else P.command_frequency(tokens)
    login = P.login_summary(events).withColumn("failure_rate", 100 - F.col("success_rate"))
    credentials = P.top_credentials(events, k).where(F.col("outcome") == "success")
    level, kind = F.col("threat_level"), prettify(F.col("command_type"))
    averages = ["avg_command_count", "login_success_rate"]
    high_only = ["has_download_command", "has_privilege_escalation"]
    levels = spread(
        P.threat_characteristics(sessions),
        entry("threat_count", level, F.col("count")), entry("threat_percentage", level, F.col("percentage")),
        *[entry(F.concat(F.lit("threat_"), level), n, F.col(n)) for n in averages],
        *[entry(F.when(level == "high", "threat_high"), n, F.col(n)) for n in high_only],
    ).where(F.col("section").isNotNull())
    kinds = spread(
        P.command_type_distribution(sessions),
        entry("command_type_count", kind, F.col("count")), entry("command_type_percentage", kind, F.col("percentage")),
    )
    return reduce(DataFrame.unionByName, [
        one_section("login", login, ["total_attempts", "successful_logins", "success_rate", "failed_logins", "failure_rate"]),
        spread(credentials, entry("top_credentials", F.concat_ws(":", "field", "value"), F.col("count"))),
        one_section("commands", P.totals_from_frequency(sessions, frequency),
                    ["total_command_sessions", "total_commands", "unique_commands"]),
        kinds,
        spread(P.top_k(frequency, "command", k), entry("top_commands", F.col("command"), F.col("count"))),
        levels,
        one_section("source_ips", P.unique_ips(sessions), ["unique_ips"]),
        spread(ip_bars(sessions, k), entry("top_source_ips", F.col("src_ip"), F.col("count"))),
    ])
