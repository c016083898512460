"""Exploratory profiles of events and sessions.

Every profile is one grouped pass; loops over levels or addresses became conditional
aggregates. Percentages divide by a total that is taken from the already aggregated rows.
Ties in ranked lists are broken by key.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.functions import blank_to_null, day, hour, parse_ts, percent
from wardlog.operators.events import active, with_command_text


def count_by(df: DataFrame, *keys) -> DataFrame:
    """Group sizes; rows with a NULL key are left out."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return df.where(condition).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def top_k(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The k largest counts (each task keeps only its own k)."""
    return counts.orderBy(F.desc("count"), F.asc(key)).limit(k)


def pct_of_total(counts: DataFrame, value="count", name="percentage") -> DataFrame:
    """Adds value / total * 100. The total is a scalar subquery over the grouped rows; a window
    without partitions would move all groups into one task."""
    total = counts.agg(F.sum(value)).scalar()
    return counts.withColumn(name, percent(F.col(value), total))


def basic_statistics(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """Headline counts in one row; a missing column counts as 0."""
    def count_if(column, condition):
        return F.count_if(condition) if column in sessions.columns else F.lit(0).cast("bigint")

    by_level = [
        count_if("threat_level", F.col("threat_level") == level).alias(f"{level}_threat")
        for level in S.LEVELS
    ]
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        count_if("login_success", F.col("login_success").cast("boolean")).alias("successful_logins"),
        count_if("command_count", F.col("command_count") > 0).alias("sessions_with_commands"),
        *by_level,
    ).withColumn("total_events", events.agg(F.count(F.lit(1))).scalar())


def event_distribution(events: DataFrame) -> DataFrame:
    """Count and share per event type. The share is of all events, also those without a type."""
    grouped = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("count"))
    return pct_of_total(grouped).where(F.col("event_id").isNotNull()).orderBy(F.desc("count"), "event_id")


def login_summary(events: DataFrame) -> DataFrame:
    ok = F.col("event_id") == S.EVENT_LOGIN_SUCCESS
    failed = F.col("event_id") == S.EVENT_LOGIN_FAILED
    counts = events.agg(
        F.count_if(ok | failed).alias("total_attempts"),
        F.count_if(ok).alias("successful_logins"),
        F.count_if(failed).alias("failed_logins"),
    )
    rate = percent(F.col("successful_logins"), F.col("total_attempts"))
    return counts.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))


def credential_counts(events: DataFrame) -> DataFrame:
    """Uses of each user name and password by outcome, in one pass."""
    outcome = (
        F.when(F.col("event_id") == S.EVENT_LOGIN_SUCCESS, "success")
        .when(F.col("event_id") == S.EVENT_LOGIN_FAILED, "failed")
    )
    logins = events.where(
        F.col("event_id").isin(S.EVENT_LOGIN_SUCCESS, S.EVENT_LOGIN_FAILED)
    ).select(outcome.alias("outcome"), "username", "password")
    long = logins.unpivot("outcome", ["username", "password"], "field", "value")
    return count_by(long.withColumn("value", blank_to_null("value")), "outcome", "field", "value")


def top_credentials(events: DataFrame, k=10) -> DataFrame:
    """Top k of the four lists. Tasks cut their own rows to k before the shuffle."""
    order = W.partitionBy("outcome", "field").orderBy(F.desc("count"), "value")
    return credential_counts(events).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def command_type_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per command type (a session may have several) and those without any."""
    flags = list(S.COMMAND_TYPES.items())
    found = F.greatest(*[F.col(f) for _, f in flags])
    sums = with_command_text(sessions).agg(
        *[F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias(name) for name, f in flags],
        F.coalesce(F.sum(1 - found), F.lit(0)).cast("bigint").alias("other"),
    )
    names = [name for name, _ in flags] + ["other"]
    return sums.unpivot([], names, "command_type", "count")


def command_type_distribution(sessions: DataFrame) -> DataFrame:
    """Share of each type in the sum over the types."""
    return pct_of_total(command_type_counts(sessions)).orderBy(F.desc("count"), "command_type")


def command_frequency(tokens: DataFrame) -> DataFrame:
    return count_by(tokens, "command")


def command_totals(sessions: DataFrame, tokens: DataFrame, approximate=False) -> DataFrame:
    """Active sessions, tokens, and different tokens (by sketch, if asked for)."""
    if not approximate:
        return totals_from_frequency(sessions, command_frequency(tokens))
    totals = tokens.agg(
        F.count(F.lit(1)).alias("total_commands"), F.approx_count_distinct("command").alias("unique_commands")
    )
    return _with_active(totals, sessions)


def totals_from_frequency(sessions: DataFrame, frequency: DataFrame) -> DataFrame:
    """The exact totals, out of counts per command."""
    totals = frequency.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_commands"), F.count(F.lit(1)).alias("unique_commands")
    )
    return _with_active(totals, sessions)


def _with_active(totals, sessions):
    return totals.withColumn("total_command_sessions", active(sessions).agg(F.count(F.lit(1))).scalar())


def threat_distribution(sessions: DataFrame) -> DataFrame:
    grouped = sessions.groupBy("threat_level").agg(F.count(F.lit(1)).alias("count"))
    return pct_of_total(grouped).where(F.col("threat_level").isNotNull()).orderBy(F.desc("count"), "threat_level")


FLAGS_BY_LEVEL = [n for n in S.PATTERNS if n != "has_file_access"]


def threat_characteristics(sessions: DataFrame) -> DataFrame:
    """Averages and rates per level. All three levels appear, also empty ones."""
    def rate(name):
        if name not in sessions.columns:
            return F.lit(0.0)
        return F.avg(F.col(name).cast("int")) * 100

    grouped = sessions.groupBy("threat_level").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("duration").alias("avg_duration"),
        F.avg("command_count").alias("avg_command_count"),
        rate("login_success").alias("login_success_rate"),
        *[rate(n).alias(n) for n in FLAGS_BY_LEVEL],
    )
    # At most one row per level, and one for sessions without a level: the total may be a window.
    share = percent(F.col("count"), F.sum("count").over(W.partitionBy()))
    levels = sessions.sparkSession.createDataFrame([(n,) for n in S.LEVEL_REPORT_ORDER], "threat_level string")
    out = levels.join(grouped.withColumn("percentage", share), "threat_level", "left")
    return out.select(
        "threat_level", F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("percentage", F.lit(0.0)).alias("percentage"),
        "avg_duration", "avg_command_count", "login_success_rate", *FLAGS_BY_LEVEL,
    )


def by_day(df: DataFrame, ts) -> DataFrame:
    return count_by(df.select(day(ts).alias("day")), "day").orderBy("day")


def by_hour(df: DataFrame, ts) -> DataFrame:
    return count_by(df.select(hour(ts).alias("hour")), "hour").orderBy("hour")


def sessions_by_day(sessions: DataFrame) -> DataFrame:
    return by_day(sessions, parse_ts("start_time"))


def sessions_by_hour(sessions: DataFrame) -> DataFrame:
    return by_hour(sessions, parse_ts("start_time"))


def events_by_day(events: DataFrame) -> DataFrame:
    return by_day(events, parse_ts("timestamp"))


def events_by_hour(events: DataFrame) -> DataFrame:
    return by_hour(events, parse_ts("timestamp"))


def known_ips(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("src_ip", blank_to_null("src_ip")).where(F.col("src_ip").isNotNull())


def unique_ips(sessions: DataFrame) -> DataFrame:
    return known_ips(sessions).agg(F.countDistinct("src_ip").alias("unique_ips"))


def ip_counts(sessions: DataFrame) -> DataFrame:
    return count_by(known_ips(sessions), "src_ip")


def top_ip_profile(sessions: DataFrame, k=20) -> DataFrame:
    """Profile of the k addresses with most sessions: one grouped pass, then top k."""
    return (
        known_ips(sessions).groupBy("src_ip").agg(
            F.count(F.lit(1)).alias("total_sessions"),
            *[
                F.count_if(F.col("threat_level") == level).alias(f"{level}_threat")
                for level in S.LEVEL_REPORT_ORDER
            ],
            (F.avg(F.col("login_success").cast("int")) * 100).alias("login_success_rate"),
            F.avg("command_count").alias("avg_command_count"),
        )
        .orderBy(F.desc("total_sessions"), "src_ip").limit(k)
    )


def top_ip_sessions(sessions: DataFrame, k=20) -> DataFrame:
    """Sessions of the top k addresses; k rows are broadcast."""
    top = top_k(ip_counts(sessions), "src_ip", k).select("src_ip")
    return known_ips(sessions).join(F.broadcast(top), "src_ip", "left_semi")
