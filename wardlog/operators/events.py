"""Flat event tables, column backfill and the simple row filters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog import schema as S
from wardlog.functions import blank_to_null, number_or_zero, text_or_empty


def valid(events: DataFrame) -> DataFrame:
    """Events that belong to a session."""
    return events.where(blank_to_null("session").isNotNull())


def has_key(events: DataFrame, name: str):
    """Key present in the payload, even with the value null where the key names are known."""
    present = F.col(name).isNotNull()
    return present | F.array_contains("keys", name) if "keys" in events.columns else present


def events_a(events: DataFrame) -> DataFrame:
    """Six columns; rows that carry both a session and an event id key; success is 0/1."""
    return events.where(has_key(events, "session") & has_key(events, "eventid")).select(
        F.col("session").alias("session_id"),
        text_or_empty("timestamp").alias("timestamp"),
        F.col("eventid").alias("event_type"),
        text_or_empty("src_ip").alias("src_ip"),
        text_or_empty("input").alias("input"),
        F.col("eventid").eqNullSafe(S.EVENT_LOGIN_SUCCESS).cast("int").alias("success"),
    )


def events_b(events: DataFrame) -> DataFrame:
    """Nine columns; rows whose session and event ids are not empty; success from the payload."""
    return events.where(
        blank_to_null("session").isNotNull() & blank_to_null("eventid").isNotNull()
    ).select(
        text_or_empty("timestamp").alias("timestamp"),
        F.col("session").alias("session_id"),
        F.col("eventid").alias("event_id"),
        text_or_empty("src_ip").alias("src_ip"),
        text_or_empty("username").alias("username"),
        text_or_empty("password").alias("password"),
        text_or_empty("input").alias("input"),
        number_or_zero("duration").alias("duration"),
        F.coalesce(F.col("success").try_cast("boolean"), F.lit(False)).alias("success"),
    )


def backfill(df: DataFrame, required, value=0) -> DataFrame:
    """Adds each required column that is missing, as a constant."""
    missing = [c for c in required if c not in df.columns]
    return df.withColumns({c: F.lit(value) for c in missing}) if missing else df


def empty_sessions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.EMPTY_SESSIONS_SCHEMA)


def empty_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.EVENTS_A_SCHEMA)


def of_type(events: DataFrame, event_id: str) -> DataFrame:
    return events.where(F.col("event_id") == event_id)


def active(sessions: DataFrame) -> DataFrame:
    """Sessions with at least one command."""
    return sessions.where(F.col("command_count") > 0)


def completed(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("end_time").isNotNull())


def with_command_text(sessions: DataFrame) -> DataFrame:
    """Active sessions whose joined command text is not empty."""
    return active(sessions).where("has_command_text")


def by_level(sessions: DataFrame, level: str) -> DataFrame:
    return sessions.where(F.col("threat_level") == level)


def by_ip(sessions: DataFrame, ip: str) -> DataFrame:
    return sessions.where(F.col("src_ip") == ip)


def unseen(sessions: DataFrame, processed: DataFrame) -> DataFrame:
    """Completed sessions that have no decision yet.

    The join side is left to the optimiser: it broadcasts the processed ids only while their
    measured size is below spark.sql.autoBroadcastJoinThreshold.
    """
    return completed(sessions).join(processed.select("session_id"), "session_id", "left_anti")


def union_events(frames) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
