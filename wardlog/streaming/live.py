"""The live query: log lines to one decision per completed session.

State per session is the constant-size aggregate of the batch operator. It also remembers the
batch in which the session's first closing event arrived; a session is decided in that batch and
in no other, so no table of past decisions has to be searched, and a replayed batch (same batch
time, same number) writes the same rows to the same place.

With a bound, state is dropped by event time. Every event counts in the two windows of twice the bound that hold
it, and a session is decided from the window whose second half holds its first closing event: all its events
of the last bound are in that window. Windows older than the watermark leave the state store; events older than it
are counted by the query's progress. An id that comes back later than that is a new session.

What grows with history is written as changes: decisions per batch, one carried row of levels per batch, and, every
`compact_every` batches, a snapshot of the latest decision per session. Readers take the last snapshot and the batches after it.
"""

import logging
from contextlib import contextmanager
from datetime import timedelta

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wardlog import schema as S
from wardlog.functions import parse_instant
from wardlog.operators.events import valid
from wardlog.operators.respond import active_sessions, carried_level, decision_record, highest_level, strategy_decode
from wardlog.operators.sessions import session_aggregates, with_threat
from wardlog.sources.growing import follow_lines
from wardlog.sources.logs import count_lines, parse_lines, with_order

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTLE = 60  # seconds without a change after which a rotated file is complete
LOG = logging.getLogger(__name__)


def stream_lines(spark: SparkSession, directory: str, pattern=S.FINISHED_LOG_PATTERN, files_per_batch=None) -> DataFrame:
    """Lines of new files in one directory (not below it).

    A file is read once, when it appears, so by default only rotated files are taken: a file that
    the sensor still appends to would lose what comes later, and its last line may be half written.
    """
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.text(directory).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.shiftrightunsigned(F.xxhash64("value"), 1).alias("row"),
    )


def stream_events(spark, directory, pattern=S.FINISHED_LOG_PATTERN, files_per_batch=None, follow=False, settle=SETTLE,
                  bytes_per_batch=0, line_keys=False) -> DataFrame:
    """Parsed events with their order: time, file, block; equal times of a block by content.

    Files are read once, when they appear, and have no row numbers, so only lines with the very same time can swap places.
    `follow=True` reads complete lines as they are appended, of rotated files and of the one the sensor writes; these keep
    their order in a file. Counts of good, bad and blank lines come with the progress of each batch. `line_keys` adds a
    digest of each line, for `without_repeats`.
    """
    if follow:
        lines = follow_lines(spark, directory, pattern, S.FINISHED_LOG_PATTERN, settle, bytes_per_batch)
    else:
        lines = stream_lines(spark, directory, pattern, files_per_batch)
    if line_keys:
        lines = lines.withColumn("line_key", F.md5("value"))
    parsed = count_lines(parse_lines(lines, blank=True))
    return with_order(parsed.where(F.col(S.CORRUPT).isNull() & ~F.col("blank")).drop(S.CORRUPT, "blank"))


def _seconds(bound: timedelta) -> int:
    return max(1, int(bound.total_seconds()))


def timed(events: DataFrame, bound: timedelta) -> DataFrame:
    """Events with their time and a watermark; lines whose time cannot be parsed are counted and left out."""
    at = events.withColumn("at", parse_instant("timestamp")).observe("times", F.count_if(F.col("at").isNull()).alias("untimed"))
    return at.where(F.col("at").isNotNull()).withWatermark("at", f"{_seconds(bound)} seconds")


def without_repeats(events: DataFrame) -> DataFrame:
    """Timed events without lines that were delivered again within the bound, such as those of a copied file."""
    return events.dropDuplicatesWithinWatermark(["session", "line_key"]).drop("line_key")


def stream_sessions(events: DataFrame, bound: timedelta | None = None) -> DataFrame:
    """Sessions over everything seen so far (update mode), with the time of the closing batch.

    With a bound: one row per session and window, `closed_at` is set where this window is the one to decide from,
    `until` is the time of its last event. State stays for three bounds at most.
    """
    closed = F.col("eventid").eqNullSafe(S.EVENT_CLOSED)
    if bound is None:
        found = valid(events).withColumn("_batch", F.current_timestamp())
        grouped = found.groupBy(F.col("session").alias("session_id")).agg(
            *session_aggregates(found), F.min(F.when(closed, F.col("_batch"))).alias("closed_at"))
        return with_threat(grouped)
    long = _seconds(bound)
    found = timed(valid(events), bound)
    if "line_key" in events.columns:
        found = without_repeats(found)
    found = found.withColumn("_batch", F.current_timestamp()).withColumn("window", F.window("at", f"{2 * long} seconds", f"{long} seconds"))
    second = F.unix_micros("at") >= F.unix_micros(F.col("window.start")) + long * 1_000_000
    grouped = found.groupBy(F.col("session").alias("session_id"), "window").agg(
        *session_aggregates(found), F.min(F.when(closed & second, F.col("_batch"))).alias("closed_at"),
        F.coalesce(F.bool_or(closed & ~second), F.lit(False)).alias("_before"), F.max("at").alias("until"))
    return with_threat(grouped.withColumn("closed_at", F.when(~F.col("_before"), F.col("closed_at"))).drop("_before"))


def newly_completed(sessions: DataFrame) -> DataFrame:
    """Sessions whose first closing event belongs to the current batch."""
    return sessions.where(F.col("closed_at") == F.current_timestamp())


def start_decisions(spark: SparkSession, directory: str, out: str, scorer, checkpoint: str | None = None,
                    pattern=S.FINISHED_LOG_PATTERN, files_per_batch=10_000, interval="60 seconds", once=False,
                    follow=False, settle=SETTLE, bytes_per_batch=1 << 30, bound: timedelta | None = None, drop_repeats=False, compact_every=20):
    """Starts the query. `scorer` adds threat_code, cluster and response_level to sessions.

    Decisions go to out/decisions/batch_id=N, the levels after the batch to out/levels/batch_id=N;
    both are overwritten when a batch is repeated. A batch is written by as many tasks as its size asks
    for. `once=True` handles what is there and stops. `follow`, `bound`, `drop_repeats`: see `stream_events` and `stream_sessions`.
    """
    if drop_repeats and bound is None:
        raise ValueError("repeated lines can only be dropped within a bound")
    events = stream_events(spark, directory, pattern, files_per_batch, follow, settle, 0 if once else bytes_per_batch, drop_repeats)
    done = newly_completed(stream_sessions(events, bound))

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if bound is not None:
            batch = _not_recent(batch, out, batch_id)
        path = f"{out}/decisions/batch_id={batch_id}"
        record = decision_record(scorer(batch), F.col("closed_at"), also=["until"] if bound is not None else ())
        record.hint("rebalance").write.mode("overwrite").parquet(path)
        decided = session.read.parquet(path)
        if bound is not None:
            _keep_recent(decided, out, batch_id, bound)
        before = _read_if_there(session, f"{out}/levels/batch_id={batch_id - 1}")
        if before is not None and "highest_level" not in before.columns:  # written by an earlier version
            before = carried_level(read_decisions(session, out).where(F.col("batch_id") < batch_id))
        carried_level(decided, before.first() if before is not None else None).coalesce(1).write.mode("overwrite").parquet(f"{out}/levels/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(session, out, batch_id)

    writer = (
        done.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint or f"{out}/checkpoint")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    with _state_on_disk(spark):
        return writer.start()


def _not_recent(batch: DataFrame, out: str, batch_id: int) -> DataFrame:
    """Without sessions that were decided within the last bounds, from closing events that arrived in another order."""
    recent = _read_if_there(batch.sparkSession, f"{out}/recent/batch_id={batch_id - 1}")
    return batch if recent is None else batch.join(recent.select("session_id"), "session_id", "left_anti")


def _keep_recent(decided: DataFrame, out: str, batch_id: int, bound: timedelta) -> None:
    """The ids decided within three bounds before the last decision: as long as a window can stay in the state."""
    spark = decided.sparkSession
    before = _read_if_there(spark, f"{out}/recent/batch_id={batch_id - 1}")
    every = decided.select("session_id", "until")
    every = every if before is None else every.unionByName(before)
    last = every.agg(F.max("until")).first()[0]
    kept = every if last is None else every.where(F.col("until") >= F.lit(last - 3 * bound))
    kept.write.mode("overwrite").parquet(f"{out}/recent/batch_id={batch_id}")
    _delete(spark, f"{out}/recent/batch_id={batch_id - 3}")  # a repeated batch needs the one before it


@contextmanager
def _state_on_disk(spark: SparkSession):
    """RocksDB for the query started inside, unless the session names a store; its setting comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key, None)
    if before not in (None, default):
        yield
        return
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def keep_running(start, pause=300, wait=None):
    """Restarts the query after a failure, `pause` seconds later; returns when it stops by itself.

    What a restart cannot mend, such as a wrong path or option, is raised.
    """
    import time

    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except (AnalysisException, IllegalArgumentException, TypeError, ValueError):
            raise
        except Exception:
            (wait or time.sleep)(pause)


class Journal(StreamingQueryListener):
    """Logs per batch: lines by kind, lines without a time, rows in the state and rows that came too late for it."""

    def __init__(self, log=None):
        self.log = log or LOG.info

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.log(f"batch {event.progress.batchId}: {batch_counts(event.progress)}")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def batch_counts(progress) -> dict[str, int]:
    """Counts of one batch of the live query, from its progress."""
    observed = {k: v for row in progress["observedMetrics"].values() for k, v in row.asDict().items()}
    state = progress["stateOperators"]
    return observed | {"state_rows": sum(s["numRowsTotal"] for s in state), "late_rows": sum(s["numRowsDroppedByWatermark"] for s in state)}


# --- what the query has written ---------------------------------------------------------------

def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that was written to its end, None if there is none."""
    place, files = _place(spark, f"{path}/_SUCCESS")
    return spark.read.parquet(path) if files.exists(place) else None


def _delete(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def _snapshots(spark: SparkSession, out: str) -> list[int]:
    """Batches of the complete snapshots; compaction leaves two at most."""
    place, files = _place(spark, f"{out}/active/upto=*/_SUCCESS")
    found = files.globStatus(place) or []
    return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found)


def _decisions_after(spark: SparkSession, out: str, batch_id: int, last=None) -> DataFrame | None:
    """Decisions of the batches after one. Their numbers are consecutive, so no folder of all batches is listed."""
    paths, n = [], batch_id + 1
    while last is None or n <= last:
        place, files = _place(spark, f"{out}/decisions/batch_id={n}/_SUCCESS")
        if not files.exists(place):
            break
        paths.append(f"{out}/decisions/batch_id={n}")
        n += 1
    return spark.read.parquet(*paths) if paths else None


def _latest(spark: SparkSession, out: str, snapshot: int | None, last=None) -> DataFrame | None:
    """The last decision per session: a snapshot and the decisions after it."""
    after = _decisions_after(spark, out, -1 if snapshot is None else snapshot, last)
    after = None if after is None else active_sessions(after).drop("strategy")
    if snapshot is None:
        return after
    kept = spark.read.parquet(f"{out}/active/upto={snapshot}")
    return kept if after is None else active_sessions(kept.unionByName(after)).drop("strategy")


def compact(spark: SparkSession, out: str, batch_id: int) -> None:
    """Writes the last decision per session up to a batch, from the snapshot before it; keeps two snapshots."""
    before = [n for n in _snapshots(spark, out) if n < batch_id]
    latest = _latest(spark, out, before[-1] if before else None, batch_id)
    if latest is not None:
        latest.hint("rebalance").write.mode("overwrite").parquet(f"{out}/active/upto={batch_id}")
        for old in before[:-1]:
            _delete(spark, f"{out}/active/upto={old}")


def current_state(spark: SparkSession, out: str) -> DataFrame:
    """The last decision per session, as `active_state` of all decisions, read from the last snapshot and the batches
    after it: what is read does not grow with the number of batches."""
    found = _snapshots(spark, out)
    latest = _latest(spark, out, found[-1] if found else None)
    if latest is None:
        return active_state(read_decisions(spark, out))
    return strategy_decode(latest)


def read_decisions(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/decisions")


def processed_sessions(decisions: DataFrame) -> DataFrame:
    return decisions.select("session_id").distinct()


def active_state(decisions: DataFrame) -> DataFrame:
    return active_sessions(decisions)


def current_level(decisions: DataFrame, since=None) -> DataFrame:
    return highest_level(decisions, since)


def profile_changes(spark: SparkSession, out: str) -> DataFrame:
    """Per batch with decisions: the strategy that should be active and whether that is new."""
    levels = spark.read.parquet(f"{out}/levels")
    return levels.where(F.col("response_level").isNotNull()).select(F.col("batch_id").alias("step"), "highest_level", "strategy", "changed")
