"""Spark session for local runs, and the shared folder that scratch tables use."""

import os
import tempfile
import uuid
from functools import wraps
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16_000_000


def local_session(cpus="*", app="wardlog", shuffle_partitions=8, **conf) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="wardlog-")
        spark.sparkContext.setCheckpointDir(path)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


_OPEN: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = os.path.join(shared_dir(spark), "wardlog", f"{name}-{uuid.uuid4().hex}")
    for paths in _OPEN[-1:]:
        paths.append(path)
    return path


def tidy(job):
    """Decorator of a job (spark, ...): deletes the scratch tables it made once it has ended.

    For jobs whose results are read from other folders. Other scratch tables stay for those who read them.
    """
    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        _OPEN.append([])
        try:
            return job(spark, *args, **options)
        finally:
            for path in _OPEN.pop():
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return run


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and continue from there.

    Used where one frame feeds many jobs (model sweeps, folds): the lineage is cut by
    files, so a lost executor costs a re-read and not a re-computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a stored table has at most BROADCAST_ROWS rows and BROADCAST_BYTES bytes in its fields."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    found = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return found["n"] <= BROADCAST_ROWS and (found["bytes"] or 0) <= BROADCAST_BYTES


def _width(field):
    """Bytes of a field: those of its text or JSON form, 16 for numbers and times."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(f"`{field.name}`"), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(f"`{field.name}`")), F.lit(0)) + 16
    return F.lit(16)


def counted_up_to(df: DataFrame, limit=BROADCAST_ROWS) -> int:
    """Number of rows, or limit + 1 if there are more."""
    return df.limit(limit + 1).count()


def join_side(df: DataFrame) -> DataFrame:
    """Marks a table for broadcast if it was measured and is small, in rows and in bytes. A larger one is
    joined by shuffle, where adaptive execution splits the partitions of hot keys.

    Pass a stored table: measuring evaluates it. Without the mark, the large side would be written
    to a shuffle before the optimiser learns that the other side is small.
    """
    return F.broadcast(df) if fits_broadcast(df) else df


def at_once(tasks, threads=4) -> list:
    """Runs driver-side functions that each start Spark jobs, a few at a time; results in order.

    Iterative fits are chains of short jobs, which leave most of a cluster idle one by one.
    """
    spark = SparkSession.active()
    pool = ThreadPool(min(threads, max(1, len(tasks))))
    try:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks, chunksize=1)
    finally:
        pool.close()
