"""Arrow columns in and out of tasks: calls, bytes and offsets of text columns, lists and strings from buffers."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 1000  # rows of an Arrow batch: texts are long, and both sides of the pipe hold some batches
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers find this package where it lies in the same place as on the driver.

    On other clusters the package is shipped with --py-files, and the path is one that does not exist.
    Sessions that do not say how many rows an Arrow batch has get BATCH_ROWS.
    """
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, str(BATCH_ROWS))
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """df.mapInArrow; a worker that has done its part gives unused Arrow memory back."""
    on_workers(df.sparkSession)

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one byte array, and where each begins (one more at the end). NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    return raw, at - at[0]


def row_blocks(offsets: np.ndarray, limit: int):
    """Ranges of rows that hold about limit bytes, at least one row each."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(rows, max(stop, start + 1))
        yield start, stop
        start = stop


def strings(data: np.ndarray, offsets: np.ndarray, binary=False) -> pa.Array:
    """A string column over one buffer; text of 2 GB or more gets wide offsets."""
    wide = offsets[-1] >= 2**31
    kind = {(False, False): pa.string(), (True, False): pa.large_string(), (False, True): pa.binary(), (True, True): pa.large_binary()}[wide, binary]
    at = offsets.astype(np.int64 if wide else np.int32)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths: the run of every element and its place inside the run."""
    total = int(lengths.sum())
    run = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return run, np.arange(total) - first[run]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
