"""A streaming source that follows log files while the sensor appends to them.

The offset of a query is the number of bytes read of every file. Files are known by device and inode, so a rotated file keeps
its offset under its new name; the checksum of its first line tells a file that was emptied and written anew, which
is then read from its beginning. Only complete lines are read. The last line of a rotated file counts as complete, even without
a line break, once the file has not changed for `settle` seconds. A file that is gone keeps its entry for a day, so a
listing that meets a rename in the middle repeats nothing.

The folder must be mounted in the same place on the driver and the executors. What is emptied before it was read is
lost, as with any reader; logs that are renamed lose nothing. Python only finds line ends and byte ranges; lines
leave as Arrow batches, and everything after that is a plan of Spark.
"""

import os
import sys
import time
import zlib
from dataclasses import dataclass
from fnmatch import fnmatch
from urllib.parse import unquote, urlparse

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Workers get this module with the source, so they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 20  # bytes read at a time
SPLIT = 1 << 26  # bytes of new text per task
HEAD = 1 << 12  # bytes of the first line that tell files apart
GONE = 86_400  # seconds that a file which is gone stays known


def local_path(folder: str) -> str:
    parsed = urlparse(folder)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"a folder that is followed must be mounted, not {folder}")
    return unquote(parsed.path) if parsed.scheme else folder


@dataclass
class Span(InputPartition):
    """Lines that begin at byte `start` or later and before byte `stop`; `whole` ends the readable part of the file."""

    path: str
    key: str
    start: int
    stop: int
    whole: int
    first: bool  # whether a line begins exactly at `start`


def last_line_end(path: str, size: int, floor=0) -> int:
    """Place after the last line break among the first `size` bytes, `floor` if there is none after it."""
    with open(path, "rb") as file:
        while size > floor:
            at = max(floor, size - BLOCK)
            file.seek(at)
            found = file.read(size - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            size = at
    return floor


def head_of(path: str) -> int | None:
    """Checksum of the first line (of HEAD bytes at most), None while it is not complete."""
    with open(path, "rb") as file:
        head = file.read(HEAD)
    line = head.partition(b"\n")
    return zlib.crc32(line[0]) if line[1] or len(head) == HEAD else None


def listed(folder: str, pattern: str) -> dict:
    """Files of the folder by device and inode: path, size and time of change."""
    out = {}
    with os.scandir(folder) as entries:
        for entry in entries:
            try:
                if fnmatch(entry.name, pattern) and entry.is_file():
                    stat = os.stat(entry.path)
                    out[f"{stat.st_dev}-{stat.st_ino}"] = (entry.path, stat.st_size, stat.st_mtime)
            except FileNotFoundError:  # renamed or deleted meanwhile; the next look finds it
                continue
    return out


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder, self.pattern = local_path(options["path"]), options.get("pattern", "*")
        self.finished, self.settle = options.get("finished", ""), float(options.get("settle", 60))
        self.limit = int(options.get("bytesPerBatch", 0))
        self.known: dict = {}
        if not os.path.isdir(self.folder):
            raise ValueError(f"no such path: {self.folder}")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out, budget, now = {}, self.limit or None, time.time()
        found = listed(self.folder, self.pattern)
        for key, (path, size, changed) in sorted(found.items(), key=lambda f: (f[1][2], f[1][0])):
            try:
                head = head_of(path)
                before = self.known.get(key)
                floor = before["at"] if before and before["head"] == head and before["at"] <= size else 0
                rotated = bool(self.finished) and fnmatch(os.path.basename(path), self.finished) and now - changed >= self.settle
                if head is None and rotated and size:
                    with open(path, "rb") as file:  # one line without a line break
                        head = zlib.crc32(file.read(HEAD))
                if head is None:
                    continue
                end = size if rotated else last_line_end(path, size, floor)
                if budget is not None and end - floor > budget:
                    end = self._cut(path, floor, floor + budget, end)
            except FileNotFoundError:
                continue
            if budget is not None:
                budget = max(0, budget - (end - floor))
            if end:
                out[key] = {"at": end, "head": head}
        for key, entry in self.known.items():
            if key not in out and now - entry.get("gone", now) <= GONE:
                out[key] = {"at": entry["at"], "head": entry["head"], "gone": entry.get("gone", int(now))} if key not in found else entry
        self.known = out
        return out

    @staticmethod
    def _cut(path, floor, wanted, end):
        """A line end near `wanted`: the last one before it, else the next one."""
        at = last_line_end(path, wanted, floor)
        if at > floor:
            return at
        with open(path, "rb") as file:
            file.seek(wanted)
            while wanted < end:
                block = file.read(BLOCK)
                found = block.find(b"\n")
                if found >= 0:
                    return min(end, wanted + found + 1)
                if not block:
                    break
                wanted += len(block)
        return end

    def partitions(self, start: dict, end: dict):
        self.known = dict(end)
        found, out = listed(self.folder, self.pattern), []
        for key, entry in end.items():
            before = start.get(key)
            at = before["at"] if before and before["head"] == entry["head"] and before["at"] <= entry["at"] else 0
            if at == entry["at"]:
                continue
            if key not in found:
                raise FileNotFoundError(f"a file of {self.folder} that was about to be read is gone (inode {key})")
            for first in range(at, entry["at"], SPLIT):
                out.append(Span(found[key][0], key, first, min(first + SPLIT, entry["at"]), entry["at"], first == at))
        return out

    def read(self, span: Span):
        import pyarrow as pa

        names = ["value", "file", "block", "row"]
        base = (zlib.crc32(span.key.encode()) & 0x3FFFFF) << 40  # lines of a file keep their order, files get a range each
        with open(span.path, "rb") as file:
            at = span.start
            if not span.first:
                file.seek(at - 1)
                at += len(file.readline()) - 1
            file.seek(at)
            rest = b""
            while at < span.stop:
                block = file.read(min(BLOCK, span.whole - at - len(rest)))
                lines = (rest + block).split(b"\n")
                rest = lines.pop() if block else b""
                values, rows = [], []
                for line in lines:
                    if at >= span.stop:
                        break
                    values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    rows.append(base | at)
                    at += len(line) + 1
                if values:
                    n = len(values)
                    yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([span.path] * n, pa.string()),
                                                      pa.array([span.start] * n, pa.int64()), pa.array(rows, pa.int64())], names=names)
                if not block:
                    break


class GrowingLog(DataSource):
    """Format `growing_log`: path, pattern, finished, settle (seconds), bytesPerBatch (0: no limit)."""

    @classmethod
    def name(cls):
        return "growing_log"

    def schema(self):
        return "value string, file string, block long, row long"

    def streamReader(self, schema):
        return GrowingReader(self.options)


def follow_lines(spark: SparkSession, directory: str, pattern: str, finished="", settle=60, bytes_per_batch=0) -> DataFrame:
    """Lines of all files of one directory that match the pattern, as they are appended. After a restart, the first batch
    takes whatever has come meanwhile, whatever the limit."""
    spark.dataSource.register(GrowingLog)
    reader = spark.readStream.format("growing_log").option("path", directory).option("pattern", pattern)
    return reader.options(finished=finished, settle=str(settle), bytesPerBatch=str(bytes_per_batch)).load()
