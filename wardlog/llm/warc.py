"""WARC archives: a writer with one gzip member per record, and a sequential reader.

Each task writes one file into a folder that all executors share and reports its path; only reported files
count, so a repeated task leaves an unused file and no wrong row. The reader inflates member after member in
small pieces, frames records by Content-Length, and verifies block and payload digests as the bytes pass.

Payloads are HTTP responses of UTF-8 text. Of records with equal payloads of at least min_bytes, that with the
largest id is a response record and the others are revisit records that keep the HTTP header only and refer to it.

Defined results: NULL text is an empty payload; a NULL address leaves out WARC-Target-URI; rows that repeat
the largest id are responses all of them; rows without an id come before all ids, and are responses where nothing
with an id has their payload; other columns are not read; an empty frame writes no file and reads as an empty frame.
"""

import base64
import hashlib
import os
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlog.llm.columns import map_arrow
from wardlog.llm.words import table
from wardlog.session import materialize, scratch_path

PIECE = 1 << 18
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:record:"  # followed by the id
LINE = b"\r\n"


def _digest(hashed) -> str:
    return base64.b32encode(hashed.digest()).decode()


def _http_header(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def _name(id) -> str:
    return f"<{RECORD}{'' if id is None else quote(str(id), safe='')}>"


def _id(name: str) -> str | None:
    return unquote(name[len(RECORD) + 1:-1]) or None


def record_bytes(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [("WARC-Type", kind), ("WARC-Date", DATE), *fields, ("WARC-Block-Digest", "sha1:" + _digest(hashlib.sha1(block))),
             ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + LINE + block + LINE + LINE) + packer.flush()


def page_record(id, url, payload: bytes, refers_to, original: bool) -> bytes:
    http = _http_header(len(payload))
    fields = [("WARC-Record-ID", _name(id))]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", "sha1:" + _digest(hashlib.sha1(payload)))]
    if original:
        return record_bytes("response", fields, http + payload)
    return record_bytes("revisit", [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))], http)


class Record:
    """Takes the inflated bytes of one record in pieces. The payload is kept only if asked for."""

    def __init__(self, keep=False):
        self.fields, self.pending, self.left, self.http = None, b"", None, None
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.payload_bytes, self.kept, self.tail = 0, bytearray() if keep else None, b""

    def feed(self, piece: bytes):
        if self.fields is None:
            self.pending += piece
            head, gap, piece = self.pending.partition(LINE + LINE)
            if not gap:
                return
            lines = head.decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            self.fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            self.left, self.pending = int(self.fields["content-length"]), b""
        body, rest = piece[:self.left], piece[self.left:]
        self.left -= len(body)
        self.tail += rest
        self.block.update(body)
        if not self.fields.get("content-type", "").startswith("application/http"):
            self._take(body)
        elif self.http is not None:
            self._take(body)
        else:
            self.pending += body
            head, gap, body = self.pending.partition(LINE + LINE)
            if gap:
                self.http, self.pending = head, b""
                self._take(body)

    def _take(self, body: bytes):
        self.payload.update(body)
        self.payload_bytes += len(body)
        if self.kept is not None:
            self.kept += body

    def finish(self) -> dict:
        """The record's facts, after all checks."""
        if self.fields is None or self.left or self.tail != LINE + LINE:
            raise ValueError("a record does not end where its Content-Length says")
        f = self.fields
        if f["warc-block-digest"] != "sha1:" + _digest(self.block):
            raise ValueError(f"wrong block digest in {f['warc-record-id']}")
        kind, digest = f["warc-type"], f.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "response" and digest != _digest(self.payload):
            raise ValueError(f"wrong payload digest in {f['warc-record-id']}")
        length = self.payload_bytes
        if kind == "revisit":  # the header speaks of the payload that is not repeated
            length = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", self.http)[1])
        return {
            "id": _id(f["warc-record-id"]), "record_type": kind, "url": f.get("warc-target-uri"), "payload_bytes": length,
            "payload_digest": digest, "refers_to": _id(f["warc-refers-to"]) if "warc-refers-to" in f else None,
            "payload": bytes(self.kept) if self.kept is not None and kind == "response" else None,
        }


def read_records(stream, keep=False):
    """Records of an open archive in order; memory is one piece, and one payload if it is kept."""
    member, record, raw = None, None, b""
    while True:
        raw = raw or stream.read(PIECE)
        if not raw:
            break
        if member is None:
            member, record = zlib.decompressobj(31), Record(keep)
        record.feed(member.decompress(raw, PIECE))
        if member.eof:
            yield record.finish()
            raw, member = member.unused_data, None
        else:
            raw = member.unconsumed_tail
    if member is not None:
        raise ValueError("the archive ends inside a record")


def _open(uri: str):
    """File system and path of a folder or file that executors share."""
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_warc(df: DataFrame, folder: str, id="page_id", url="url", text="html", min_bytes=0) -> DataFrame:
    """Writes the archives; returns path, records and bytes of each, one row per file."""
    pages = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    last = pages.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("id").alias("last"))
    # an equi-join: the rows of a hot payload can be split between tasks
    marked = pages.join(last, "digest", "left").withColumn(
        "original", F.coalesce(F.octet_length("payload") < min_bytes, F.lit(False)) | F.col("id").eqNullSafe(F.col("last")))

    def write(batches):
        files, target = None, None
        count = size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "last", "original"))):
                if target is None:
                    files, root = _open(folder)
                    files.create_dir(root, recursive=True)
                    context = TaskContext.get()
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                    target = files.open_output_stream(f"{root}/{name}", compression=None)
                    target.write(record_bytes("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                target.write(page_record(*row))
                count += 1
        if target is not None:
            size = target.tell()
            target.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

    return materialize(map_arrow(marked.select("id", "url", "payload", "last", "original"), write, "path string, records long, bytes long"))


def read_warc(archives: DataFrame, payloads=False) -> DataFrame:
    """Records of the archives that a table of paths names, without warcinfo records; one task reads a file in order."""
    names = ["id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, name = _open(path)
                rows, held = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for record in read_records(stream, payloads):
                        if record["record_type"] == "warcinfo":
                            continue
                        rows.append(record)
                        held += len(record["payload"] or b"")
                        if len(rows) >= 5_000 or held > 1 << 24:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    files = max(1, archives.count())
    return map_arrow(archives.select("path").repartition(files), read, ", ".join(
        f"{n} {'long' if n == 'payload_bytes' else 'binary' if n == 'payload' else 'string'}" for n in names))


def archive_folder(spark: SparkSession) -> str:
    path = scratch_path(spark, "warc")
    return path if re.match(r"[a-z0-9]+:", path) else os.path.abspath(path)


def op7_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    records = read_warc(write_warc(pages, archive_folder(spark)))
    kind = dict(pages.dtypes)["page_id"]
    return records.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


_FOUR = ", ".join(f"'{n:04b}'" for n in range(16))
_FIVE = ", ".join(f"'{n:05b}'" for n in range(32))
SQL = f"""
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
bits AS (
    SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: [{_FOUR}][instr('0123456789abcdef', c)]), '') AS b FROM hashed
),
digests AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(generate_series(0, 31),
        lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_position([{_FIVE}], substr(b, CAST(5 * i + 1 AS INTEGER), 5))]), '') AS payload_digest
    FROM bits
),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM digests)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM marked
"""
