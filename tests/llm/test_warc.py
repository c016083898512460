import base64
import gzip
import hashlib
import io
import zlib

import pytest

from tests.llm.conftest import rows
from wardlog.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string, last string, payload string"
PAGES = [(1, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "é😀" * 50_000),
         (6, "http://f", "\r\n\r\nWARC/1.1\r\n"), (None, "http://g", "same"), (None, None, "alone"), (7, "http://h", "twice"), (7, "http://h", "twice")]


def pages(spark, given):
    return spark.createDataFrame([(*p, "clash", "clash", "clash") for p in given], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(given, least=0):
    out = []
    for id, url, text in given:
        text = text or ""
        ids = [i for i, _, t in given if (t or "") == text and i is not None]
        last = max(ids, default=None)
        original = id == last or len(text.encode()) < least
        out.append((None if id is None else str(id), "response" if original else "revisit", len(text.encode()), digest(text),
                    None if original else str(last), text.encode() if original else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,piece", [(0, 1 << 18), (5, 7)])
def test_round_trip(spark, tmp_path, least, piece, monkeypatch):
    monkeypatch.setattr(W, "PIECE", piece)
    given = PAGES if piece > 7 else [p for p in PAGES if p[0] != 5]
    archives = W.write_warc(pages(spark, given).repartition(3), str(tmp_path), min_bytes=least)
    found = W.read_warc(archives, payloads=True)
    assert rows(found.select("id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")) == [
        (a, b, c, d, e, None if f is None else bytearray(f)) for a, b, c, d, e, f in expected(given, least)]
    assert archives.agg({"records": "sum"}).first()[0] == len(given)


def test_each_record_is_a_member(spark, tmp_path):
    archives = W.write_warc(pages(spark, PAGES[:4]), str(tmp_path)).collect()
    for row in archives:
        raw, members = open(row["path"], "rb").read(), 0
        while raw:
            one = zlib.decompressobj(31)
            text = one.decompress(raw)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            raw, members = one.unused_data, members + 1
        assert members == row["records"] + 1  # and the file's own record
        assert gzip.open(row["path"]).read().count(b"WARC-Block-Digest: sha1:") == members


def test_only_reported_files_count(spark, tmp_path):
    archives = W.write_warc(pages(spark, PAGES[:3]), str(tmp_path))
    (tmp_path / "part-000000-lost.warc.gz").write_bytes(b"half a record")
    assert W.read_warc(archives).count() == 3


def test_empty(spark, tmp_path):
    assert W.read_warc(W.write_warc(pages(spark, []), str(tmp_path))).count() == 0


def read(raw):
    return list(W.read_records(io.BytesIO(raw), keep=True))


def test_damage_is_found():
    good = W.page_record(1, "http://a", b"payload", None, True)
    assert read(good * 2)[1]["payload"] == b"payload"
    plain = zlib.decompress(good, 31)
    for bad in (plain.replace(b"payload\r\n", b"paYload\r\n"), plain.replace(b"payload\r\n", b"payloa\r\n"), plain[:-2], b"HTTP" + plain,
                plain.replace(b"\r\nContent-Length: 9", b"\r\nContent-Length: 8")):
        if bad != plain:
            with pytest.raises(ValueError):
                read(gzip.compress(bad))
    with pytest.raises(ValueError):
        read(good[:-9])
    wrong = plain.replace(digest("payload").encode(), digest("other").encode())
    with pytest.raises(ValueError, match="payload digest"):
        read(gzip.compress(wrong))


def test_reader_takes_foreign_records():
    block = b"HTTP/1.1 200 OK\r\ncontent-length: 2\r\n\r\nok"
    other = W.record_bytes("metadata", [("WARC-Record-ID", "<urn:uuid:1>")], b"plain")
    page = W.record_bytes("response", [("WARC-Record-ID", f"<{W.RECORD}a%20b>"), ("Content-Type", "application/http; msgtype=response"),
                                       ("WARC-Payload-Digest", "sha1:" + digest("ok"))], block)
    found = read(other + page)
    assert [(r["id"] if r["record_type"] == "response" else None, r["payload_bytes"]) for r in found] == [(None, 5), ("a b", 2)]
