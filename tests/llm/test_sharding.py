import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import SCHEMA, document, prose
from wardlog.llm import sharding as S


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def key_part(text):
    """Spark's xxhash64(text is null, text): a boolean is hashed as a 4-byte number."""
    seed = xxhash.xxh64_intdigest((1 if text is None else 0).to_bytes(4, "little"), 42)
    return signed(seed if text is None else xxhash.xxh64_intdigest(text.encode(), seed))


def brute(docs, shards):
    """(id, size, crc, shard, slot) of all rows, by one sort and running sums; rows that agree in id and text may swap."""
    lines = sorted(((key_part(t), key_part(None if d is None else str(d)), d, t) for d, t in docs), key=lambda x: x[:2])
    sizes = [len((t or "").encode()) + 1 for *_, t in lines]
    total, group = sum(sizes), defaultdict(lambda: [0, 0, None])
    begin = 0
    for (h, *_), size in zip(lines, sizes):
        group[h][0] += size
        group[h][1] += 1
        group[h][2] = begin if group[h][2] is None else group[h][2]
        begin += size
    parts, begin, slots, out = S.GROUP_SHARE * shards, 0, Counter(), []
    for (h, _, d, t), size in zip(lines, sizes):
        width, count, start = group[h]
        if width * parts > total or count * parts > len(lines):
            start, width = begin, size
        shard = min(shards - 1, (2 * start + width) * shards // (2 * total))
        out.append((d, size, zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        begin += size
    return sorted(out, key=repr)


def got(df, shards=16, **options):
    found = S.sharded(df.select("doc_id", "text"), shards=shards, carry=["doc_id"], **options)
    return sorted((tuple(r) for r in found.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=repr)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def many(spark):
    rng = random.Random(5)
    docs = [document(n, prose(n, rng.choice([0, 1, 5, 40, 200]))) for n in range(1500)]
    docs += [document(2000 + n, "one text of a third of all rows " * 3) for n in range(700)]
    docs += [document(None, "no id and always the same") for _ in range(150)] + [document(n, "small group") for n in range(5000, 5003)]
    return spark.createDataFrame(docs, SCHEMA).repartition(6)


@pytest.mark.parametrize("shards,range_rows", [(16, 20_000), (16, 20), (3, 7), (1, 100)])
def test_as_one_sort(spark, shards, range_rows):
    df = many(spark)
    assert got(df, shards, range_rows=range_rows) == brute(pairs(df), shards)


def test_shards_are_even_and_groups_whole(spark):
    df = many(spark)
    found = got(df)
    bytes_of, shards_of = Counter(), defaultdict(set)
    for _, size, crc, shard, _ in found:
        bytes_of[shard] += size
        shards_of[crc].add(shard)
    mean = sum(bytes_of.values()) / 16
    assert all(abs(b - mean) <= max(mean / S.GROUP_SHARE, max(r[1] for r in found)) for b in bytes_of.values())
    assert len(shards_of[zlib.crc32(b"small group")]) == 1
    assert sum(len(s) > 1 for s in shards_of.values()) <= 2


def test_ranges_are_subdivided_until_none_is_overfull(spark):
    """Heavy groups and skewed sizes: no range with more than one group or row holds over twice its share."""
    df = many(spark)
    rows = S.materialize(S.keyed_rows(df, carry=["doc_id"]))
    count, size = rows.agg(S.F.count("*"), S.F.sum("size")).first()
    borders, held = S.splitters(rows, count, size, set(S.heavy_groups(rows, count, size, 16)), 100)
    weight = held["size"] + held["rows"] * size / count
    assert held["rows"].sum() == count and held["size"].sum() == size
    assert (weight[held["rows"] > 20] <= 2 * 2 * size / 100).all() and len(borders.keys) >= 50


def test_borders_keep_the_order_of_the_three_numbers():
    rng = np.random.default_rng(1)
    keys = rng.integers(-3, 4, (500, 3)) * rng.choice([1, 2**40, -(2**62)], (500, 1))
    borders = S.Borders(keys[:60])
    want = [sum(tuple(b) <= tuple(k) for b in borders.keys) for k in keys]
    assert borders.ranges_of(keys).tolist() == want


def test_edge_rows_and_files(spark, edge, nothing, tmp_path):
    assert got(edge) == brute(pairs(edge), 16)
    assert S.sharded(nothing).count() == 0
    out = S.sharded(edge)
    assert [c for c in out.columns if c in S.OUTPUTS] == S.OUTPUTS and set(edge.columns) <= set(out.columns)
    S.write_shards(edge, str(tmp_path / "shards"), shards=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, pairs(back))) == sorted(map(repr, pairs(edge)))
    for shard in range(3):
        slots = sorted(r["slot"] for r in back.filter(f"shard = {shard}").collect())
        assert slots == list(range(len(slots)))


def test_given_documents(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    found = S.op11_shard_by_bytes(spark, sf_small)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted((tuple(r) for r in found.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=repr) == brute(pairs(df), 16)
