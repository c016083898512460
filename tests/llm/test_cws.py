import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import prose, rows
from wardlog.llm import cws as C


def jaccard(a, b):
    a, b = (Counter(x.encode().lower().split()) for x in (a, b))
    words = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words)


def test_collisions_are_generalised_jaccard():
    sampler, errors = C.Sampler(4096, 2048), []
    for n in range(8):
        one = prose(n, 150, 90)
        two = " ".join(one.split()[: 30 * n // 2 + 20]) + " " + prose(100 + n, 80, 90)
        found = C.likeness(sampler.fingerprint(one.encode()), sampler.fingerprint(two.encode()))
        errors.append(found - jaccard(one, two))
    assert max(map(abs, errors)) < 0.04 and abs(np.mean(errors)) < 0.015


def test_room_and_blocks_do_not_matter(monkeypatch):
    text = prose(3, 700).encode()
    whole = C.Sampler(64, 1 << 12).fingerprint(text)
    monkeypatch.setattr(C, "BLOCK", 50)
    tight = C.Sampler(64, 60)
    assert (tight.fingerprint(prose(9, 300).encode()) != whole).any() and (tight.fingerprint(text) == whole).all()


def test_order_of_words_and_case_do_not_matter():
    s = C.Sampler(64, 1 << 10)
    assert (s.fingerprint(b"a b B c") == s.fingerprint(b"C  b\nb A")).all()
    assert (s.fingerprint(b"") == s.fingerprint(b" \t")).all() and not (s.fingerprint(b"a") == s.fingerprint(b"")).any()


def spot(text):
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64))


def brute(docs):
    order = sorted(docs, key=lambda d: (-(d[0] if d[0] is not None else C.NO_ID), -spot(d[1] or ""), d[1] or ""))
    sampler, out = C.Sampler(), []
    for i, (id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, changed, after = (sampler.fingerprint(x.encode()) for x in (text, edited, following))
        out.append((id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(),
                    float((own == changed).mean()), float((own == after).mean())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [1000, 7, 1])
def test_edited_neighbours(spark, edge, size, monkeypatch, tmp_path):
    monkeypatch.setattr(C, "RANGE_ROWS", size)
    rng = random.Random(8)
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()] + [(rng.randrange(100, 10**12), prose(n, rng.randrange(0, 40))) for n in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(C.op5_fingerprints(spark, str(tmp_path))) == brute(docs)


@pytest.mark.parametrize("hot", [None, 10**6, 7])
def test_an_id_with_most_rows(spark, hot, monkeypatch, tmp_path):
    monkeypatch.setattr(C, "RANGE_ROWS", 10)
    docs = [(hot, prose(n, 12)) for n in range(200)] + [(n * 17, prose(1000 + n, 9)) for n in range(100)] + [(n * 17, "twice") for n in range(9)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(C.op5_fingerprints(spark, str(tmp_path))) == brute(docs)


def test_ranges_split_heavy_ids():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 10**9, 40_000), np.full(30_000, C.NO_ID), np.full(30_000, 500_000_000)])
    hashes = rng.integers(-(1 << 63), 1 << 63, len(ids))
    dealer = C.Ranges(np.sort(rng.permutation(ids)[:2000]), 100)
    assert set(dealer.heavy.tolist()) == {C.NO_ID, 500_000_000}
    hashes = np.where(np.isin(ids, dealer.heavy), hashes, 0)
    found = dealer.of(ids, hashes)
    assert np.bincount(found).max() < 2500  # of 100,000 rows in 100 ranges
    order = np.lexsort((hashes, ids))
    assert (np.diff(found[order]) >= 0).all()


@pytest.mark.parametrize("docs", [[], [(5, "only")], [(None, None)], [(1, "a"), (2, "b c")]])
def test_small_tables(spark, docs, tmp_path):
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(C.op5_fingerprints(spark, str(tmp_path))) == (brute(docs) if docs else [])


def test_narrow_fingerprints(edge, nothing):
    sampler = C.Sampler()
    assert rows(C.fingerprints(edge)) == sorted(
        ((r["doc_id"], sampler.fingerprint((r["text"] or "").encode()).tobytes().hex()) for r in edge.collect()), key=repr)
    assert C.fingerprints(nothing).count() == 0
