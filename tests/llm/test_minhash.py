import random

import numpy as np
import pytest

from tests.llm.conftest import prose, rows
from wardlog.llm import minhash as M
from wardlog.llm.graph import components


def brute(docs, k, percent=80):
    def shingles(t):
        w = (t or "").encode().lower().split()
        if not w:
            return frozenset()
        n = min(k, len(w))
        return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))

    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if docs[i][0] is None or docs[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if docs[i][0] == docs[j][0] or (both and 100 * both >= percent * len(sets[i] | sets[j])):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if d is not None else None, d is None or d == least[find(i)])
                   for i, (d, _) in enumerate(docs)), key=repr)


def near_copies(seed=5):
    """Groups of copies with edits, a chain in which only neighbours are alike, and unrelated texts."""
    rng, docs = random.Random(seed), []
    for g in range(6):
        base = prose(1000 + g, 120).split()
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
            docs.append(" ".join(w))
    chain = prose(77, 100).split()
    for _ in range(8):
        docs.append(" ".join(chain))
        chain = chain[5:] + [f"new{rng.randrange(9999)}" for _ in range(5)]
    docs += [prose(2000 + n, 60) for n in range(40)] + [docs[3], docs[3], docs[20].upper()]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("k,block,dense", [(2, 2048, 2), (2, 3, 2), (5, 2048, 2), (2, 2048, -1), (2, 4, -1)])
def test_against_brute_force(spark, k, block, dense, monkeypatch):
    """dense = -1: every block is verified as a whole."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "DENSE", dense)
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(M.near_duplicates(df, shingle=k)) == brute(docs, k)


def test_edge_rows(edge):
    assert rows(M.near_duplicates(edge, shingle=2)) == brute([(r["doc_id"], r["text"]) for r in edge.collect()], 2)


@pytest.mark.parametrize("dense", [2, -1])
def test_only_the_full_search_finds_links(spark, monkeypatch, dense):
    monkeypatch.setattr(M, "DENSE", dense)
    monkeypatch.setattr(M, "_to_first", lambda crowded, percent: crowded.selectExpr("node AS a", "node AS b").limit(0))
    docs = near_copies(6)
    assert rows(M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=2)) == brute(docs, 2)


def test_one_document_of_each_group_stays(edge):
    kept = M.without_near_duplicates(edge, shingle=2)
    assert kept.columns == edge.columns
    expected = brute([(r["doc_id"], r["text"]) for r in edge.collect()], 2)
    assert sorted(map(repr, [r["doc_id"] for r in kept.collect()])) == sorted(
        [repr(None)] * 2 + [repr(d) for d in {r[0] for r in expected if r[3] and r[0] is not None}])


def test_empty(nothing):
    assert M.near_duplicates(nothing).count() == 0 and M.without_near_duplicates(nothing).count() == 0


def test_signature_estimates_likeness():
    hasher, rng = M.Circulant(240), np.random.default_rng(1)
    for share in (0.3, 0.8):
        both = rng.integers(0, 1 << 63, 600).astype(np.uint64)
        n = round(600 * (1 - share) / (1 + share) * (1 + share) / (2 * share))
        x, y = (np.concatenate([both, rng.integers(0, 1 << 63, n).astype(np.uint64)]) for _ in range(2))
        exact = 600 / (600 + 2 * n)
        agreed = np.mean([(M.Circulant(240, seed=s).signature(x) == M.Circulant(240, seed=s).signature(y)).mean() for s in range(3)])
        assert abs(agreed - exact) < 0.06
    assert sorted(hasher.place(np.arange(1 << 12, dtype=np.uint64)).tolist()) != list(range(1 << 12))
    small = M.Circulant(8, bits=10)
    assert sorted(small.place(np.arange(1 << 10, dtype=np.uint64)).tolist()) == list(range(1 << 10))  # a permutation


def test_blocks_of_shingles_agree():
    s = M.shingle_set(prose(3, 500).encode(), 2)
    hasher = M.Circulant(48)
    assert (hasher.signature(s) == hasher.signature(s, block=7)).all()


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(5, 5)], [], [(1, 2), (2, 1), (1, 2), (9, 8), (8, 7), (3, 4)],
])
def test_components(spark, edges):
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent


@pytest.mark.parametrize("dense", [2, -1])
def test_an_id_with_several_texts(spark, monkeypatch, dense):
    """An id joins the groups of its texts, also for its rows without words; texts of an id are not compared crosswise."""
    monkeypatch.setattr(M, "DENSE", dense)
    a, b = prose(1, 80), prose(2, 90)
    docs = [(3, a), (5, a), (5, b), (9, b + " more"), (9, ""), (5, None), (7, prose(3, 30)), (7, " "), (2, ""), (2, ""), (None, a)]
    assert [r[2] for r in brute(docs, 2) if r[0] in (3, 5, 9)] == [3] * 6
    docs += [(400 + n % 5, t) for n, (_, t) in enumerate(near_copies(8))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(M.near_duplicates(df, shingle=2)) == brute(docs, 2)


def test_a_row_repeated_beside_a_near_copy(spark, monkeypatch):
    """One set and one pair for thousands of equal rows."""
    stored, real = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda df: stored.append(real(df)) or stored[-1])
    text, n = prose(4, 80), 3000
    df = spark.createDataFrame([(4, text)] * n + [(6, text + " more"), (8, prose(9, 80))], "doc_id long, text string")
    found = M.near_duplicates(df, shingle=2)
    assert found.groupBy("id", "component_id", "kept").count().sort("id").collect() == [(4, 4, True, n), (6, 4, False, 1), (8, 8, True, 1)]
    assert [t.count() for t in stored if t.columns == ["node", "set"]] == [2]
    assert max(t.count() for t in stored[1:]) < n
