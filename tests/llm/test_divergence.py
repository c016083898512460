import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, document, prose, rows
from wardlog.llm import divergence as D


def brute(docs, min_docs, top=10):
    """docs: (text, lang, source) rows; all sums by plain Python integers."""
    counts, held, groups = defaultdict(Counter), Counter(), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(words)
        held.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (k, w), n in held.items() if k == lang and n >= min_docs]
        own = {s: Counter({w: counts[lang, s][w] for w in kept}) for k, s in groups if k == lang}
        whole = Counter({w: sum(c[w] for c in own.values()) for w in kept})

        def shares(count):
            n = sum(count.values())
            return {w: 1 + 10**9 * (count[w] + 2) // (n + 2 * len(kept)) for w in kept}

        q, p = shares(whole), {s: shares(c) for s, c in own.items()}
        for s in own:
            pairs = [(sum((p[s][w] - p[o][w]) ** 2 // (p[s][w] + p[o][w]) for w in kept), o) for o in own if o != s]
            terms = [((p[s][w] - q[w]) ** 2 // (p[s][w] + q[w]), w) for w in kept if own[s][w] > 0 and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out, key=repr)


def got(df, **options):
    return rows(D.divergence_audit(df, **options).select("lang", "source", "part", "item", "value", "rank"))


@pytest.mark.parametrize("groups,columns,share", [(1, 1, 1), (3, 40, 0.5), (20, 300, 0.1), (33, 17, 0.02), (70, 200, 0.01), (9, 500, 0.0)])
def test_quadtree_sums_are_exact(groups, columns, share):
    rng = np.random.default_rng(groups)
    row, column = np.nonzero(rng.random((groups, columns)) < share)
    count = rng.integers(1, 10**rng.integers(1, 12), len(row))
    whole = np.zeros((groups, columns), np.int64)
    whole[row, column] = count
    denominator = whole.sum(axis=1) + 2 * columns
    p = [[1 + 10**9 * (int(n) + 2) // int(d) for n in line] for line, d in zip(whole, denominator)]
    want = [[sum((x - y) ** 2 // (x + y) for x, y in zip(a, b)) for b in p] for a in p]
    assert np.triu(D.compare_groups(row, column, count, denominator, columns), 1).tolist() == np.triu(np.array(want), 1).tolist()


def test_most_quadrants_are_never_descended():
    """Two groups of sources with words of their own: the tree has few leaves, whatever the number of columns."""
    row, column = np.nonzero(np.kron(np.eye(2), np.ones((32, 64))))
    tree = D.Quadtree(row, column, 64, 128)
    assert len(tree.levels[0][1]) == 2 * 4 * 8 and len(tree.levels[1][1]) == 2 * 2 * 4


def test_small_tiles_and_blocks_as_by_brute_force(spark):
    docs = [document(n, prose(n % 60, 30, 90) + (" Éa dÉa ÉÀ" if n % 3 else ""), f"s{n % 11}" if n % 13 else None) for n in range(150)]
    docs += [document(200 + n, "hot common words " * 5, "s0") for n in range(80)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    want = brute([(d[1], d[2], d[3]) for d in docs], 10)
    assert got(df) == want
    assert got(df, tile=3, block_entries=50) == want


def test_edge_rows(spark, edge, nothing):
    plain = [tuple(r) for r in edge.select("text", "lang", "source").collect()]
    for least in (1, 2, 10):
        assert got(edge, min_docs=least) == brute(plain, least)
    assert D.divergence_audit(nothing).count() == 0
    two = spark.createDataFrame([document(1, None, "a"), document(2, "", "b"), document(2, "", "b")], SCHEMA)
    assert got(two) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_a_long_text(spark):
    text = " ".join(prose(n, 300) for n in range(200)) + " " + "ab" * 200_000
    docs = [document(1, text, "a"), document(2, prose(3, 500), "b")]
    assert got(spark.createDataFrame(docs, SCHEMA), min_docs=1) == brute([(d[1], d[2], d[3]) for d in docs], 1)
