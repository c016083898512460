import hashlib
import re
from collections import Counter

import pytest

from tests.llm.conftest import document, prose, rows
from wardlog.llm import mixing as M


def targets(sizes):
    """Water filling by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def brute(docs):
    """(id, source, size) -> the copies of its rows, most first; with the source's size and target."""
    counts = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in docs]
    numbered, seen = [], Counter()
    for u in counts:
        numbered.append((u, seen[u]))
        seen[u] += 1
    sizes = Counter()
    for u in counts:
        sizes[u[1]] += u[2]
    goal = targets(sizes)
    place = {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}

    def order(row):
        (d, _, n), number = row
        chunk = number // M.CHUNK
        name = f"mix{chunk or ''}" + ("/" if d is None else f":{d}")
        return hashlib.md5(name.encode()).hexdigest(), n, chunk, number

    copies, done = [], Counter()
    for row in sorted(numbered, key=order):
        (_, s, n), _ = row
        if n:
            done[s] += n
            for k in range(3):
                copies.append(((k * sizes[s] + done[s]) / goal[s], place[s], order(row), k, row))
    budget, taken, open = sum(sizes.values()), Counter(), True
    for *_, row in sorted(copies, key=lambda c: c[:4]):
        budget -= row[0][2]
        open = open and budget >= 0
        taken[row] += open
    out = {}
    for u in seen:
        out[u] = (sorted((taken[u, n] for n in range(seen[u])), reverse=True), sizes[u[1]], pytest.approx(goal[u[1]]))
    return out


def got(df):
    out = {}
    for r in M.mix_sources(df).collect():
        out.setdefault((r["id"], r["source"], r["size"]), ([], r["source_size"], r["target"]))[0].append(r["copies"])
    return {u: (sorted(c, reverse=True), *rest) for u, (c, *rest) in out.items()}


@pytest.mark.parametrize("ranges", [2_000, 4])
def test_against_brute_force(edge, corpus, ranges, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ROWS", ranges)
    for df in (edge, corpus, corpus.unionByName(edge)):
        assert got(df) == brute([(r["doc_id"], r["text"], r["source"]) for r in df.collect()])


def test_targets_are_met_and_stop_at_three_passes(spark):
    docs = [document(n, prose(n, 30), "big" if n % 4 else "aa") for n in range(400)] + [document(1000 + n, prose(n, 10), "ab") for n in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, size string, score string, `key` string, id string")
    mix = M.mix_sources(df).collect()
    taken, goal = Counter(), {r["source"]: r["target"] for r in mix}
    for r in mix:
        assert r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    assert goal["ab"] == 90 == taken["ab"]
    assert all(abs(taken[s] - goal[s]) <= 30 for s in goal)


def times(df, mixed):
    """Copies of the rows of each unit, most first, as the mixed documents have them."""
    def key(r):
        return r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))

    taken = Counter(tuple(r) for r in mixed.collect())
    per = {}
    for row, n in Counter(map(tuple, df.collect())).items():
        r = dict(zip(df.columns, row))
        per.setdefault(key(r), [0, 0])
        per[key(r)][0] += taken.pop(row, 0)
        per[key(r)][1] += n
    assert not taken
    return per


def test_documents_of_the_mix(edge):
    mixed = M.mixed_documents(edge)
    assert mixed.columns == edge.columns
    want = {u: [sum(c), len(c)] for u, (c, *_) in got(edge).items()}
    assert times(edge, mixed) == want


@pytest.mark.parametrize("id", [None, 7])
def test_rows_that_share_an_id_or_have_none(spark, id):
    """A thousand equal rows in each of two sources, and five hundred among others: every source meets its target."""
    docs = [(id, "ten words " * 5, s, n) for s in "AB" for n in range(1000)]
    docs += [(10 + n, "ten words " * 5, "C", n) for n in range(300)] + [(id, "ten words " * 5, "C", n) for n in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, `mix id` int").repartition(5)
    taken, goal = Counter(), {}
    for r in M.mix_sources(df).collect():
        goal[r["source"]] = r["target"]
        taken[r["source"]] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - goal[s]) <= 10 for s in "ABC")
    assert got(df) == brute([(r["doc_id"], r["text"], r["source"]) for r in df.collect()])
    mixed = M.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter(r["source"] for r in mixed.collect()) == {s: n // 10 for s, n in taken.items()}
    assert max(Counter(tuple(r) for r in mixed.collect()).values()) <= 3
    per_unit = times(df, mixed)
    assert per_unit == {u: [sum(c), len(c)] for u, (c, *_) in got(df).items()}


def test_empty_and_reruns(nothing, corpus):
    assert M.mix_sources(nothing).count() == 0 and M.mixed_documents(nothing).count() == 0
    assert rows(M.mix_sources(corpus)) == rows(M.mix_sources(corpus.repartition(7)))


def test_blank_texts_only(spark):
    df = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["copies"] for r in M.mix_sources(df).collect()] == [0, 0]
