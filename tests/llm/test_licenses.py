import random

import numpy as np
import pytest

from tests.llm.conftest import prose, rows
from wardlog.llm import licenses as L
from wardlog.llm.gru import Words

INDEX = L.Index(L.TEMPLATES)


def hashes(text):
    data = L._LOWER[np.frombuffer(text.encode(), np.uint8)]
    return Words(data, np.array([0, len(data)]), with_runs=False).hash


def full_alignment(a, b):
    """Score of the best local alignment, all cells."""
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if a[i] == b[j] else -1), h[i + 1, j] - 1, h[i, j + 1] - 1)
    return int(h.max())


def score_of(pairs):
    """Score of an alignment given by its equal words."""
    total = len(pairs)
    for (i, j), (k, m) in zip(pairs, pairs[1:]):
        total -= max(k - i, m - j) - 1
    return total


def edited(rng, words):
    words = list(words)
    for _ in range(len(words) // 15):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[at] = "zz"
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, "qq")
    return words


def test_edited_templates_are_found_with_their_best_alignment():
    rng = random.Random(3)
    for n in range(30):
        name = rng.choice(sorted(L.TEMPLATES))
        words, filler, at = edited(rng, L.TEMPLATES[name].split()), prose(n, 200).split(), rng.randrange(200)
        text = hashes(" ".join([*filler[:at], *words, *filler[at:]]))
        g = L.grams(text)
        kept = L.winnow(g, np.zeros(len(g), np.int64))
        hits = [(int(kept[i]), owner, place) for i, owner, place in INDEX.postings(g[kept])]
        own = INDEX.names.index(name)
        found = [m for m in L.matches(INDEX, text, hits) if m[0] == own]
        assert found, name
        template = INDEX.words[own]
        pairs = L.align(template, text, -len(template), len(text))
        assert score_of(pairs) == full_alignment(template, text)
        assert len(pairs) == found[0][1] and pairs[0][1] == found[0][2]


def test_winnowing_keeps_one_hash_of_every_window():
    rng = np.random.default_rng(5)
    row = np.sort(rng.integers(0, 12, 200))
    values = rng.integers(0, 20, 200).astype(np.uint64)
    kept = set(L.winnow(values, row).tolist())
    expected = set()
    for r in set(row.tolist()):
        own = np.flatnonzero(row == r)
        for s in range(max(1, len(own) - L.WINDOW + 1)):
            window = own[s:s + L.WINDOW]
            expected.add(int(window[np.flatnonzero(values[window] == values[window].min())[-1]]))
    assert kept == expected


def test_spans_and_edge_rows(spark, edge, nothing):
    line = "Released under the MIT License"
    docs = [(1, f"é😀 {prose(1)} {line}. {prose(2)}\n{line.upper()}!"), (2, line), (3, "released under the"), (2, line), (None, L.TEMPLATES["isc text"])]
    df = spark.createDataFrame([(*d, "clash", "clash") for d in docs], "doc_id long, text string, template string, begin string")
    found = L.scan_licenses(df)
    texts = {d: t for d, t in docs}
    assert sorted((r["id"], texts[r["id"]][r["begin"]:r["end"]]) for r in found.collect() if r["id"] is not None) == [
        (1, line.upper()), (1, line), (2, line), (2, line)]
    assert [(r["template"], r["coverage"]) for r in found.filter("id IS NULL").collect()] == [("isc text", 1.0)]
    assert L.scan_licenses(edge).count() == 0 and L.scan_licenses(nothing).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_repeats_in_a_long_text(spark, block, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    text = " ".join(f"{prose(n, 9)} Licensed under CC BY-NC 4.0." for n in range(200)) + " Released under the MIT License" * 20
    found = L.scan_licenses(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"))
    assert rows(found.groupBy("id", "template").count()) == [
        (d, t, n) for d in (1, 2) for t, n in (("cc-by-nc-4.0 reference", 200), ("mit reference", 20))]


def test_query_finds_every_line(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    found = L.op8_license_scan(spark, sf_small).collect()
    for name in ("apache-2.0 reference", "mit reference", "gpl-3.0 reference", "cc-by-nc-4.0 reference"):
        line = L.TEMPLATES[name]
        expected = {(d, t.index(line)) for d, t in texts.items() if line in t}
        assert expected <= {(r["doc_id"], r["begin"]) for r in found if r["template"] == name and r["coverage"] == 1}


def test_short_templates_in_a_long_text(spark):
    """Templates of one to four words, at every place of the window, one after the other, and not in parts."""
    templates = {"four": "Some rights are reserved", "three": "All rights reserved", "two": "No warranty", "one": "Copyleft"}
    line = "ALL rights reserved."
    text = " ".join([*(f"{prose(n, 7 + n % 4)} {line}" for n in range(60)), line * 5, prose(61, 3000), "all rights were reserved",
                     "some rights truly are reserved", prose(62), "no warranty " * 4, "copyleft " * 6])
    docs = [(1, text), (2, "all rights reserved"), (3, "rights reserved"), (4, "all"), (5, "rights reserved all rights"), (6, "copyleft")]
    found = L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), templates).collect()
    assert all(r["coverage"] == 1 and r["matched_words"] == len(templates[r["template"]].split()) for r in found)
    assert {r["begin"] for r in found if (r["id"], r["template"]) == (1, "three")} == {
        n for n in range(len(text)) if text.startswith("ALL rights reserved", n)}
    counts = {}
    for r in found:
        counts[r["id"], r["template"]] = counts.get((r["id"], r["template"]), 0) + 1
    assert counts == {(1, "four"): 1, (1, "three"): 65, (1, "two"): 4, (1, "one"): 6, (2, "three"): 1, (6, "one"): 1}


def test_query_finds_every_reserved_line(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    expected = {(d, t.index("All rights reserved")) for d, t in texts.items() if t and "All rights reserved." in t}
    found = {(r["doc_id"], r["begin"]) for r in L.op8_license_scan(spark, sf_small).collect() if r["template"] == "all-rights-reserved notice"}
    assert expected and expected <= found


def test_a_long_text_of_many_matches(spark):
    """Spans are counted once per block: three megabytes of notices between accents stay a matter of seconds."""
    import time

    line = "é Licensed under the Apache License, Version 2.0 (the \"License\"); ñ\n"
    text = line * 45_000
    start = time.time()
    found = L.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(found) >= 45_000 // 2 and time.time() - start < 120
    for r in found[:50] + found[-50:]:
        assert "Apache License" in text[r["begin"]:r["end"]]
