import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose, rows
from wardlog.llm import gru
from wardlog.llm import toxicity as T
from wardlog.llm.columns import spread


def planted(n, seed=0, bad=("grubble", "snorfel"), words=60):
    """Half of the texts hold one of the bad words, or a made-up word that begins like one."""
    rng, out = random.Random(seed), []
    for i in range(n):
        w = prose(seed * 1000 + i, rng.randrange(5, words)).split()
        if i % 2:
            for _ in range(2):
                w.insert(rng.randrange(len(w) + 1), rng.choice(bad) if rng.random() < 0.5 else "xqz" + rng.choice(["ed", "ing", "ova"]))
        out.append((" ".join(w), i % 2))
    return out


@pytest.fixture(scope="module")
def network():
    return gru.train(*map(list, zip(*planted(600))))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    words = gru.Words(np.frombuffer(b"alpha beta gamma delta epsilon zeta eta theta iota", np.uint8), np.array([0, 50]))
    net = gru.Network(words.hash[:4])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    slots = np.full((3, gru.WIDTH), -1)
    slots[0, :9], slots[1, :2], slots[2, :5] = range(9), [3, 3], [8, 1, 1, 0, 2]
    mask, label = (slots >= 0).astype(np.float64), np.array([1.0, 0.0, 1.0])
    ids = net.word_ids(words.hash)

    def loss():
        x = net.inputs(ids, words.runs, words.first)
        g = np.where(slots[:, :, None] >= 0, (x @ net.p["x"] + net.p["xb"])[slots], 0)
        steps, m = [g[:, t] for t in range(gru.WIDTH)], [mask[:, t] for t in range(gru.WIDTH)]
        h = 3 * gru.HIDDEN
        f = net._pass([s[:, :h] for s in steps], m, net.p["uf"], net.p["nf"])
        b = net._pass([s[:, h:] for s in steps[::-1]], m[::-1], net.p["ub"], net.p["nb"])
        z = net._pool(f, b, mask)[3]
        return float(np.mean(np.log1p(np.exp(-z)) * label + np.log1p(np.exp(z)) * (1 - label)))

    for v in net.p.values():
        v += rng.normal(0, 0.2, v.shape) * (v.size < 5000)
    found = net.gradients(ids, words.runs, words.first, words.lengths, slots, mask, label)
    for name, value in net.p.items():
        flat, grad = value.reshape(-1), found[name].reshape(-1)
        places = np.flatnonzero(np.abs(grad) > 0)[:6] if name in ("char", "word") else rng.integers(0, flat.size, 6)
        for i in places:
            old, eps = flat[i], 1e-5
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * eps) - grad[i]) < 2e-4, name


def test_held_out_accuracy(network):
    texts, labels = map(list, zip(*planted(200, seed=1)))
    scores = network.scores(pa.array(texts))
    assert np.mean((scores >= 0.5) == np.array(labels)) > 0.95


def test_unseen_words_are_read_by_their_letters(network):
    texts = [prose(n, 30) + " xqz" + end for n, end in enumerate(["umble", "or", "antic", "ish"])]
    assert (network.scores(pa.array(texts)) > 0.5).mean() >= 0.75


def test_every_window_of_a_long_text_counts(network, monkeypatch):
    filler = " ".join(prose(n, 100) for n in range(60))
    for place in (0, len(filler) // 2, len(filler)):
        text = filler[:place] + " grubble snorfel xqzed grubble " + filler[place:]
        whole = network.scores(pa.array([text, filler]))
        monkeypatch.setattr(gru, "PIECE", 3000)
        cut = network.scores(pa.array([text, filler]))
        monkeypatch.undo()
        assert whole[0] > 0.5 > whole[1] and cut[0] > 0.5 > cut[1]


def test_pieces_of_a_long_text_have_the_windows_of_the_whole(monkeypatch):
    """One grid at any size of piece, with random weights, long words and texts of every length around a window."""
    rng = random.Random(3)
    net = gru.Network(np.empty(0, np.uint64), seed=11)
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 9, 300]))) for _ in range(n)) for n in (1, 8, 9, 15, 16, 17, 24, 25, 100, 1000)]
    texts += ["", " .,; " * 50, "x" * 5000 + " tail", ". " * 3000 + "end"]
    monkeypatch.setattr(gru, "PIECE", 1 << 24)
    whole = net.scores(pa.array(texts))
    for piece in (7, 64, 1000, 1 << 14):
        monkeypatch.setattr(gru, "PIECE", piece)
        assert np.allclose(net.scores(pa.array(texts)), whole, rtol=0, atol=1e-6), piece


def test_scores_window_by_window():
    """Each window run on its own through scalar gates; a text's score is the greatest."""
    net = gru.Network(np.empty(0, np.uint64), seed=5)
    p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def window(x):
        states = []
        for side, u, nb in ((slice(0, 3 * gru.HIDDEN), "uf", "nf"), (slice(3 * gru.HIDDEN, None), "ub", "nb")):
            h, out = np.zeros(gru.HIDDEN), []
            for row in (x if u == "uf" else x[::-1]):
                a, b = (row @ p["x"] + p["xb"])[side], h @ p[u]
                z, r = sig(a[:gru.HIDDEN] + b[:gru.HIDDEN]), sig(a[gru.HIDDEN:2 * gru.HIDDEN] + b[gru.HIDDEN:2 * gru.HIDDEN])
                h = (1 - z) * np.tanh(a[2 * gru.HIDDEN:] + r * (b[2 * gru.HIDDEN:] + p[nb])) + z * h
                out.append(h)
            states.append(out if u == "uf" else out[::-1])
        s = np.concatenate([np.array(states[0]), np.array(states[1])], axis=1)
        e = np.exp(s @ p["v"])
        return (e / e.sum()) @ s @ p["w"] + p["b"][0]

    for n in (1, 7, 16, 20, 57):
        text = prose(n, n)
        data = np.frombuffer(text.lower().encode(), np.uint8)
        words = gru.Words(data, np.array([0, len(data)]))
        x = net.inputs(net.word_ids(words.hash), words.runs, words.first).astype(np.float64)
        starts = range(0, max(1, -(-len(x) // gru.STEP) - gru.WIDTH // gru.STEP + 1) * gru.STEP, gru.STEP)
        want = max(window(x[i:i + gru.WIDTH]) for i in starts)
        assert abs(net.scores(pa.array([text]))[0] - sig(want)) < 1e-4


def both_ways(net, texts):
    """Logits of the windows that are run in full, and of all windows."""
    data, offsets = gru.text_bytes(gru.lowered(pa.array(texts)))
    words = gru.Words(data, offsets)
    layout = gru.Layout(words.per_row)
    code, own = words.different()
    table, index = net.table(*own), layout.columns(code, len(own[0]))
    every = np.flatnonzero(layout.valid)
    whole = np.full(len(layout.valid), -np.inf, np.float32)
    whole[every] = table.logits(index, layout, every)
    return table, table.highest(index, layout), whole, layout


def test_few_windows_run_in_full_and_the_highest_are_those_of_all(network):
    texts = [t for t, _ in planted(60, seed=4, words=200)]
    table, found, whole, layout = both_ways(network, [*texts, "", "one", "grubble", prose(3, 16), prose(5, 17)])
    best = [[int(x[b:b + n].argmax()) for b, n in zip(layout.base, layout.windows)] for x in (found, whole)]
    assert best[0] == best[1] and np.array_equal(*(np.maximum.reduceat(x, layout.base) for x in (found, whole)))
    run = np.isfinite(found)
    assert np.array_equal(found[run], whole[run]) and run.sum() < layout.valid.sum() / 5


@pytest.mark.parametrize("factor", [0.0, 30.0, 1e5])
def test_steep_and_flat_networks_run_every_window_in_full(factor):
    net = gru.Network(np.empty(0, np.uint64), seed=3)
    net.p = {k: v * np.float32(factor) for k, v in net.p.items()}
    _, found, whole, layout = both_ways(net, [prose(n, 5 * n) for n in range(12)])
    assert np.array_equal(np.maximum.reduceat(found, layout.base), np.maximum.reduceat(whole, layout.base))


def test_words_that_begin_alike_keep_their_own_gates():
    texts = ["anbleing ingshre thininin", "anbleat ingsh thinin", "anbleanstthnd x anbleat"]
    net = gru.Network(np.empty(0, np.uint64), seed=11)
    together = net.scores(pa.array(texts * 3))
    assert np.allclose(together, [net.scores(pa.array([t]))[0] for t in texts * 3], rtol=0, atol=1e-7)
    assert len(set(together.tolist())) == 3


def test_words_stay_in_their_texts():
    data = np.frombuffer("ab cdéf!g".encode(), np.uint8)
    w = gru.Words(data, np.array([0, 1, 1, len(data)]))
    assert w.per_row.tolist() == [1, 0, 3] and w.lengths.tolist() == [1, 1, 5, 1]
    run, place = spread(np.array([2, 0, 3]))
    assert run.tolist() == [0, 0, 2, 2, 2] and place.tolist() == [0, 1, 0, 1, 2]


def test_edge_rows(edge, network, nothing):
    scored = T.score_toxicity(edge, network, out="score")
    assert sorted(scored.columns) == sorted(edge.columns)
    found = scored.select("doc_id", "text", "score").collect()
    assert all(0 <= r["score"] <= 1 for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault((r["text"] or "").strip(" \n\t"), set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())  # equal words, equal score; NULL is empty
    assert T.score_toxicity(nothing, network).count() == 0
    assert [r["toxicity"] for r in T.score_toxicity(edge.limit(2), None).collect()] == [0.0, 0.0]


def test_training_sample(spark, edge, monkeypatch):
    df = spark.createDataFrame([(n, f"text {n}") for n in range(200)] + [(500, "x" * 30_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(200)] + [(None, 1), (3, None), (500, 1), (4, 1)], "doc_id long, toxic int")
    texts, known = T.labelled_sample(df, labels)
    ids = [int(t.split()[1]) for t in texts]
    assert sorted(ids) == [n for n in range(200) if zlib.crc32(str(n).encode()) % 5]
    assert all(k == (n % 2 or n == 4) for n, k in zip(ids, known))
    monkeypatch.setattr(T, "PER_CLASS", {0: 5, 1: 7})
    texts, known = T.labelled_sample(df.repartition(9), labels)
    assert known == [0] * 5 + [1] * 7 and (texts, known) == T.labelled_sample(df, labels)
    many = labels.union(spark.range(1000, 9000).selectExpr("id", "1"))  # labelled ids without a document take no places
    assert T.labelled_sample(df, many) == (texts, known)
    empty = labels.filter("doc_id < 0")
    assert T.train_toxicity(df, empty) is None
    held = df.select(T.held_out(F.col("doc_id")).alias("h"), "doc_id").collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in held)


def test_query(spark, sf_small):
    from wardlog.llm import queries

    found = queries.QUERIES["op1_toxicity"](spark, sf_small)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows(found.selectExpr("count(*) AS n", "sum(cast(predicted = cast(score >= 0.5 AS int) AS int)) AS ok")) == [(200, 200)]
