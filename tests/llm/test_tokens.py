import math
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from tests.llm.conftest import prose, rows
from wardlog.llm import lattice, sampling, tokencount

PATH = tokencount.default_model()
VOCABULARY = lattice.Vocabulary.read(PATH)
MACHINE = lattice.automaton(VOCABULARY)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
# the same vocabulary in a library with 64-bit scores
EXACT = Tokenizer(models.Unigram([(MODEL.id_to_piece(i), MODEL.get_score(i)) for i in range(MODEL.get_piece_size())], 0, True))

HARD = ["", " ", "  a  b", "日本語のテキスト😀 x", "▁a", "\n\n", "a\tb", "a" * 300, "http://www.example.com/a-b_c?d=1", "مرحبا بالعالم",
        "\x00\x01 x", "ñ é ö", "     ", "👍🏽👍", "x" * 70 + " " + "y" * 70, "▁▁"]


def expected(text):
    return len(EXACT.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


def counts(texts):
    return tokencount.count_tokens(pa.array(texts, pa.string()), MACHINE)[0].tolist()


def test_counts_of_hard_texts():
    texts = HARD + [prose(n, 300) for n in range(20)]
    assert counts(texts) == [expected(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeinrst hllo.\n\té日😀▁0_-"), max_size=40), min_size=1, max_size=5))
def test_counts_of_random_texts(texts):
    assert counts(texts) == [expected(t) for t in texts]


def test_best_score_against_the_model_read_as_unigram():
    raw = open(PATH, "rb").read()
    at = raw.rindex(b"tok_v0") + len(b"tok_v0")
    assert raw[at:at + 2] == b"\x18\x02"  # model type in the trainer's settings
    unigram = sentencepiece.SentencePieceProcessor(model_proto=raw[:at + 1] + b"\x01" + raw[at + 2:])
    texts = [prose(n, 12) for n in range(40)]  # short: that library adds in 32 bits
    best = [sum(MODEL.get_score(i) for i in unigram.nbest_encode(t, nbest_size=2)[0]) for t in texts]
    assert tokencount.count_tokens(pa.array(texts), MACHINE)[1].tolist() == best


def test_blocks_do_not_matter(monkeypatch):
    texts = HARD + [None, prose(1, 400)]
    once = counts(texts)
    monkeypatch.setattr(lattice.blocks_of, "__defaults__", (7,))
    assert counts(texts) == once


def without_spaces(alphabet, n):
    rng = np.random.default_rng(n)
    return "".join(np.array(list(alphabet))[rng.integers(0, len(alphabet), n)])


UNSPACED = {
    "letters": "abcdefghijklmnopqrstuvwxyz", "one letter": "a", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ideographs": "的一是在不了有和人这中大为上个国我以要他时来用们", "mixed": "ab的é😀\n-=1",
}


@pytest.mark.parametrize("kind", UNSPACED)
def test_a_megabyte_without_spaces(kind):
    text = without_spaces(UNSPACED[kind], 1_000_000 // len(UNSPACED[kind][-1].encode()))
    began = time.process_time()
    found = counts([text])
    assert time.process_time() - began < 20  # a second or two; a loop of numpy calls per byte takes 45
    assert found == [expected(text)]


@pytest.mark.parametrize("size", [1, 5, 24, 60])
def test_long_chunks_count_like_others(monkeypatch, size):
    texts = HARD + [None, prose(1, 100)] + [without_spaces(x, 2000) for x in UNSPACED.values()]
    monkeypatch.setattr(lattice, "LONG", size)
    monkeypatch.setattr(lattice, "LISTED", 17)
    assert counts(texts) == [expected(t or "") for t in texts]


def test_bytes_that_are_no_characters_are_counted():
    odd = pa.Array.from_buffers(pa.string(), 3, [None, pa.py_buffer(np.array([0, 3, 3, 8], np.int32)), pa.py_buffer(b"a\x80b\xe2\x82 \xffc")])
    assert [n > 0 for n in tokencount.count_tokens(odd, MACHINE)[0]] == [True, False, True]


def test_count_frames(edge, nothing):
    found = tokencount.token_counts(edge, PATH, tokens="size")
    assert sorted(found.columns) == sorted(edge.columns) and dict(found.dtypes)["score"] == "double"
    assert rows(found.select("text", "size")) == sorted(((r["text"], expected(r["text"] or "")) for r in edge.collect()), key=repr)
    assert tokencount.token_counts(nothing, PATH).count() == 0


# --- sampling ---------------------------------------------------------------------------


def block(text):
    _, _, data, offsets = next(lattice.blocks_of(pa.array([text])))
    return data, offsets


def all_segmentations(text, theta):
    pieces = dict(zip(VOCABULARY.pieces, zip(VOCABULARY.ids, VOCABULARY.scores)))

    def cut(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in pieces:
                for ids, score in cut(s[n:]):
                    yield (pieces[s[:n]][0], *ids), score + pieces[s[:n]][1]

    weights = {ids: theta * score for ids, score in cut(text)}
    total = math.log(sum(map(math.exp, weights.values())))
    return {ids: math.exp(w - total) for ids, w in weights.items()}


def test_draws_without_replacement_have_the_right_chances():
    theta, n, k = 1 / 8000, 20_000, 3
    data, _ = block("the cat")
    chance = all_segmentations(data.tobytes(), theta)
    keys = sampling._hash(np.arange(n))
    found = sampling.Block(MACHINE, k, theta, np.tile(data, n), np.arange(n + 1) * len(data), keys).samples()
    drawn, weighed = [Counter() for _ in range(k)], Counter()
    for samples in found:
        ids = [tuple(s[0].tolist()) for s in samples]
        assert len(set(ids)) == k
        for r, (own, s) in enumerate(zip(ids, samples)):
            drawn[r][own] += 1
            assert abs(s[1] - math.log(chance[own])) < 1e-7
            weighed[own] += chance[own] / math.exp(s[2])  # unbiased: each sample over its inclusion probability
    for own in sorted(chance, key=chance.get)[-6:]:
        first = chance[own]
        second = sum(chance[b] * first / (1 - chance[b]) for b in chance if b != own)
        for share, exact in ((drawn[0][own], first), (drawn[1][own], second)):
            assert abs(share / n - exact) < 4.5 * math.sqrt(exact * (1 - exact) / n)
        assert abs(weighed[own] / n - first) < 0.02


def test_all_segmentations_are_drawn_when_there_are_few():
    data, offsets = block("at")
    chance = all_segmentations(data.tobytes(), 1 / 8000)
    (samples,) = sampling.Block(MACHINE, 50, 1 / 8000, data, offsets, sampling._hash(np.arange(1))).samples()
    assert {tuple(s[0].tolist()) for s in samples} == {ids for ids, p in chance.items() if p > 0}
    assert len(samples) == len({tuple(s[0].tolist()) for s in samples}) and all(s[2] == 0.0 for s in samples)


def test_samples_of_a_long_text_are_distinct_and_exact():
    theta, text = sampling.THETA, prose(5, 400) + "\n😀" + prose(6, 100)
    data, offsets = block(text)
    (samples,) = sampling.Block(MACHINE, 6, theta, data, offsets, sampling._hash(np.arange(1))).samples()
    assert len({tuple(s[0].tolist()) for s in samples}) == 6
    scores = dict(zip(VOCABULARY.ids, VOCABULARY.scores))
    weight = [theta * sum(scores.get(int(i), 0) for i in s[0]) for s in samples]
    gaps = [s[1] - w for s, w in zip(samples, weight)]  # the same constant for all
    assert max(gaps) - min(gaps) < 1e-6
    assert all(MODEL.decode(s[0].tolist()) == text for s in samples)


@pytest.mark.parametrize("size", [3, 24, 60])
def test_long_chunks_are_drawn_like_others(monkeypatch, size):
    texts = [t for t in HARD if t] + [prose(3, 60)] + [without_spaces(x, 200) for x in UNSPACED.values()]

    def drawn():
        out = []
        for i, j, data, offsets in lattice.blocks_of(pa.array(texts)):
            out += sampling.Block(MACHINE, 3, 1 / 8000, data, offsets, sampling._hash(np.arange(i, j))).samples()
        return [[(s[0].tolist(), round(s[1], 5), round(s[2], 4)) for s in samples] for samples in out]

    once = drawn()
    for module in (lattice, sampling):
        monkeypatch.setattr(module, "LONG", size)
    monkeypatch.setattr(lattice, "LISTED", 17)
    assert drawn() == once


@pytest.mark.parametrize("kind", UNSPACED)
def test_samples_of_a_megabyte_without_spaces(kind):
    text = without_spaces(UNSPACED[kind], 1_000_000 // len(UNSPACED[kind][-1].encode()))
    data, offsets = block(text)
    began = time.process_time()
    (samples,) = sampling.Block(MACHINE, 2, sampling.THETA, data, offsets, sampling._hash(np.arange(1))).samples()
    assert time.process_time() - began < 40  # some seconds
    assert len({tuple(s[0].tolist()) for s in samples}) == 2
    assert all(MODEL.decode(s[0].tolist()) == text for s in samples)


def test_encode_and_decode_frames(spark, edge, nothing):
    found = sampling.sample_encodings(edge, PATH, samples=3)
    decoded = sampling.decode_pieces(found, PATH, out="text")
    texts = Counter((r["doc_id"], (r["text"] or "").replace("▁", " ")) for r in edge.collect())
    assert Counter((r["key"], r["text"]) for r in decoded.filter("sample = 0").collect()) == texts
    assert {(r["key"], r["text"]) for r in decoded.collect()} == set(texts)
    moved = sampling.sample_encodings(edge.repartition(5), PATH, samples=3)
    assert rows(found) == rows(moved)
    assert sampling.sample_encodings(nothing, PATH).count() == 0
    odd = spark.createDataFrame([([1, 259, 2],), ([],), (None,), ([3 + 0xC3, 3 + 0x28],), ([3 + 0xE2, 3 + 0x82, 3 + 0xAC],)], "ids array<int>")
    assert [r["decoded"] for r in sampling.decode_pieces(odd.coalesce(1), PATH).collect()] == [" ", "", None, "�(", "€"]


def test_queries(spark, sf_small):
    from wardlog.llm import queries

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    found = queries.QUERIES["op4_token_counts"](spark, sf_small).collect()
    assert {r["doc_id"]: (r["n_chars"], r["n_tokens"]) for r in found} == {d: (len(t), expected(t)) for d, t in texts.items()}
    same = queries.QUERIES["op10_sentencepiece"](spark, sf_small).join(
        spark.read.parquet(f"{sf_small}/documents.parquet"), "doc_id").selectExpr("decoded_sha256 = sha2(text, 256) AS same", "sample")
    assert Counter(map(tuple, same.collect())) == {(True, 0): 200, (True, 1): 200}


def test_pieces_that_hold_inner_spaces_are_handled():
    own = lattice.Vocabulary((b" a", b"b", b" ", b"b a", b"a"), (300, 301, 302, 303, 304), (-1.0, -1.0, -2.0, -0.5, -3.0), tuple(range(256)))
    machine = lattice.Automaton(own)
    assert machine.beside[ord("b") << 8 | ord(" ")]  # no cut there
    assert tokencount.count_tokens(pa.array(["b a", "a b"]), machine)[0].tolist() == [2, 3]


@pytest.mark.parametrize("text", ["ab", "the the"])
def test_lattice_edges_are_all_matches(text):
    data, offsets = block(text)
    chunks = lattice.Chunks(data, offsets, MACHINE)
    lat = lattice.Lattice(data, chunks, MACHINE)
    log_p, p, running = lat.sums(1 / 5000)
    for node in np.unique(lat.run):
        assert abs(p[lat.run == node].sum() - 1) < 1e-9
    kinds = {data[s:s + n].tobytes() for s, n in zip(chunks.kind_starts, chunks.kind_lengths)}
    assert len(lat.piece) == sum(kind[i:j] in VOCABULARY.pieces for kind in kinds for i in range(len(kind)) for j in range(i + 1, len(kind) + 1))
