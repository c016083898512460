import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SCHEMA, document, prose
from wardlog.llm import alignment as A

PLACES = A.default_tokenizers()


def brute(texts):
    """Every document encoded whole; ends, groups and links by plain loops."""
    byte, piece = A.tokenizers_at(*PLACES)
    docs = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids = (byte.model.encode(" " + (text or ""), add_special_tokens=False).ids, piece.model.encode(text or "", num_threads=1))
        spelled = [[side.pieces[i].as_py() for i in x] for side, x in zip((byte, piece), ids)]
        if not text or any(b"".join(s) != whole for s in spelled):
            docs.append(None)
            continue
        ends = [[sum(map(len, s[:n + 1])) for n in range(len(s))] for s in spelled]
        groups, start = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            stop = [e.index(end) + 1 for e in ends]
            groups.append(tuple(x[i:j] for x, i, j in zip(ids, start, stop)))
            start = stop
        docs.append((len(ids[0]), len(ids[1]), groups, Counter((a, b) for x, y in groups for a in x for b in y)))
    held = Counter(p for d in docs if d for p in d[3])
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in d[2])
        out.append((d[0], d[1], len(d[2]), sum(d[3].values()), sum(n for p, n in d[3].items() if held[p] == most[p[0]]),
                    sum(n * held[p] for p, n in d[3].items()), hashlib.sha256(shown.encode()).hexdigest()))
    return out


def got(df, key="doc_id"):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(((r[key], *(r[n] for n in names)) for r in A.alignment(df, key).collect()), key=repr)


STRANGE = ["a  b   c", "tail ", "  lead", "\n\nnew\nline\n \n x", "\ttab\t\t", "don't they'll I'm 12345 3.14", "<|endoftext|> <s> <0x41> </s><unk>",
           "▁mark", "no mark", "日本語 テキスト　全角 空白", "nbsp   x  y", "  em  ", "Ünïcödé straße déjà vu", "😀😀 👩‍👩‍👧 x", "\x00 nul \x00",
           "\r\n dos\r\n", "\x1c\x1d a \x85 b", " ", "  ", "\n", "x" * 3000, "한국어 문장 입니다", "ſ K Å   ogham", "é combining ́"]


def test_strange_texts_as_by_brute_force(spark):
    texts = [*STRANGE, None, "", *STRANGE[:5], *(prose(n, 40) for n in range(20))]
    df = spark.createDataFrame([document(n, t) for n, t in enumerate(texts)], SCHEMA).repartition(3)
    assert got(df) == sorted(((n, *r) for n, r in enumerate(brute(texts))), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \n\t' 　▁aé日.,1"), max_size=40), min_size=1, max_size=4))
def test_chunks_never_change_a_text(texts):
    stats, _, _ = A.align_block(pa.array(texts, pa.string()), A.tokenizers_at(*PLACES))
    want = brute(texts)
    assert [tuple(int(stats[n][i]) for n in A.STATS) for i in range(len(texts))] == [w[:4] for w in want]
    assert [hashlib.sha256(g.encode()).hexdigest() if g is not None else "" for g in stats["groups"]] == [w[6] for w in want]


def test_edge_rows_and_small_blocks(spark, edge, nothing, monkeypatch):
    rows = edge.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows]))), key=repr)
    assert got(edge) == want
    monkeypatch.setattr(A, "BLOCK_BYTES", 200)
    assert got(edge) == want
    assert A.alignment(nothing).count() == 0 and "count_sum" in A.alignment(nothing).columns
    renamed = edge.withColumnRenamed("doc_id", "n_links")
    assert A.alignment(renamed.select(A.F.col("n_links").alias("key of row"), "text"), "key of row").count() == len(rows)


def test_a_long_text_without_spaces(spark):
    """Half a megabyte as one chunk: the counts are those of the whole text."""
    text = ("abcdefgh日本" * 40_000)[:500_000]
    [row] = A.alignment(spark.createDataFrame([document(1, text)], SCHEMA)).collect()
    byte, piece = A.tokenizers_at(*PLACES)
    assert row["n_a"] == len(byte.model.encode(" " + text, add_special_tokens=False).ids)
    assert row["n_b"] == len(piece.model.encode(text, num_threads=1)) and row["n_links"] >= row["n_groups"]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_given_documents_as_by_brute_force(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    assert got(df) == sorted(((r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows]))), key=repr)


def test_chunks_met_before_are_not_aligned_again(monkeypatch):
    """Blocks that share words, odd texts and a chunk too long to be kept: as by brute force, each kept chunk once."""
    asked, rows = [], A.chunk_rows

    def counted(chunks, sides):
        asked.extend(chunks.to_pylist())
        return rows(chunks, sides)

    blocks = [[prose(n, 80), STRANGE[n], "y" * 100 + " end"] for n in range(8)] + [STRANGE, [prose(n, 80) for n in range(8)]]
    for kept in (1 << 26, 4000, 0):
        monkeypatch.setattr(A, "KNOWN_BYTES", kept)
        known = A.Known(A.tokenizers_at(*PLACES))
        asked.clear()
        for texts in blocks:
            with monkeypatch.context() as patch:
                patch.setattr(A, "chunk_rows", counted)
                stats, pairs, (ptr, place, links) = A.align_block(pa.array(texts), known.sides, known)
            want = brute(texts)
            assert [tuple(int(stats[n][i]) for n in A.STATS) for i in range(len(texts))] == [w[:4] for w in want]
            assert [hashlib.sha256(g.encode()).hexdigest() if g is not None else "" for g in stats["groups"]] == [w[6] for w in want]
            alone = [A.align_block(pa.array([t]), known.sides) for t in texts]
            assert [dict(zip(pairs.take(pa.array(place[i:j])).to_pylist(), links[i:j].tolist())) for i, j in zip(ptr, ptr[1:])] == [
                dict(zip(p.take(pa.array(at)).to_pylist(), n.tolist())) for _, p, (_, at, n) in alone]
        if kept == 1 << 26:
            short = [c for c in asked if len(c.encode()) <= A.KNOWN_CHUNK]
            assert len(short) == len(set(short)) < len(asked) and sorted(known.names.to_pylist()) == sorted(short)
            assert known.rows.num_rows == len(short)
