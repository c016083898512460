"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked token ids.

Side A is a byte-level BPE over a space and the text, side B a SentencePiece model over the text (it adds the space). Byte
places where tokens of both end cut a document into groups; every A token of a group is linked with every B token of it.

A block of documents is one set of Arrow columns. Both tokenizers always end a token where a space or line break follows a
character that is surely no white space, so documents are cut there, the different chunks of a block are dictionary-encoded
and each is encoded once; rows of short chunks are kept for the worker's next blocks. Token lists are flattened with their parent indices; segmented running sums of byte lengths give
the end of every token, and Acero hash joins on (parent, end) the common ends. Table.group_by reduces pairs to one row a
block, with the number of its documents; Spark merges those partial counts, joins them back to the pairs of each block,
and hands every block its counts, so no table of counts is held whole anywhere.

Defined results: texts that are NULL or empty, or which a side does not give back byte by byte (U+2581), have no tokens: zeros
and the digest ''. Special tokens' strings are plain text. Each row counts as one document, repeated ids and NULL ids
too. Other columns are not read, so their names cannot clash. An empty frame gives an empty frame. A document is
handled whole in one task, with about forty times its bytes of memory at the peak.
"""

import hashlib
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wardlog.llm.columns import map_arrow, row_blocks, spread, strings, text_bytes
from wardlog.llm.words import table
from wardlog.session import materialize

BLOCK_BYTES = 1 << 21
JOINED = 1000  # chunks that are encoded as one text
KNOWN_CHUNK, KNOWN_BYTES = 64, 1 << 26  # bytes of a chunk whose row is kept for later blocks, and of all such rows of a worker
SIDE = 1 << 32  # a pair is a * SIDE + b
STATS = ["n_a", "n_b", "n_groups", "n_links"]


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteSide:
    """The byte-level BPE: lists of ids, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves, as code points
        letter = {chr(b): b for b in printed}
        letter |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(printed)))}
        pieces = {i: bytes(letter[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        pieces |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.pieces = pa.array([pieces.get(i, b"") for i in range(max(pieces) + 1)], pa.binary())
        self.lengths = pc.binary_length(self.pieces).to_numpy()

    def lists(self, chunks: pa.Array) -> pa.ListArray:
        """Chunks that end in a visible character are encoded many at a time, for a token ends there as in any text."""
        data, offsets = text_bytes(chunks)
        alone = ~visible(data)[offsets[1:] - 1]
        turn = np.argsort(alone, kind="stable")
        names, joined = chunks.take(pa.array(turn)).to_pylist(), int(len(alone) - alone.sum())
        texts = ["".join(names[i:min(i + JOINED, joined)]) for i in range(0, joined, JOINED)] + names[joined:]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.cumsum(self.lengths[ids])
        stops = np.searchsorted(ends, np.cumsum(np.diff(offsets)[turn])) + 1
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids)).take(pa.array(np.argsort(turn)))


class PieceSide:
    """The SentencePiece model. Chunks that begin with a space lose it, since the model adds one; others begin with
    a line break, which no piece holds, so the added space stays a token of its own and is taken off."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.space = m.piece_to_id("▁")
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if any("\n" in n or "▁" in n.lstrip("▁") for n in names if not n.startswith("<")):
            raise ValueError("a piece of the vocabulary reaches over a cut between chunks")
        self.pieces = pa.array([bytes([int(n[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) or m.is_unknown(i)
                                else n.replace("▁", " ").encode() for i, n in enumerate(names)], pa.binary())

    def lists(self, chunks: pa.Array) -> pa.ListArray:
        names = chunks.to_pylist()
        found = self.model.encode([c[1:] if c[0] == " " else c for c in names], num_threads=1)
        return pa.array([[self.space] if c == " " else ids if c[0] == " " else ids[1:] for c, ids in zip(names, found)], pa.list_(pa.int32()))


@lru_cache(2)
def tokenizers_at(a: str, b: str) -> tuple[ByteSide, PieceSide]:
    return ByteSide(a), PieceSide(b)


@lru_cache(2)
def known_at(a: str, b: str) -> "Known":
    return Known(tokenizers_at(a, b))


def visible(data: np.ndarray) -> np.ndarray:
    """Bytes that end a visible ASCII character, a two-byte one above U+00BF or a three-byte one from U+4000 to U+DFFF.
    None of them is white space to either tokenizer."""
    out = (data > 32) & (data < 127)
    tail = (data >= 128) & (data < 192)
    out[1:] |= tail[1:] & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    out[2:] |= tail[2:] & tail[1:-1] & (data[:-2] >= 0xE4) & (data[:-2] < 0xEE)
    return out


def cut_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin (one more at the end), and how many each row has. No row is empty.

    A cut lies before a space or line break that follows a visible character.
    """
    begin = np.zeros(len(data), bool)
    begin[1:] = ((data[1:] == 32) | (data[1:] == 10)) & visible(data)[:-1]
    begin[offsets[:-1]] = True
    starts = np.flatnonzero(begin)
    return np.append(starts, len(data)), np.diff(np.searchsorted(starts, offsets))


def _ends(lists: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """One row per token: its parent list, the byte where it ends inside the parent, its place among all tokens."""
    parent, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    running = pc.cumulative_sum(pc.take(lengths, flat))
    before = pa.concat_arrays([pa.array([0], running.type), running])
    end = pc.subtract(running, pc.take(pc.take(before, lists.offsets.cast(pa.int64())), parent))
    return pa.table({"parent": parent, "end": end, "id": flat, "at": pa.array(np.arange(len(flat)))})


def _closing(a: pa.Table, b: pa.Table) -> list[np.ndarray]:
    """For every token of both sides whether a token of the other ends at the same byte of the same parent."""
    met = a.select(["parent", "end", "at"]).join(b.select(["parent", "end", "at"]), ["parent", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    out = [np.zeros(len(a), bool), np.zeros(len(b), bool)]
    for last, name in zip(out, ("at", "at_b")):
        last[met[name].to_numpy()] = True
    return out


def _wide(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def _joined_runs(values: pa.Array, stops: np.ndarray, separator: str) -> pa.Array:
    """Strings joined over runs that end at the given places."""
    runs = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int64()), values)
    return pc.binary_join(runs, _wide(separator))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def chunk_rows(chunks: pa.Array, sides: tuple[ByteSide, PieceSide]) -> pa.Table:
    """The groups and links of different chunks, a row each; every chunk is encoded once."""
    lists = [side.lists(chunks) for side in sides]
    raw = chunks.cast(pa.large_binary() if pa.types.is_large_string(chunks.type) else pa.binary())
    good = np.ones(len(chunks), bool)
    for found, side in zip(lists, sides):
        spelled = pc.binary_join(pa.ListArray.from_arrays(found.offsets, pc.take(side.pieces, found.values)), b"")
        good &= pc.equal(spelled.cast(raw.type), raw).to_numpy(zero_copy_only=False)
    if not good.all():
        empty = pa.scalar([], pa.list_(pa.int32()))
        lists = [pc.if_else(pa.array(good), found, empty) for found in lists]
    n_a, n_b = (pc.list_value_length(x).cast(pa.int64()) for x in lists)
    a, b = (_ends(x, pc.binary_length(s.pieces).cast(pa.int64())) for x, s in zip(lists, sides))
    last_a, last_b = _closing(a, b)
    stop_a, stop_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    owner = a["parent"].to_numpy()[stop_a - 1]  # of each group; groups of both sides follow in the same order
    n_groups = np.bincount(owner, minlength=len(chunks))
    links = np.diff(stop_a, prepend=0) * np.diff(stop_b, prepend=0)
    n_links = np.bincount(owner, links, len(chunks)).astype(np.int64)
    texts = [_joined_runs(x["id"].combine_chunks().cast(pa.large_string()), stop, ",") for x, stop in ((a, stop_a), (b, stop_b))]
    whole = pc.binary_join_element_wise(*texts, _wide("|"))

    def in_group(tokens, last, name):
        number = pa.array(np.cumsum(last) - last)
        return pa.table({"group": number, name: tokens["id"]}).group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(
            ["group", name, "n_" + name])

    linked = in_group(a, last_a, "a").join(in_group(b, last_b, "b"), "group", join_type="inner", use_threads=False)
    pair = pc.add(pc.multiply(linked["a"].cast(pa.int64()), SIDE), linked["b"].cast(pa.int64()))
    per = pa.table({"chunk": pa.array(owner[linked["group"].to_numpy()]), "pair": pair, "times": pc.multiply(linked["n_a"], linked["n_b"])})
    per = per.group_by(["chunk", "pair"], use_threads=False).aggregate([("times", "sum")]).sort_by("chunk").combine_chunks()
    held = pa.array(np.concatenate([[0], np.cumsum(np.bincount(per["chunk"].to_numpy(), minlength=len(chunks)))]), pa.int64())
    return pa.table({
        "good": pa.array(good), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "text": _joined_runs(whole, np.cumsum(n_groups), ";"),
        "pairs": pa.LargeListArray.from_arrays(held, per["pair"].combine_chunks()),
        "times": pa.LargeListArray.from_arrays(held, per["times_sum"].combine_chunks())})


class Known:
    """Rows of chunks met before, so that a chunk that comes again in a later block is not aligned again.

    Chunks of up to KNOWN_CHUNK bytes are kept, until their rows would pass KNOWN_BYTES; then those of the last block are.
    """

    def __init__(self, sides: tuple[ByteSide, PieceSide]):
        self.sides, self.names, self.rows = sides, None, None

    def rows_of(self, chunks: pa.Array) -> tuple[np.ndarray, pa.Table]:
        """Rows of different chunks, and the place of every chunk among them."""
        if self.rows is None or self.names.type != chunks.type:
            old, new, names = None, np.arange(len(chunks)), chunks
            order = new
            rows = chunk_rows(chunks, self.sides)
        else:
            place = pc.index_in(chunks, value_set=self.names)
            fresh = place.is_null().to_numpy(zero_copy_only=False)
            old, new = np.flatnonzero(~fresh), np.flatnonzero(fresh)
            rows = self.rows.take(place.drop_null())
            if len(new):
                rows = pa.concat_tables([rows, chunk_rows(chunks.take(pa.array(new)), self.sides)]).combine_chunks()
            order = np.concatenate([old, new])
            names = chunks.take(pa.array(order))
        self._keep(names, rows, 0 if old is None else len(old))
        at = np.empty(len(chunks), np.int64)
        at[order] = np.arange(len(chunks))
        return at, rows

    def _keep(self, names: pa.Array, rows: pa.Table, known: int) -> None:
        def short(names, rows):
            few = pc.less_equal(pc.binary_length(names), KNOWN_CHUNK)
            return (names, rows) if pc.all(few, min_count=0).as_py() else (names.filter(few), rows.filter(few))

        more, found = short(names[known:], rows[known:])
        if known and self.rows.nbytes + found.nbytes <= KNOWN_BYTES:
            if len(more):
                self.names, self.rows = pa.concat_arrays([self.names, more]), pa.concat_tables([self.rows, found]).combine_chunks()
            return
        self.names, self.rows = short(names, rows)
        if self.rows.nbytes > KNOWN_BYTES:
            self.names = self.rows = None


def align_block(texts: pa.Array, sides, known: Known | None = None) -> tuple[dict, pa.Array, list[np.ndarray]]:
    """Columns of the block's documents, the block's pairs, and per document its pairs (places in the block's) with their links."""
    rows = len(texts)
    out = {n: np.zeros(rows, np.int64) for n in STATS}
    shown, pairs = np.full(rows, None, object), pa.array([], pa.int64())
    ptr, place, links = np.zeros(rows + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    used = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
    if len(used):
        data, offsets = text_bytes(pc.binary_join_element_wise(_wide(" "), texts.take(pa.array(used)).cast(pa.large_string()), _wide("")))
        at, per_row = cut_chunks(data, offsets)
        coded = strings(data, at).dictionary_encode()
        index, of = coded.indices.to_numpy(), np.repeat(np.arange(len(used)), per_row)
        places, found = (known or Known(sides)).rows_of(coded.dictionary)
        index = places[index]
        bad = np.unique(of[~found["good"].to_numpy()[index]])
        keep = ~np.isin(of, bad)
        index, of = index[keep], of[keep]
        per_row[bad] = 0
        for name in STATS:
            out[name][used] = np.bincount(of, found[name].to_numpy()[index], len(used)).astype(np.int64)
        shown[used] = _joined_runs(_one(found["text"]).take(pa.array(index)), np.cumsum(per_row), ";").to_pylist()
        shown[used[bad]] = None
        occurring = pa.table({"doc": of, "chunk": index}).group_by(["doc", "chunk"], use_threads=False).aggregate([([], "count_all")])
        doc, chunk, count = (occurring[c].to_numpy() for c in ("doc", "chunk", "count_all"))
        held = _one(found["pairs"])
        pair_count, pair = pc.list_value_length(held).to_numpy(), held.flatten().dictionary_encode()
        first = np.cumsum(pair_count) - pair_count
        run, nth = spread(pair_count[chunk])
        here = first[chunk[run]] + nth
        each = pa.table({"doc": doc[run], "pair": pair.indices.to_numpy()[here], "links": count[run] * _one(found["times"]).flatten().to_numpy()[here]})
        each = each.group_by(["doc", "pair"], use_threads=False).aggregate([("links", "sum")])
        doc, place, links = (each[c].to_numpy() for c in ("doc", "pair", "links_sum"))
        order = np.lexsort((place, doc))
        place, links, pairs = place[order], links[order], pair.dictionary
        ptr[1:] = np.cumsum(np.bincount(used[doc], minlength=rows))
    return out | {"groups": shown}, pairs, [ptr, place, links]


def align_documents(df: DataFrame, id="doc_id", text="text", a=None, b=None, with_groups=False) -> DataFrame:
    """Rows of two kinds. Documents (`kind` 0): block, id, counts, digest of the groups (and the groups), places of their
    pairs in the block and links of each. Pairs of a block (1): block, place, pair, documents of the block that hold it."""
    known = default_tokenizers()
    a, b = a or known[0], b or known[1]
    kind = df.schema[id].dataType.simpleString()
    schema = (f"kind int, block long, id {kind}, {', '.join(f'{n} long' for n in STATS)}, groups_sha256 string, groups string, "
              "pairs array<int>, links array<long>, place int, pair long, docs long")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        pa.set_cpu_count(1)
        sides, known = tokenizers_at(a, b), known_at(a, b)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1)
            sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
            for i, j in row_blocks(sizes, BLOCK_BYTES):
                stats, pairs, (ptr, place, links) = align_block(texts[i:j], sides, known)
                rows, shown = j - i, stats.pop("groups")
                digest = [hashlib.sha256(x.encode()).hexdigest() if x is not None else "" for x in shown]
                columns = {
                    "kind": np.zeros(rows, np.int32), "block": np.full(rows, block), "id": batch.column(0)[i:j], **stats,
                    "groups_sha256": digest, "groups": pa.array(shown if with_groups else [None] * rows, pa.string()),
                    "pairs": pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(place, pa.int32())),
                    "links": pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(links, pa.int64())),
                }
                yield _filled(columns, rows, arrow)
                if len(pairs):
                    holding = np.bincount(place, minlength=len(pairs))
                    yield _filled({"kind": np.ones(len(pairs), np.int32), "block": np.full(len(pairs), block), "place": np.arange(len(pairs)),
                                   "pair": pairs, "docs": holding}, len(pairs), arrow)
                block += 1

    return map_arrow(df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")), run, schema)


def _filled(columns: dict, rows: int, schema: pa.Schema) -> pa.RecordBatch:
    def column(field):
        found = columns.get(field.name)
        if found is None:
            return pa.nulls(rows, field.type)
        return (found if isinstance(found, pa.Array) else pa.array(found)).cast(field.type)

    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per pair of ids: the documents that hold it, and whether no pair of its A id has more.

    The window holds the pairs of one A id, at most as many as side B has pieces.
    """
    counts = aligned.filter("kind = 1").groupBy("pair").agg(F.sum("docs").alias("count"))
    most = F.max("count").over(W.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("count") == most)


def alignment(df: DataFrame, id="doc_id", text="text", a=None, b=None) -> DataFrame:
    """One row per row of df: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = materialize(align_documents(df, id, text, a, b))
    counts = materialize(pair_counts(aligned))
    known = aligned.filter("kind = 1").select("block", "place", "pair").join(counts, "pair").select(
        F.col("block").alias("holder"), "place", "count", "best")
    docs = aligned.filter("kind = 0").select("block", "id", *STATS, "groups_sha256", "pairs", "links")
    kind = df.schema[id].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'{n} long' for n in STATS)}, n_best long, count_sum long, groups_sha256 string"

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        places = right["place"].to_numpy()
        count, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        count[places] = right["count"].to_numpy()
        best[places] = right["best"].to_numpy()
        lists = left["pairs"].combine_chunks()
        place, times = lists.flatten().to_numpy(), left["links"].combine_chunks().flatten().to_numpy()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())

        def per_row(values):
            running = np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])]
            return pa.array(np.diff(running), pa.int64())

        out = left.drop_columns(["block", "pairs", "links"])
        out = out.append_column("n_best", per_row(times * best[place])).append_column("count_sum", per_row(times * count[place]))
        return out.select(["id", *STATS, "n_best", "count_sum", "groups_sha256"])

    found = docs.groupBy("block").cogroup(known.groupBy("holder")).applyInArrow(summed, schema)
    return found.withColumnRenamed("id", id)


def op12_token_alignment(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents").select("doc_id", "text"))
