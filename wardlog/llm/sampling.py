"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

A text's segmentations form a lattice; one has weight exp(theta * sum of its piece scores). The k segmentations
with the greatest Gumbel-perturbed log probabilities are k draws without replacement. They are found by a best-first (A*) search
over sets of segmentations that share a prefix of decisions, in reading order chunk by chunk and from a chunk's end to
its start: the perturbed maximum of a set bounds it exactly, its best member is an ordinary draw, and the
rest of each set on the way gets a truncated Gumbel as its own maximum. The next sample is drawn in the open set of highest maximum.

The k draws of all chunks of a block are made at once in numpy; per sample only the chunk in which it leaves its parent is
searched singly. Random numbers are hashes of the row's key, the sample and the byte position, so results do not
depend on how rows are dealt.

With the (k+1)-th perturbed maximum kappa, a sample of log probability l is among the first k with probability
1 - exp(-exp(l - kappa)); its logarithm is given as the inclusion score (0 if all segmentations were drawn).

Defined results: NULL and empty texts have one segmentation without pieces; a text with fewer than k segmentations gives
all it has; rows with equal keys and texts get equal samples, a NULL key is a key like others; other columns are not
read; an empty frame gives an empty frame. Texts are used whole, in blocks of about 256 kB or one text.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from wardlog.llm.columns import map_arrow, mix64, row_blocks, spread, strings, text_bytes
from wardlog.llm.lattice import LONG, Automaton, Chunks, Lattice, Vocabulary, automaton, blocks_of
from wardlog.llm.tokencount import default_model
from wardlog.llm.words import table

SAMPLES = 2
THETA = 1 / 2000  # the public scores are ranks: a lead of 2000 ranks makes a segmentation e times likelier
SEED = 11
DECODED_IDS = 1 << 18  # decoded at a time


_MASK = (1 << 64) - 1


def _unit(x: np.ndarray) -> np.ndarray:
    """(0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _hash(*parts) -> np.ndarray:
    x = np.full(1, SEED, np.uint64)
    for part in parts:
        x = mix64(x + np.asarray(part).astype(np.uint64))
    return x


def _number(*parts: int) -> float:
    """(0, 1) from whole numbers."""
    x = SEED
    for part in parts:
        x = (x + part) & _MASK
        for _ in range(2):
            x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK
        x ^= x >> 32
    return ((x >> 11) + 0.5) * 2.0**-53


def _remainder(phi, bound, u):
    """The maximum of sets of log mass phi, known to lie under bound: truncated Gumbels."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        value = phi - np.log(-np.log(u) + np.exp(phi - bound))
    return np.where(np.isneginf(phi), -np.inf, value)


class _Draws:
    """One draw of every chunk of a block: decisions (edges) in search order, and ids in reading order."""

    def __init__(self, block: "Block", seeds: np.ndarray):
        lattice, chunks = block.lattice, block.chunks
        # narrow copies: this loop is bound by memory
        first_edge, last_edge = (x.astype(np.int32) for x in (lattice.offset, lattice.offset + lattice.n_edges - 1))
        length, from_node = lattice.length.astype(np.int32), lattice.from_node.astype(np.int32)
        steps = np.zeros(len(chunks.kind), np.int32)

        def choose(node, seed):
            edge, last = first_edge[node], last_edge[node]
            u = _unit(_hash(seed))
            search = np.flatnonzero(block.running[edge] <= u)
            while len(search):
                search = search[edge[search] < last[search]]
                edge[search] += 1
                search = search[block.running[edge[search]] <= u[search]]
            return edge

        who, when, what = [], [], []
        # a choice depends on the position only: long chunks choose at all positions, then follow the choices
        for c in np.flatnonzero(chunks.lengths > LONG):
            size = int(chunks.lengths[c])
            nodes = (lattice.column[:size] + chunks.kind[c]).astype(np.int32)
            ends = np.flatnonzero(lattice.n_edges[nodes])
            edge = np.zeros(size, np.int32)
            edge[ends] = choose(nodes[ends], seeds[c] + (block.place[c] + 1 + ends).astype(np.uint64))
            hops, at, way = length[edge].tolist(), size - 1, []
            while at >= 0:
                way.append(at)
                at -= hops[at]
            steps[c] = len(way)
            who.append(np.full(len(way), c, np.int32))
            when.append(np.arange(len(way), dtype=np.int32))
            what.append(edge[way])
        active = np.flatnonzero(chunks.lengths <= LONG).astype(np.int32)
        node = lattice.last[chunks.kind[active]].astype(np.int32)
        seed = (seeds + (block.place + chunks.lengths).astype(np.uint64))[active]
        depth = 0
        while len(active):
            edge = choose(node, seed)
            who.append(active)
            when.append(np.full(len(active), depth, np.int32))
            what.append(edge)
            depth += 1
            node = from_node[edge]
            seed = seed - length[edge].astype(np.uint64)
            on = node >= 0
            steps[active[~on]] = depth
            active, node, seed = active[on], node[on], seed[on]
        who, when, what = map(np.concatenate, (who, when, what))
        self.first = np.concatenate([[0], np.cumsum(steps)])  # of each chunk, one more at the end
        self.edges = np.empty(int(self.first[-1]), np.int64)
        self.edges[self.first[who] + when] = what
        self.upto = np.concatenate([[0.0], np.cumsum(block.log_p[self.edges])])
        read = np.empty(len(self.edges), np.int64)
        read[self.first[who + 1] - 1 - when] = what
        self.ids, per_edge = block.spell(read, chunks.starts[0])
        self.id_first = np.concatenate([[0], np.cumsum(per_edge)])[self.first]


class _Path:
    """A sample: ids before a chunk, the decisions of this chunk (the first settled of them shared with its
    parent), and a draw of all later chunks. rest has the maxima of the sets left at its own decisions."""

    def __init__(self, draw, chunk, own, settled, ids, before, bound):
        self.draw, self.chunk, self.own, self.settled = draw, chunk, own, settled
        self.ids, self.before, self.bound = ids, before, bound
        self.used: dict[int, list[int]] = {}
        self.rest = None

    def top(self) -> float:
        return float(self.rest.max()) if len(self.rest) else -np.inf


class Block:
    """Draws samples of the texts of a block of normalised bytes."""

    WINDOW = 128

    def __init__(self, machine: Automaton, k: int, theta: float, data, offsets, keys: np.ndarray):
        self.machine, self.k, self.data, self.keys = machine, k, data, keys
        self.rows = len(offsets) - 1
        self.chunks = chunks = Chunks(data, offsets, machine)
        if not len(chunks.starts):
            return
        self.lattice = lattice = Lattice(data, chunks, machine)
        self.log_p, self.p, self.running = lattice.sums(theta)
        single = lattice.n_edges[lattice.run] == 1
        with np.errstate(divide="ignore"):
            self.log_rest = np.where(single, -np.inf, np.log(np.maximum(1 - self.p, 0)))
        # on a grid of 2^-30, sums are exact and do not depend on what else the block holds
        self.log_p = np.where(single, 0.0, np.round(np.maximum(self.log_p, -1e6) * 2.0**30) * 2.0**-30)
        row = np.repeat(np.arange(self.rows), chunks.per_row)
        self.place = chunks.starts - offsets[row]
        self.draws = [_Draws(self, _hash(keys, j)[row]) for j in range(k)]
        self.begin = np.concatenate([[0], np.cumsum(chunks.per_row)])
        # the sets left on the way of every text's first sample, as far as they matter (see _far_enough)
        d = self.draws[0]
        starts = d.first[self.begin]
        seeds, sizes = _hash(keys, 1000), np.diff(starts)
        self.bounds = -np.log(-np.log(_unit(_hash(keys, 999))))
        self.rests: list = [None] * self.rows
        window, left = self.WINDOW, np.flatnonzero(sizes)
        while len(left):
            run, place = spread(np.minimum(sizes[left], window))
            at = starts[left][run] + place
            phi = d.upto[at] - d.upto[starts[left][run]] + self.log_rest[d.edges[at]]
            rest = _remainder(phi, self.bounds[left][run], _unit(mix64(seeds[left][run] + place.astype(np.uint64))))
            more, cuts = [], np.flatnonzero(np.diff(run)) + 1
            for r, found in zip(left.tolist(), np.split(rest, cuts)):
                seen = len(found)
                if seen < sizes[r] and not self._far_enough(found, float(d.upto[starts[r] + seen] - d.upto[starts[r]])):
                    more.append(r)
                else:
                    self.rests[r] = found
            left, window = np.array(more, np.int64), window * 8

    def spell(self, edges: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of edges that follow each other in the text from byte start, and how many each has; an unknown
        character has one for each of its bytes."""
        piece = self.lattice.piece[edges]
        ids = self.machine.ids[piece].astype(np.int32)
        unknown = piece == self.machine.unknown
        if not unknown.any():
            return ids, np.ones(len(ids), np.int64)
        lengths = self.lattice.length[edges]
        begins = start + np.cumsum(lengths) - lengths
        per_edge = np.where(unknown, lengths, 1)
        if lengths[unknown].max() == 1:
            ids[unknown] = self.machine.byte_ids[self.data[begins[unknown]]]
            return ids, per_edge
        run, place = spread(per_edge)
        ids = ids[run]
        byte = unknown[run]
        ids[byte] = self.machine.byte_ids[self.data[begins[run[byte]] + place[byte]]]
        return ids, per_edge

    def samples(self):
        """Per text a list of (ids, log probability, inclusion score)."""
        if not len(self.chunks.starts):
            return [[(np.empty(0, np.int32), 0.0, 0.0)] for _ in range(self.rows)]
        return [self._text(r, int(self.begin[r]), int(self.begin[r + 1])) for r in range(self.rows)]

    def _text(self, r: int, begin: int, end: int):
        if begin == end:
            return [(np.empty(0, np.int32), 0.0, 0.0)]
        key = int(self.keys[r])
        first = _Path(0, begin - 1, [], 0, [], 0.0, float(self.bounds[r]))
        first.rest = self.rests[r].copy()
        paths, tops = [first], [first.top()]
        while len(paths) < self.k and max(tops) > -np.inf:
            parent = tops.index(max(tops))
            child = self._leave(key, len(paths), paths[parent], end)
            tops[parent] = paths[parent].top()
            paths.append(child)
            tops.append(child.top())
        kappa, out = max(tops), []
        for path in paths:
            d = self.draws[path.draw]
            total = path.before + sum(float(self.log_p[e]) for e in path.own) + float(d.upto[d.first[end]] - d.upto[d.first[path.chunk + 1]])
            x = total - kappa
            score = 0.0 if kappa == -np.inf else x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 50.0)))))
            tail = d.ids[d.id_first[path.chunk + 1]:d.id_first[end]]
            out.append((np.concatenate([*path.ids, *self._own_ids(path), tail]), total, score))
        return out

    def _own_ids(self, path):
        return [self.spell(np.array(path.own[::-1]), int(self.chunks.starts[path.chunk]))[0]] if path.own else []

    def _leave(self, key: int, j: int, path: _Path, end: int) -> _Path:
        """The best member of the set of highest maximum on a path; the set keeps what it has besides."""
        lattice, d = self.lattice, self.draws[path.draw]
        at = int(path.rest.argmax())
        bound, n_own = float(path.rest[at]), len(path.own) - path.settled
        if at < n_own:
            chunk, settled, edge = path.chunk, path.own[:path.settled + at], path.own[path.settled + at]
            ids, before = path.ids, path.before
        else:
            q = int(d.first[path.chunk + 1]) + at - n_own
            chunk = int(np.searchsorted(d.first, q, side="right")) - 1
            settled, edge = d.edges[d.first[chunk]:q].tolist(), int(d.edges[q])
            ids = [*path.ids, *self._own_ids(path), d.ids[d.id_first[path.chunk + 1]:d.id_first[chunk]]]
            before = path.before + sum(float(self.log_p[e]) for e in path.own) + float(d.upto[d.first[chunk]] - d.upto[d.first[path.chunk + 1]])
        used = path.used.setdefault(at, [edge])
        node = int(lattice.run[edge])
        mass = {e: float(self.p[e]) for e in self._edges(node) if e not in used}
        chosen = self._pick(mass, _number(key, 2000 + j, 0))
        used.append(chosen)
        others = sum(m for e, m in mass.items() if e != chosen)
        phi = before + sum(float(self.log_p[e]) for e in settled)
        path.rest[at] = float(_remainder(phi + np.log(others), bound, _number(key, 3000 + j))) if others > 0 else -np.inf
        own, n = [*settled, chosen], int(lattice.from_node[chosen])
        while n >= 0:
            own.append(self._pick({e: float(self.p[e]) for e in self._edges(n)}, _number(key, 2000 + j, len(own) + 1)))
            n = int(lattice.from_node[own[-1]])
        child = _Path(j, chunk, own, len(settled) + 1, ids, before, bound)
        self._rests(key, child, end)
        return child

    def _edges(self, node: int) -> range:
        begin = int(self.lattice.offset[node])
        return range(begin, begin + int(self.lattice.n_edges[node]))

    @staticmethod
    def _pick(mass: dict[int, float], u: float) -> int:
        u *= sum(mass.values())
        for edge, m in mass.items():
            u -= m
            if u < 0:
                return edge
        return edge

    def _far_enough(self, rest: np.ndarray, upto: float) -> bool:
        """Whether no later set can be among the k + 1 highest of a path: a maximum exceeds its set's log mass by less
        than 37, the most that the random numbers allow, and a later set's mass is less than that of the path so far."""
        if len(rest) <= self.k:
            return False
        return upto + 37 < np.partition(rest, -self.k - 1)[-self.k - 1]

    def _rests(self, key: int, path: _Path, end: int):
        """Maxima of the sets left on a path, as far as they matter."""
        d = self.draws[path.draw]
        start, stop = int(d.first[path.chunk + 1]), int(d.first[end])
        size = self.WINDOW
        settled = path.before + sum(float(self.log_p[e]) for e in path.own[:path.settled])
        while True:
            edges = np.concatenate([np.array(path.own[path.settled:], np.int64), d.edges[start:min(stop, start + size)]])
            if not len(edges):
                path.rest = np.empty(0)
                return
            upto = settled + np.cumsum(self.log_p[edges])
            phi = np.concatenate([[settled], upto[:-1]]) + self.log_rest[edges]
            path.rest = _remainder(phi, path.bound, _unit(_hash(key, 4000 + path.draw, np.arange(len(edges)))))
            if start + size >= stop or self._far_enough(path.rest, float(upto[-1])):
                return
            size *= 4


def sample_encodings(df: DataFrame, model_path: str, key="doc_id", text="text", samples=SAMPLES, theta=THETA) -> DataFrame:
    """key, sample (0 first), ids, log_prob, inclusion: up to samples rows per row of df."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))  # one vocabulary, about 1 MB
    names = ["key", "sample", "ids", "log_prob", "inclusion"]

    def run(batches):
        machine = automaton(shared.value)
        for batch in batches:
            keys, hashes = batch.column("key"), np.asarray(batch.column("hash")).view(np.uint64)
            for i, j, data, offsets in blocks_of(batch.column("text")):
                found = Block(machine, samples, theta, data, offsets, hashes[i:j]).samples()
                rows = [r for r, x in enumerate(found) for _ in x]
                flat = [s for x in found for s in x]
                lengths = np.concatenate([[0], np.cumsum([len(s[0]) for s in flat])]).astype(np.int32)
                ids = np.concatenate([s[0] for s in flat])
                yield pa.RecordBatch.from_arrays([
                    keys.slice(i, j - i).take(pa.array(rows)), pa.array([n for x in found for n in range(len(x))], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(ids)),
                    pa.array([s[1] for s in flat], pa.float64()), pa.array([s[2] for s in flat], pa.float64()),
                ], names=names)

    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`")).alias("hash"))
    return map_arrow(rows, run, f"key {dict(rows.dtypes)['key']}, sample int, ids array<int>, log_prob double, inclusion double")


def decode_pieces(df: DataFrame, model_path: str, ids="ids", out="decoded") -> DataFrame:
    """df with the text of every list of ids; bytes that are no UTF-8 become U+FFFD, control pieces nothing, NULL stays NULL."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)

    def piece(i):
        if model.is_control(i):
            return b""
        return bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()

    pieces = [piece(i) for i in range(model.get_piece_size())]
    shared = df.sparkSession.sparkContext.broadcast(pieces)
    rest = df.drop(out)

    def run(batches):
        pieces = pa.array(shared.value, pa.binary())
        for whole in batches:
            index = whole.schema.get_field_index(ids)
            at = np.concatenate([[0], np.cumsum([n or 0 for n in pc.list_value_length(whole.column(index)).to_pylist()])])
            for i, j in row_blocks(at, DECODED_IDS):
                batch = whole.slice(i, j - i)
                data, ends = text_bytes(pieces.take(batch.column(index).flatten()))
                upto = ends[at[i:j + 1] - at[i]]
                leading = np.zeros(j - i, np.int64)
                filled = upto[1:] > upto[:-1]
                leading[filled] = data[upto[:-1][filled]] == 32
                keep = np.ones(len(data), bool)
                keep[upto[:-1][leading > 0]] = False
                offsets = upto - np.concatenate([[0], np.cumsum(leading)])
                raw = data[keep].tobytes()
                try:
                    raw.decode()
                    texts = strings(np.frombuffer(raw, np.uint8), offsets).cast(pa.string())
                except UnicodeDecodeError:
                    texts = pa.array([raw[a:b].decode(errors="replace") for a, b in zip(offsets, offsets[1:])], pa.string())
                if batch.column(index).null_count:
                    texts = pc.if_else(batch.column(index).is_valid(), texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, out])

    return map_arrow(rest, run, StructType(list(rest.schema.fields)).add(out, StringType()))


def op10_sentencepiece(spark, sf_dir, model_path: str | None = None):
    """Samples, and whether each decodes to its text (as the model reads it: U+2581 is a space)."""
    path = model_path or default_model()
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = decode_pieces(sample_encodings(documents, path), path)
    return decoded.select(
        F.col("key").alias("doc_id"), "sample", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        "log_prob", "inclusion", F.sha2("decoded", 256).alias("decoded_sha256"))
