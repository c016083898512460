"""Piece vocabularies, an Aho-Corasick automaton over bytes, and lattices of whole blocks of text.

A SentencePiece file's pieces and scores are read as a unigram vocabulary. White space pieces are written with
real spaces. Many pairs of bytes never stand side by side inside a piece (a letter and a space, most ideographs); texts are
cut between them into chunks that can be solved apart.

The different chunks of a block form one lattice: the automaton runs over all chunks side by side, byte column after
byte column, and its output lists become edges, grouped by the position where they end, longest piece first. A
character that is no piece gets one more edge, the unknown one, which stands for its bytes.

Chunks of more than LONG bytes do not stretch the columns. A state depends on no more bytes than the longest piece has, so
the automaton runs over their segments side by side, each begun that many bytes early; scores are then added up by a plain
loop over the edges of one chunk. Which way a chunk goes depends on its own length only.
"""

import math
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardlog.llm.columns import row_blocks, spread, text_bytes

UNKNOWN_PENALTY = 10.0
SPACE_MARK = "▁"
DEDUPED = 64  # longest chunk, in bytes, that is looked up among its equals
LISTED = 1 << 15  # positions of a long chunk whose edges are lists at a time
LONG = 256  # longest chunk, in bytes, that is solved in columns
BLOCK_BYTES = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[bytes, ...]  # of ordinary pieces, spaces written as such
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]  # of the 256 bytes

    @staticmethod
    def read(path: str) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [i for i in range(model.get_piece_size()) if model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)]
        ids = sorted(set(range(model.get_piece_size())) - set(special))
        byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        if not all(map(model.is_byte, byte_ids)):
            raise ValueError("the vocabulary has no byte pieces")
        return Vocabulary(tuple(model.id_to_piece(i).replace(SPACE_MARK, " ").encode() for i in ids), tuple(ids),
                          tuple(model.get_score(i) for i in ids), byte_ids)


class Automaton:
    """Aho-Corasick over bytes, as tables. Only states with children have a row of transitions."""

    def __init__(self, vocabulary: Vocabulary):
        children, parent_fail = [{}], [0]
        ends = {}
        for n, piece in enumerate(vocabulary.pieces):
            at = 0
            for b in piece:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                at = children[at][b]
            ends[at] = n
        self.unknown_score = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.present = np.zeros(256, bool)
        for piece in vocabulary.pieces:
            self.present[list(piece)] = True
        beside = np.zeros((256, 256), bool)  # pairs of bytes that stand side by side in a piece
        for piece in vocabulary.pieces:
            beside[list(piece[:-1]), list(piece[1:])] = True
        beside[:, 0x80:0xC0] = True  # a character is never cut
        self.beside = beside.ravel()
        self.reach = max(map(len, vocabulary.pieces), default=1)
        self.symbol = np.zeros(256, np.int64)
        self.symbol[self.present] = np.arange(1, int(self.present.sum()) + 1)
        width = int(self.present.sum()) + 1
        inner = [i for i, c in enumerate(children) if c]
        row = np.zeros(len(children), np.int64)
        row[inner] = np.arange(len(inner))
        table = np.zeros((len(inner), width), np.int32)
        fail = [0] * len(children)
        lists = [()] * len(children)  # pieces that end here, longest first
        queue = [0]
        for at in queue:
            if at:
                if not children[at]:
                    row[at] = row[fail[at]]
                else:
                    table[row[at]] = table[row[fail[at]]]
                lists[at] = ((ends[at],) if at in ends else ()) + lists[fail[at]]
            for b, child in children[at].items():
                s = self.symbol[b]
                fail[child] = int(table[row[at], s]) if at else 0
                table[row[at], s] = child
                queue.append(child)
        self.table, self.row, self.width = table.ravel(), row * width, width
        self.outputs = np.array([len(x) for x in lists], np.int64)
        self.first = np.cumsum(self.outputs) - self.outputs
        self.flat = np.array([n for x in lists for n in x], np.int64)
        one = np.array([len(p.decode()) == 1 for p in vocabulary.pieces])
        self.has_single = np.array([any(one[n] for n in x) for x in lists])
        self.lengths = np.array([*map(len, vocabulary.pieces), 0], np.int64)  # the last one is the unknown piece
        self.scores = np.array([*vocabulary.scores, self.unknown_score])
        self.ids = np.array([*vocabulary.ids, -1], np.int64)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)
        self.unknown = len(vocabulary.pieces)
        rng = np.random.default_rng(99)
        self.salt = rng.integers(0, 1 << 64, DEDUPED * 256, np.uint64)


_AUTOMATA: dict = {}


def automaton(vocabulary: Vocabulary) -> Automaton:
    """One per process and vocabulary."""
    key = hash((vocabulary.pieces, vocabulary.scores))
    if key not in _AUTOMATA:
        _AUTOMATA[key] = Automaton(vocabulary)
    return _AUTOMATA[key]


def normalized(column) -> pa.Array:
    """Texts as the tokenizer sees them: a space in front of every text that is not empty, marks as spaces."""
    plain = pc.replace_substring(pc.fill_null(column.cast(pa.string()), ""), SPACE_MARK, " ")
    return pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(plain), 0), "", " "), plain, "")


class Chunks:
    """Where the chunks of a block begin, how long they are, and which are equal."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, machine: Automaton):
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        if len(data):
            cut[1:-1] |= ~machine.beside[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        self.starts = np.flatnonzero(cut[:-1]) if len(data) else np.empty(0, np.int64)
        self.lengths = np.diff(np.append(self.starts, len(data)))
        self.per_row = np.searchsorted(self.starts, offsets[1:]) - np.searchsorted(self.starts, offsets[:-1])
        short = self.lengths <= DEDUPED
        run, place = spread(self.lengths)
        key = machine.salt[np.minimum(place, DEDUPED - 1) * 256 + data]
        hashed = np.add.reduceat(key, self.starts) if len(self.starts) else key
        hashed = hashed * np.uint64(2) + short  # longer chunks stand for themselves
        hashed = np.where(short, hashed, np.arange(len(hashed), dtype=np.uint64) * np.uint64(2))
        _, first, self.kind = np.unique(hashed, return_index=True, return_inverse=True)
        order = np.argsort(-self.lengths[first], kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.kind = rank[self.kind]
        self.kind_starts, self.kind_lengths = self.starts[first][order], self.lengths[first][order]


class Lattice:
    """All different chunks of a block, longest first; node (column t, chunk r) is the position after byte t.

    Edges are sorted by the node they end in; column t has the nodes column[t] : column[t + 1]. The start of a
    chunk is node -1.
    """

    def __init__(self, data, chunks: Chunks, machine: Automaton):
        starts, lengths = chunks.kind_starts, chunks.kind_lengths
        columns = int(lengths[0]) if len(lengths) else 0
        alive = np.searchsorted(-lengths, -np.arange(columns), side="left")
        self.column = np.concatenate([[0], np.cumsum(alive)]).astype(np.int64)
        self.machine, total = machine, int(self.column[-1])
        self.n_long = int(np.searchsorted(-lengths, -LONG, side="left"))
        self.short_columns = min(columns, LONG) if len(lengths) > self.n_long else 0
        states, char = np.empty(total, np.int64), np.empty(total, np.int64)
        symbol, ended = machine.symbol[data], _characters(data, chunks.starts)
        state = np.zeros(len(lengths) - self.n_long, np.int64)
        for t in range(self.short_columns):
            at = starts[self.n_long:alive[t]] + t
            state = machine.table[machine.row[state[:len(at)]] + symbol[at]].astype(np.int64)
            own = slice(self.column[t] + self.n_long, self.column[t + 1])
            states[own], char[own] = state, ended[at]
        if self.n_long:
            self._long_states(starts[:self.n_long], lengths[:self.n_long], symbol, ended, states, char)
        unknown = (char > 0) & ~machine.has_single[states]
        known = machine.outputs[states]
        self.n_edges = known + unknown
        self.offset = np.cumsum(self.n_edges) - self.n_edges
        run, place = spread(self.n_edges)
        inside = place < known[run]
        piece = np.full(len(run), machine.unknown)
        piece[inside] = machine.flat[machine.first[states[run[inside]]] + place[inside]]
        self.piece = piece
        self.length = np.where(inside, machine.lengths[piece], char[run])
        self.run = run
        t_of = np.repeat(np.arange(columns), alive)
        back = t_of[run] - self.length  # column of the node where the edge begins
        self.from_node = np.where(back >= 0, self.column[back] + (run - self.column[t_of[run]]), -1)
        self.score = machine.scores[piece]
        self.columns, self.alive = columns, alive
        self.lengths = lengths
        self.last = self.column[lengths - 1] + np.arange(len(lengths)) if len(lengths) else np.empty(0, np.int64)

    def _long_states(self, starts, lengths, symbol, ended, states, char):
        """States of long chunks: segments side by side, each begun so early that its first state is the true one."""
        machine, lead = self.machine, self.machine.reach - 1
        chunk, place = spread(-(-lengths // LONG))
        begin, first = starts[chunk], place * LONG
        stop = lengths[chunk]
        state = np.zeros(len(chunk), np.int64)
        for u in range(-lead, LONG):
            t = first + u
            inside = (t >= 0) & (t < stop)
            at = begin + np.where(inside, t, 0)
            state = np.where(inside, machine.table[machine.row[state] + symbol[at]], 0).astype(np.int64)
            if u >= 0:
                node = self.column[t[inside]] + chunk[inside]
                states[node], char[node] = state[inside], ended[at[inside]]

    def _long_edges(self, chunk: int):
        """Of a long chunk, some thousand nodes at a time: nodes, and their edges as (first edge, number of edges)."""
        for t in range(0, int(self.lengths[chunk]), LISTED):
            nodes = self.column[t:min(t + LISTED, int(self.lengths[chunk]))] + chunk
            run, place = spread(self.n_edges[nodes])
            yield nodes, self.offset[nodes][run] + place, self.n_edges[nodes].tolist()

    def _columns(self):
        """Per column of the other chunks: its edges, the nodes that have edges, and where their edges begin among them."""
        for t in range(self.short_columns):
            nodes = np.arange(self.column[t] + self.n_long, self.column[t + 1])
            nodes = nodes[self.n_edges[nodes] > 0]
            if len(nodes):
                begin = int(self.offset[nodes[0]])
                end = int(self.offset[nodes[-1]] + self.n_edges[nodes[-1]])
                yield slice(begin, end), nodes, self.offset[nodes] - begin

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Best score and number of pieces of every chunk. The first of equal edges wins: the longest piece, the
        unknown one last, as a tokenizer does that tries starts in order and replaces only for a higher score."""
        score, count = np.zeros(self.column[-1] + 1), np.zeros(self.column[-1] + 1, np.int64)
        weight = np.where(self.piece == self.machine.unknown, self.length, 1)
        for edges, nodes, first in self._columns():
            back = self.from_node[edges]
            total = score[back] + self.score[edges]
            top = np.maximum.reduceat(total, first)
            sizes = np.diff(np.append(first, len(total)))
            hit = np.flatnonzero(total == np.repeat(top, sizes))
            chosen = hit[np.searchsorted(hit, first)]
            score[nodes] = top
            count[nodes] = count[back[chosen]] + weight[edges][chosen]
        for chunk in range(self.n_long):
            totals, counts = [0.0], [0]
            for _, edges, per_node in self._long_edges(chunk):
                steps = zip(self.length[edges].tolist(), self.score[edges].tolist(), weight[edges].tolist())
                for t, n in enumerate(per_node, len(totals)):
                    top, pieces = -np.inf, 0
                    for length, gain, more in islice(steps, n):
                        value = totals[t - length] + gain
                        if value > top:
                            top, pieces = value, counts[t - length] + more
                    totals.append(top)
                    counts.append(pieces)
            score[self.last[chunk]], count[self.last[chunk]] = totals[-1], counts[-1]
        return score[self.last], count[self.last]

    def sums(self, theta: float):
        """Edge probabilities, given the node they end in, of segmentations drawn with weight exp(theta * score);
        and their running sums inside each node."""
        inside = np.full(self.column[-1] + 1, -np.inf)
        inside[-1] = 0.0
        weight = theta * self.score
        for edges, nodes, first in self._columns():
            value = inside[self.from_node[edges]] + weight[edges]
            top = np.maximum.reduceat(value, first)
            sizes = np.diff(np.append(first, len(value)))
            inside[nodes] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, sizes)), first))
        for chunk in range(self.n_long):
            totals = [0.0]
            for nodes, edges, per_node in self._long_edges(chunk):
                steps, done = zip(self.length[edges].tolist(), weight[edges].tolist()), len(totals)
                for t, n in enumerate(per_node, done):
                    values = [totals[t - length] + gain for length, gain in islice(steps, n)]
                    top = max(values, default=-math.inf)
                    totals.append(top + math.log(sum([math.exp(v - top) for v in values])) if n > 1 else top)
                inside[nodes] = totals[done:]
        log_p = inside[self.from_node] + weight - inside[self.run]
        p = np.exp(log_p)
        running = p.copy()  # summed node by node, so that the other chunks of a block leave no trace
        for k in range(1, int(self.n_edges.max()) if len(p) else 0):
            edge = self.offset[self.n_edges > k] + k
            running[edge] += running[edge - 1]
        return log_p, p, running


def _characters(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every byte that ends a character the character's number of bytes, 0 for the others. A byte begins a character
    unless it continues one; bytes that continue nothing belong to what is before them."""
    begins = (data & 0xC0) != 0x80
    begins[starts] = True
    at = np.flatnonzero(begins)
    sizes = np.diff(np.append(at, len(data)))
    ended = np.zeros(len(data), np.int64)
    ended[at + sizes - 1] = sizes
    return ended


def blocks_of(column, limit=BLOCK_BYTES):
    """(first row, last row, bytes, offsets) of blocks of normalised texts."""
    data, offsets = text_bytes(normalized(column))
    for i, j in row_blocks(offsets, limit):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
