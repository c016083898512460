"""A bidirectional gated recurrent network with attention pooling, in numpy: inputs, training and scoring.

A word is a run of letters, digits and non-ASCII bytes of the lowered text. Its input joins a word vector (of the
training vocabulary, or the vector of unknown words) and the sum of vectors of its 4-byte character runs, spaces
marking its ends. Windows of WIDTH words begin at every STEP-th word and cover every text in full; a text's logit is the greatest
of its windows. Training follows that: after some rounds on random windows, each text teaches with the windows that
score highest at the moment. Gates are computed once for every different word; all windows run with gates rounded to a grid, then those
near a text's highest in full precision, which alone give scores.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardlog.llm.columns import mix64, row_blocks, spread, text_bytes

WIDTH = 16
STEP = 1  # divides WIDTH; 1 is every window
HIDDEN, WORD_DIM, CHAR_DIM, CHAR_BITS = 8, 8, 8, 16
VOCABULARY = 8192
PIECE = 1 << 18  # bytes of text scored at a time; a longer text is read in such pieces, its windows are those of the whole
COLUMNS = 6144  # windows that run side by side
GRID, MARGIN = 1024, 0.05  # of rough logits: steps of a gate, and how far below the highest a window is run in full

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def lowered(column) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.string()), ""))


class Words:
    """Words of a block of texts: hash, row, and character runs of each, from one byte array."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, with_runs=True):
        inside = _INSIDE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(begin)
        self.lengths = np.flatnonzero(end) + 1 - self.starts
        self.count = len(self.starts)
        self.per_row = np.searchsorted(self.starts, offsets[1:]) - np.searchsorted(self.starts, offsets[:-1])
        letters = np.flatnonzero(inside)
        self.first = np.cumsum(self.lengths) - self.lengths  # of each word in the letters
        if not self.count:
            self.hash, self.key, self.runs = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
            return
        if with_runs:
            self.runs = self._runs(data, inside, begin, end)[letters]
        _, place = spread(self.lengths)
        powers = np.cumprod(np.concatenate([[1], np.full(int(self.lengths.max()), 0x9E3779B97F4A7C15, np.uint64)]).astype(np.uint64))
        byte = data[letters].astype(np.uint64)
        self.hash = mix64(np.add.reduceat(byte * powers[place] + powers[place + 1], self.first))  # of a word's first letters
        byte *= np.cumprod(np.full(len(powers), 0x9E3779B97F4A7C15, np.uint64))[place]
        byte ^= byte >> np.uint64(29)
        self.key = np.add.reduceat(byte, self.first)  # of the whole word

    @classmethod
    def of_all(cls, data: np.ndarray, offsets: np.ndarray) -> "Words":
        """Words of many texts, found block by block; lengths, runs and hashes only, in narrow types."""
        parts = [cls(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in row_blocks(offsets, PIECE)]
        out = cls.__new__(cls)
        out.lengths = np.concatenate([p.lengths for p in parts]).astype(np.int32)
        out.runs = np.concatenate([p.runs for p in parts]).astype(np.uint16)
        out.hash, out.key, out.per_row = (np.concatenate([getattr(p, n) for p in parts]) for n in ("hash", "key", "per_row"))
        out.count, out.first = len(out.hash), np.cumsum(out.lengths, dtype=np.int64) - out.lengths
        return out

    @classmethod
    def _of(cls, hash, key, lengths, runs) -> "Words":
        out = cls.__new__(cls)
        out.hash, out.key, out.lengths, out.runs, out.count = hash, key, lengths, runs, len(hash)
        out.first, out.per_row = np.cumsum(lengths) - lengths, np.array([len(hash)])
        return out

    def part(self, i: int, j: int) -> "Words":
        """Words i to j of a single text."""
        ends = np.append(self.first, self.lengths.sum())
        return self._of(self.hash[i:j], self.key[i:j], self.lengths[i:j], self.runs[ends[i]:ends[j]])

    def followed_by(self, other: "Words") -> "Words":
        return self._of(*(np.concatenate([getattr(self, n), getattr(other, n)]) for n in ("hash", "key", "lengths", "runs")))

    def different(self) -> tuple[np.ndarray, tuple]:
        """For every word its place among the different ones, and these: hashes, runs, and where their runs begin."""
        coded = pa.array(self.key).dictionary_encode()
        code, where = coded.indices.to_numpy(), np.empty(len(coded.dictionary), np.int64)
        where[code[::-1]] = np.arange(self.count)[::-1]
        lengths = self.lengths[where]
        run, place = spread(lengths)
        return code, (self.hash[where], self.runs[self.first[where][run] + place], np.cumsum(lengths) - lengths)

    @staticmethod
    def _runs(data, inside, begin, end):
        shown = np.where(inside, data, 32).astype(np.uint32)
        padded = np.concatenate([shown, np.full(2, 32, np.uint32)])
        after = np.where(end, 32, padded[1:-1])
        after_next = np.where(after == 32, 32, np.concatenate([after[1:], [32]]).astype(np.uint32))
        before = np.where(begin, 32, np.concatenate([[32], shown[:-1]]).astype(np.uint32))
        key = before * _PRIMES[0] ^ shown * _PRIMES[1] ^ after * _PRIMES[2] ^ after_next * _PRIMES[3]
        key = (key ^ (key >> np.uint32(15))) * _PRIMES[0]
        return (key >> np.uint32(32 - CHAR_BITS)).astype(np.int64)


def word_spans(text: np.ndarray):
    """Words of one long text, some at a time: every window of WIDTH words at a multiple of STEP lies in exactly one span.

    Pieces end between words. The next span begins with the window after the last whole one.
    """
    at, end, kept, first = 0, len(text), None, True
    while at < end:
        stop = min(end, at + PIECE)
        while stop < end and _INSIDE[text[stop]]:
            rest = np.flatnonzero(~_INSIDE[text[stop:stop + PIECE]])
            stop = min(end, stop + int(rest[0]) if len(rest) else stop + PIECE)
        found = Words(text[at:stop], np.array([0, stop - at]))
        kept = found if kept is None else kept.followed_by(found)
        at = stop
        whole = kept.count // STEP * STEP
        if at < end and whole >= WIDTH:
            yield kept.part(0, whole)
            kept, first = kept.part(whole - WIDTH + STEP, kept.count), False
    if first or kept.count > WIDTH - STEP:
        yield kept


class Layout:
    """Words padded to blocks of STEP per text; window i is SPAN blocks of one text, from block i on."""

    def __init__(self, per_row: np.ndarray):
        self.span = WIDTH // STEP
        self.blocks = np.maximum(self.span, -(-per_row // STEP))
        self.windows = self.blocks - self.span + 1
        self.base = np.cumsum(self.blocks) - self.blocks
        self.total = int(self.blocks.sum())
        run, place = spread(per_row)
        self.slot = self.base[run] * STEP + place
        self.mask = np.zeros(self.total * STEP, np.float32)
        self.mask[self.slot] = 1
        self.row = np.repeat(np.arange(len(per_row)), self.blocks)
        last = self.total - self.span + 1
        self.valid = self.row[:last] == self.row[self.span - 1:]

    def columns(self, code: np.ndarray, padding: int) -> np.ndarray:
        """The column of every place in a table of different words."""
        out = np.full(self.total * STEP, padding, np.int64)
        out[self.slot] = code
        return out


def _sigmoid(x):
    return _sigmoid_of_half(0.5 * x)


def _sigmoid_of_half(x):
    return 0.5 * np.tanh(x) + 0.5


class Network:
    def __init__(self, vocabulary: np.ndarray, seed=7):
        rng = np.random.default_rng(seed)

        def small(*shape, scale=0.1):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary = np.sort(vocabulary)
        h = HIDDEN
        self.p = {
            "word": small(len(vocabulary) + 1, WORD_DIM), "char": small(1 << CHAR_BITS, CHAR_DIM, scale=0.05),
            "x": small(WORD_DIM + CHAR_DIM, 6 * h, scale=0.3), "xb": np.zeros(6 * h, np.float32),
            "uf": small(h, 3 * h, scale=0.3), "ub": small(h, 3 * h, scale=0.3),
            "nf": np.zeros(h, np.float32), "nb": np.zeros(h, np.float32),
            "v": small(2 * h), "w": small(2 * h, scale=0.3), "b": np.zeros(1, np.float32),
        }

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, ids, runs, first) -> np.ndarray:
        """Input vectors of words, given their character runs one after the other."""
        return np.concatenate([self.p["word"][ids], np.add.reduceat(self.p["char"][runs], first)], axis=1)

    def _pass(self, gates, mask, u, nb, keep=None):
        """One direction: gates [steps][windows, 3h]; hidden states in that order. keep gets what training needs."""
        h, out = np.zeros((len(mask[0]), HIDDEN), np.float32), []
        for a, m in zip(gates, mask):
            hu = h @ u
            zr = _sigmoid(a[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            inner = hu[:, 2 * HIDDEN:] + nb
            n = np.tanh(a[:, 2 * HIDDEN:] + r * inner)
            new = (n + z * (h - n)) * m[:, None]
            if keep is not None:
                keep.append((h, z, r, inner, n, m))
            h = new
            out.append(h)
        return out

    def _pool(self, forward, backward, mask):
        states = np.concatenate([np.stack(forward, 1), np.stack(backward[::-1], 1)], axis=2)
        energy = np.where(mask > 0, states @ self.p["v"], np.float32(-1e9))
        energy = np.exp(energy - energy.max(axis=1, keepdims=True)) * mask
        weight = energy / np.maximum(energy.sum(axis=1, keepdims=True), np.float32(1e-9))
        context = (weight[:, None, :] @ states)[:, 0]
        return states, weight, context, context @ self.p["w"] + self.p["b"][0]

    def _recurrent(self, side: str, scale: np.ndarray) -> np.ndarray:
        """What a state, followed by a one, adds to the gates of the next step, and its energy and value."""
        part = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, 2 * HIDDEN)
        out = np.zeros((3 * HIDDEN + 2, HIDDEN + 1), np.float32)
        out[:3 * HIDDEN, :HIDDEN] = self.p["u" + side].T * scale[:, None]
        out[2 * HIDDEN:3 * HIDDEN, HIDDEN] = self.p["n" + side] * scale[2 * HIDDEN:]
        out[3 * HIDDEN:, :HIDDEN] = self.p["v"][part], self.p["w"][part]
        return out

    def table(self, hash, runs, first) -> "Table":
        """What windows need of different words, given with their character runs one after the other."""
        out = np.zeros((len(hash) + 1, 6 * HIDDEN), np.float32)  # the last row is that of padding
        if len(hash):
            out[:-1] = self.inputs(self.word_ids(hash), runs, first) @ self.p["x"] + self.p["xb"]
        return Table(self, out)

    def text_logits(self, words: "Words") -> np.ndarray:
        """Per text the highest logit of its windows."""
        layout = Layout(words.per_row)
        code, own = words.different()
        return np.maximum.reduceat(self.table(*own).highest(layout.columns(code, len(own[0])), layout), layout.base)

    def scores(self, column) -> np.ndarray:
        """Probability that a text is of class 1, by its highest window."""
        data, offsets = text_bytes(lowered(column))
        out = np.empty(len(offsets) - 1, np.float64)
        for i, j in row_blocks(offsets, PIECE):
            begin, end = int(offsets[i]), int(offsets[j])
            if j - i == 1 and end - begin > PIECE:
                out[i] = max(float(self.text_logits(span)[0]) for span in word_spans(data[begin:end]))
            else:
                out[i:j] = self.text_logits(Words(data[begin:end], offsets[i:j + 1] - begin))
        return 1 / (1 + np.exp(-out))

    # --- training ------------------------------------------------------------------

    def gradients(self, ids, runs, first, lengths, slots, mask, label):
        """Gradients of the mean log loss over windows; slots [windows, WIDTH] index the given words, -1 is padding."""
        p, n = self.p, len(slots)
        x = self.inputs(ids, runs, first)
        g = np.where(slots[:, :, None] >= 0, (x @ p["x"] + p["xb"])[slots], 0).astype(np.float32)
        steps = [g[:, t] for t in range(WIDTH)]
        m = [mask[:, t] for t in range(WIDTH)]
        kept_f, kept_b = [], []
        forward = self._pass([s[:, :3 * HIDDEN] for s in steps], m, p["uf"], p["nf"], kept_f)
        backward = self._pass([s[:, 3 * HIDDEN:] for s in steps[::-1]], m[::-1], p["ub"], p["nb"], kept_b)
        states, weight, context, logit = self._pool(forward, backward, mask)
        d_logit = ((_sigmoid(logit) - label) / n).astype(np.float32)
        out = {"w": context.T @ d_logit, "b": np.array([d_logit.sum()], np.float32)}
        d_context = d_logit[:, None] * p["w"]
        d_weight = (states @ d_context[:, :, None])[:, :, 0]
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        out["v"] = np.einsum("nt,nth->h", d_energy, states)
        d_states = weight[:, :, None] * d_context[:, None, :] + d_energy[:, :, None] * p["v"]
        d_g = np.zeros_like(g)
        for side, kept, u, nb, order in (
            (slice(0, HIDDEN), kept_f, "uf", "nf", range(WIDTH)), (slice(HIDDEN, 2 * HIDDEN), kept_b, "ub", "nb", range(WIDTH - 1, -1, -1)),
        ):
            d_h, d_u, d_nb = np.zeros((n, HIDDEN), np.float32), np.zeros_like(p[u]), np.zeros(HIDDEN, np.float32)
            part = slice(0, 3 * HIDDEN) if side.start == 0 else slice(3 * HIDDEN, 6 * HIDDEN)
            for t, (h, z, r, inner, c, on) in reversed(list(zip(order, kept))):
                d = (d_h + d_states[:, t, side]) * on[:, None]
                d_c = d * (1 - z) * (1 - c * c)
                d_z = d * (h - c) * z * (1 - z)
                d_r = d_c * inner * r * (1 - r)
                d_inner = d_c * r
                d_hu = np.concatenate([d_z, d_r, d_inner], axis=1)
                d_u += h.T @ d_hu
                d_nb += d_inner.sum(axis=0)
                d_h = d * z + d_hu @ p[u].T
                d_g[:, t, part] = np.concatenate([d_z, d_r, d_c], axis=1)
            out[u], out[nb] = d_u, d_nb
        real = slots >= 0
        d_words = np.zeros((len(ids), 6 * HIDDEN), np.float32)
        np.add.at(d_words, slots[real], d_g[real])
        out["x"], out["xb"] = x.T @ d_words, d_words.sum(axis=0)
        d_x = d_words @ p["x"].T
        out["word"], out["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(out["word"], ids, d_x[:, :WORD_DIM])
        np.add.at(out["char"], runs, np.repeat(d_x[:, WORD_DIM:], lengths, axis=0))
        return out


@lru_cache(2)
def _curves(reach: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(-reach, reach + 1) / GRID
    return _sigmoid(at).astype(np.float32), np.tanh(at).astype(np.float32)


class Table:
    """A network's gates and first states of different words, one per column; the last column is padding.

    `logits` runs windows in full precision, `rough` with gates rounded to 1 / GRID, so that their curves are read from tables.
    `highest` runs every window roughly and those near a text's highest again in full, so texts get the greatest full logit.
    """

    def __init__(self, net: Network, gates: np.ndarray):
        h, self.net = HIDDEN, net
        half = np.concatenate([np.full(2 * h, 0.5, np.float32), np.ones(h, np.float32)])
        self.gates = np.ascontiguousarray((gates * np.tile(half, 2)).T)  # sigmoids are 0.5 * tanh(0.5 * x) + 0.5
        self.recurrent = {s: net._recurrent(s, np.full(3 * h, 0.5, np.float32)) for s in "fb"}
        self.first = {"f": self._first(self.gates[:3 * h], net.p["nf"]), "b": self._first(self.gates[3 * h:], net.p["nb"])}
        most = max(float(np.abs(r[:3 * h]).sum(axis=1).max()) for r in (net._recurrent(s, np.ones(3 * h, np.float32)) for s in "fb"))
        reach = (2 * most + 21) * GRID  # states lie between -1 and 1, so with gates within most + 20 no sum is further out
        self.curves = None
        if reach < 1 << 20 and np.isfinite(gates).all():
            self.curves = _curves(int(reach))
            centre = np.float32(int(reach) + 0.5)
            self.rough_gates = np.ascontiguousarray(np.clip(gates, -most - 20, most + 20).T) * np.float32(GRID) + centre
            self.rough_recurrent = {s: net._recurrent(s, np.full(3 * h, GRID, np.float32)) for s in "fb"}

    @staticmethod
    def _first(a, nb):
        """States after one word."""
        z, r = _sigmoid_of_half(a[:2 * HIDDEN].reshape(2, HIDDEN, -1))
        n = np.tanh(nb[:, None] * r + a[2 * HIDDEN:])
        out = (0 - n) * z + n
        out[:, -1] = 0
        return out

    def _side(self, side, words, gates, on, energy, value, rough):
        """One direction over windows, a window per column; adds what its states give to energies and values.

        words and gates give the first words and the gates at a step, on is 0 at padding (None: there is none).
        """
        h2, h3, m = 2 * HIDDEN, 3 * HIDDEN, energy.shape[1]
        recurrent = (self.rough_recurrent if rough else self.recurrent)[side]
        turn = range(WIDTH) if side == "f" else range(WIDTH - 1, -1, -1)
        whole = np.ones((HIDDEN + 1, m), np.float32)
        h, sums = whole[:HIDDEN], np.empty((h3 + 2, m), np.float32)
        zr, n = sums[:h2], sums[h2:h3]
        z, r = zr[:HIDDEN], zr[HIDDEN:]
        narrow, wide = np.empty((h2, m), np.int32), np.empty((h2, m), np.intp)

        def curve(which, x):
            np.copyto(narrow[:len(x)], x, casting="unsafe")
            np.copyto(wide[:len(x)], narrow[:len(x)])  # in two steps, both of which are vectorized
            np.take(self.curves[which], wide[:len(x)], out=x, mode="wrap")

        for t in turn:
            if t == turn[0]:
                np.take(self.first[side], words(t), axis=1, out=h, mode="wrap")
            else:
                a = gates(side, t)
                zr += a[:h2]
                if rough:
                    curve(0, zr)
                else:
                    np.tanh(zr, out=zr)
                    z *= np.float32(0.5)
                    z += np.float32(0.5)
                    r += np.float32(1)  # twice the gate, for half the sum
                n *= r
                n += a[h2:]
                if rough:
                    curve(1, n)
                else:
                    np.tanh(n, out=n)
                h -= n
                h *= z
                h += n
                if on is not None:
                    h *= on[t]
            np.matmul(recurrent, whole, out=sums)
            energy[t] += sums[h3]
            value[t] += sums[h3 + 1]

    def _run(self, m, words, gates, on, rough=False) -> np.ndarray:
        energy, value = np.zeros((WIDTH, m), np.float32), np.zeros((WIDTH, m), np.float32)
        for side in "fb":
            self._side(side, words, gates, on, energy, value, rough)
        if on is not None:
            energy = np.where(on > 0, energy, np.float32(-1e9))
        energy -= energy.max(axis=0)
        np.exp(energy, out=energy)
        if on is not None:
            energy *= on
        value *= energy
        return value.sum(axis=0) / np.maximum(energy.sum(axis=0), np.float32(1e-9)) + self.net.p["b"][0]

    def logits(self, index: np.ndarray, layout: "Layout", windows: np.ndarray) -> np.ndarray:
        """Logits of the given windows; index has the column of every word of the layout."""
        out, steps = np.empty(len(windows), np.float32), np.arange(WIDTH)[:, None]
        for i in range(0, len(windows), COLUMNS):
            some = windows[i:i + COLUMNS]
            some = some if len(some) > 1 else np.repeat(some, 2)  # BLAS sums a single column in another order
            at = some * STEP + steps
            on = layout.mask[at]
            found = self._run(len(some), lambda t: index[at[t]], lambda s, t: np.take(
                self.gates[:3 * HIDDEN] if s == "f" else self.gates[3 * HIDDEN:], index[at[t]], axis=1, mode="wrap"), None if on.all() else on)
            out[i:i + COLUMNS] = found[:len(windows) - i]
        return out

    def rough(self, index: np.ndarray, layout: "Layout") -> np.ndarray:
        """Rough logits of all windows, -inf where one would reach into the next text."""
        count = len(layout.valid)
        out = np.empty(count, np.float32)
        for i in range(0, count, COLUMNS):
            m = min(COLUMNS, count - i)
            by_step, mask = index[i * STEP:(i + m - 1) * STEP + WIDTH], layout.mask[i * STEP:(i + m - 1) * STEP + WIDTH]
            here = np.take(self.rough_gates, by_step, axis=1, mode="wrap")

            def at(t):
                return slice(t, t + (m - 1) * STEP + 1, STEP)

            on = None if mask.all() else [mask[at(t)] for t in range(WIDTH)]
            out[i:i + m] = self._run(m, lambda t: by_step[at(t)], lambda s, t: (here[:3 * HIDDEN] if s == "f" else here[3 * HIDDEN:])[:, at(t)],
                                     None if on is None else np.stack(on), rough=True)
        return np.where(layout.valid, out, np.float32(-np.inf))

    def highest(self, index: np.ndarray, layout: "Layout") -> np.ndarray:
        """Logits of the windows that can be a text's highest, -inf elsewhere."""
        out = np.full(len(layout.valid), -np.inf, np.float32)
        if self.curves is not None:
            rough = self.rough(index, layout)
            least = np.maximum.reduceat(rough, layout.base) - np.float32(MARGIN)
            near = np.flatnonzero(rough >= np.repeat(least, layout.blocks)[:len(rough)])
            out[near] = self.logits(index, layout, near)
            if np.abs(out[near] - rough[near]).max() < MARGIN / 4:
                return out
        every = np.flatnonzero(layout.valid)  # steep networks: nothing is left to the rough logits
        out[every] = self.logits(index, layout, every)
        return out


class _Adam:
    def __init__(self, params, rate):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.s = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads):
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.s[k] += 0.001 * (g * g - self.s[k])
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.s[k]) + 1e-8)).astype(np.float32)


def train(texts: list[str], labels: list[int], vocabulary=VOCABULARY, random_rounds=3, rounds=6, batch=64, rate=0.005,
          unknown=0.3, seed=7) -> Network:
    """Fits a network. A share of known words is read as unknown, so character runs have to carry them too."""
    rng = np.random.default_rng(seed)
    data, offsets = text_bytes(lowered(pa.array(texts, pa.string())))
    words = Words.of_all(data, offsets)
    layout = Layout(words.per_row)
    row_of_word = np.repeat(np.arange(len(texts)), words.per_row).astype(np.uint64)
    _, once = np.unique(mix64(words.hash + mix64(row_of_word)), return_index=True)  # of each text and word
    hashes, seen = np.unique(words.hash[once], return_counts=True)
    net = Network(hashes[np.argsort(-seen, kind="stable")[:vocabulary]], seed)
    ids = net.word_ids(words.hash)
    code, own = words.different()
    column = layout.columns(code, len(own[0]))
    word_at = np.full(layout.total * STEP, -1, np.int64)
    word_at[layout.slot] = np.arange(words.count)
    labels = np.asarray(labels, np.float32)
    windows = np.flatnonzero(layout.valid)
    adam = _Adam(net.p, rate)
    for epoch in range(random_rounds + rounds):
        if epoch < random_rounds:
            order = rng.permutation(windows)
            turn = np.argsort(layout.row[order], kind="stable")
            sorted_rows = layout.row[order][turn]
            nth = np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows)
            chosen = order[turn][nth < 4]
        else:
            logits = net.table(*own).highest(column, layout)
            best = np.array([b + int(logits[b:b + n].argmax()) for b, n in zip(layout.base, layout.windows)])
            second = best[layout.windows > 1]
            chosen = np.concatenate([best, np.clip(second + rng.choice([-1, 1], len(second)), layout.base[layout.row[second]],
                                                   (layout.base + layout.windows - 1)[layout.row[second]])[labels[layout.row[second]] == 0]])
        adam.rate = rate if epoch < random_rounds else rate * (random_rounds + rounds - epoch) / rounds
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch)):
            slots = word_at[part[:, None] * STEP + np.arange(WIDTH)]
            used, inverse = np.unique(slots[slots >= 0], return_inverse=True)
            if not len(used):
                continue
            local = np.full(slots.shape, -1, np.int64)
            local[slots >= 0] = inverse
            lengths = words.lengths[used]
            run, place = spread(lengths)
            known = np.where(rng.random(len(used)) < unknown, 0, ids[used])
            adam.step(net.gradients(known, words.runs[words.first[used][run] + place], np.cumsum(lengths) - lengths, lengths, local,
                                    (slots >= 0).astype(np.float32), labels[layout.row[part]]))
    return net
