"""Document fingerprints by consistent weighted sampling.

A document is its words with their counts as weights (A-Z lowered; the six ASCII white space characters
separate). For each of SAMPLES samples a word draws r, c from Gamma(2, 1) and b from [0, 1), all functions of word
and sample only. With t = floor(ln w / r + b) the word bids ln c - r (t - b) - r; the least bid wins, and the sample is
(word, t). Two documents agree in a sample with a probability equal to their generalised Jaccard similarity:
the sum of smaller over the sum of larger weights. Each sample is kept as 32 bits.

Defined results: NULL text is empty; a text without words has the sample 0 everywhere, like all other such texts
(likeness 1) and unlike others; repeated rows get equal fingerprints. In next_in_order, rows of one id are in descending
order of a 64-bit hash of the text, then by text; rows without id stand after all others, and a single row follows itself.
Other columns are not read; an empty frame gives an empty frame. Texts are used whole; a task holds a few texts and a table
of BIDS words' draws. Rows that share an id, or have none, are split by that hash; equal rows stay in one range.
"""

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.llm.columns import map_arrow, mix64, on_workers
from wardlog.llm.words import table

SAMPLES = 64
BIDS = 1 << 16  # words whose draws a worker remembers; forgotten together when full
BLOCK = 4096  # words of one text that bid at a time
RANGE_ROWS, MOST_RANGES, SAMPLED_IDS = 1_000, 20_000, 20
NO_ID = -(1 << 63)


class Sampler:
    """Draws and bids; the draws of a word are the same in every process."""

    def __init__(self, samples=SAMPLES, room=BIDS):
        self.samples, self.room = samples, room
        self.known: dict[bytes, int] = {}
        self.hash = np.zeros(room, np.uint64)
        self.r, self.b, self.c, self.single = (np.empty((room, samples), np.float32) for _ in range(4))
        self.salt = mix64(np.arange(1, 3 * samples + 1, dtype=np.uint64)).reshape(3, samples)

    def _learn(self, words: list[bytes]):
        at = np.arange(len(self.known), len(self.known) + len(words))
        self.known.update(zip(words, at.tolist()))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        self.hash[at] = hashes

        def unit(x):  # (0, 1) from 32 bits
            return (x.astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-32)

        def halves(k):
            x = mix64(hashes[:, None] ^ self.salt[k])
            return unit(x >> np.uint64(32)), unit(x & np.uint64(0xFFFFFFFF))

        (one, two), (three, four), (five, _) = halves(0), halves(1), halves(2)
        tiny = np.float32(1e-30)
        r = -np.log(np.maximum(one * two, tiny))
        c = np.log(-np.log(np.maximum(three * four, tiny)) + tiny)
        self.r[at], self.b[at], self.c[at] = r, five, c
        self.single[at] = c + r * five - r

    def _slots(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) + len(new) > self.room:
                self.known.clear()
                new = words
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def fingerprint(self, text: bytes) -> np.ndarray:
        counts = Counter(text.lower().split())
        if not counts:
            return np.zeros(self.samples, np.uint32)
        words, weights = list(counts), np.fromiter(counts.values(), np.float32, len(counts))
        best, winner, step = None, None, None
        every = np.arange(self.samples)
        for start in range(0, len(words), BLOCK):
            slots = self._slots(words[start:start + BLOCK])
            weight = weights[start:start + BLOCK]
            bids = self.single[slots]
            times = np.zeros(bids.shape, np.float32)
            many = np.flatnonzero(weight > 1)
            if len(many):
                s = slots[many]
                r, b = self.r[s], self.b[s]
                t = np.floor(np.log(weight[many])[:, None] / r + b)
                bids[many] = self.c[s] - r * (t - b) - r
                times[many] = t
            row = bids.argmin(axis=0)
            least, word, time = bids[row, every], self.hash[slots[row]], times[row, every]
            if best is None:
                best, winner, step = least, word, time
            else:
                better = least < best
                best, winner, step = np.where(better, least, best), np.where(better, word, winner), np.where(better, time, step)
        return (mix64(winner + mix64(step.astype(np.int64).view(np.uint64) + np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


_SAMPLER: list = []


def sampler() -> Sampler:
    """One per worker process."""
    if not _SAMPLER:
        _SAMPLER.append(Sampler())
    return _SAMPLER[0]


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    return float((one == two).mean())


def fingerprints(df: DataFrame, id="doc_id", text="text") -> DataFrame:
    """id and fingerprint (hexadecimal, eight digits per sample) of every row: a narrow map."""

    def run(batches):
        for batch in batches:
            found = [sampler().fingerprint(v.as_py() or b"").tobytes().hex() for v in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["id", "fingerprint"])

    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(rows, run, f"id {dict(rows.dtypes)['id']}, fingerprint string")


class Ranges:
    """Ranges of (id, hash), from a sorted sample of ids. An id that fills several ranges is heavy: the hashes of its texts,
    which are even, split it into as many. Other ids are never split, and their hash is taken as 0."""

    def __init__(self, sampled: np.ndarray, ranges: int):
        cuts = sampled[np.arange(1, ranges) * len(sampled) // ranges] if len(sampled) else sampled
        ids, parts = np.unique(cuts, return_counts=True)
        self.heavy = ids[parts > 1]
        self.ids = np.repeat(ids, parts)
        self.hashes = np.array([-(1 << 63) + (i << 64) // n if n > 1 else 0 for n in parts.tolist() for i in range(n)], np.int64)

    def of(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        own = np.searchsorted(self.ids, ids, side="right")
        for heavy in np.intersect1d(ids, self.heavy):
            rows = ids == heavy
            first, last = np.searchsorted(self.ids, heavy), np.searchsorted(self.ids, heavy, side="right")
            own[rows] = first + np.searchsorted(self.hashes[first:last], hashes[rows], side="right")
        return own.astype(np.int32)


def next_in_order(df: DataFrame, visit, schema: str, id="doc_id", text="text") -> DataFrame:
    """visit(rows) over (id, text, next text) in descending id; the last row is followed by the first.

    Rows are dealt to ranges of (id, hash) and sorted there, which moves every text once; the first row of a range is
    also sent to the range before it. Ranges come from a bounded sample of ids and only serve balance.
    """
    spark = df.sparkSession
    on_workers(spark)
    key, full = F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NO_ID)), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keys = df.select(key.alias("key"))
    rows = keys.count()
    ranges = max(1, min(MOST_RANGES, -(-rows // RANGE_ROWS)))
    share = min(1.0, SAMPLED_IDS * ranges / max(1, rows))
    sampled = np.sort(np.array([r[0] for r in (keys.sample(share, 1) if share < 1 else keys).collect()], np.int64))
    dealer = Ranges(sampled, ranges)
    # texts are only read here where an id is heavy
    spot = F.when(key.isin(dealer.heavy.tolist()), F.xxhash64(full)).otherwise(F.lit(0)) if len(dealer.heavy) else F.lit(0)
    spot = spot.cast("long").alias("spot")

    @F.pandas_udf("int")
    def range_of(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(dealer.of(k.to_numpy(), h.to_numpy()))

    places = df.select(key.alias("key"), spot).withColumn("range", range_of("key", "spot"))
    spots = {}
    if len(dealer.heavy):  # at most a row per range of a heavy id
        heavy = places.filter(F.col("key").isin(dealer.heavy.tolist()))
        spots = {(r[0], r[1]): r[2] for r in heavy.groupBy("range", "key").agg(F.max("spot")).collect()}
    heads = sorted((r[0], (r[1], spots.get((r[0], r[1]), 0))) for r in places.groupBy("range").agg(F.max("key")).collect())
    also = {place: heads[(i + 1) % len(heads)][0] for i, (_, place) in enumerate(heads)}  # one row per range

    @F.pandas_udf("array<int>")
    def ranges_of(k: pd.Series, h: pd.Series) -> pd.Series:
        own = dealer.of(k.to_numpy(), h.to_numpy())
        return pd.Series([[o] if x not in also else [o, -1 - also[x]] for o, x in zip(own.tolist(), zip(k.tolist(), h.tolist()))])

    dealt = df.select(F.col(f"`{id}`").cast("long").alias("id"), key.alias("key"), spot, full.alias("text"))
    dealt = dealt.select("id", "key", "text", F.explode(ranges_of("key", "spot")).alias("to")).select(
        "id", "key", "text",
        F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("range"), (F.col("to") < 0).alias("follows"))
    ordered = dealt.repartition("range").sortWithinPartitions("range", "follows", F.desc("key"), F.desc(F.xxhash64("text")), "text")

    def run(batches):
        waiting = None
        for batch in batches:
            done = []
            for id, range, follows, text in zip(
                    batch.column("id").to_pylist(), batch.column("range").to_pylist(), batch.column("follows").to_pylist(), batch.column("text")):
                text = text.as_py()
                if waiting is not None and waiting[1] == range:
                    done.append((waiting[0], waiting[2], text))
                    waiting = None
                if not follows:
                    waiting = id, range, text
            yield from visit(done)

    return map_arrow(ordered.select("id", "range", "follows", "text"), run, schema)


def op5_fingerprints(spark, sf_dir):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def visit(rows):
        last, last_print, out = None, None, []
        for id, text, following in rows:
            half = len(text) // 2
            edited = (text[:len(text) - half] + following[:half]).encode()
            own = last_print if last is text else sampler().fingerprint(text.encode())
            last, last_print = following, sampler().fingerprint(following.encode())
            changed = sampler().fingerprint(edited)
            out.append((id, len(text), hashlib.sha256(edited).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(),
                        likeness(own, changed), likeness(own, last_print)))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names=names)

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return next_in_order(table(spark, sf_dir, "documents"), visit, schema)
