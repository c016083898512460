"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

1. Each text becomes the set of its word shingles' 64-bit hashes. Sets are collapsed by a 128-bit key: copies
   are one node with a number of its own, however many rows there are. Nodes whose rows share an id are linked.
2. All signature coordinates of a set come from two permutations, one of them circularly shifted. Rows of
   coordinates make band keys; nodes that share a key are candidates.
3. Buckets hold nodes of any number, so pairs are formed sparingly: every node is compared with its bucket's
   first node, links give components, and components are compared with the bucket's first component. Buckets that
   still hold several components are searched in full, in blocks: two nodes of different components are a
   pair if they share MIN_SHARED bands. Blocks with many pairs are verified whole, inside one task. A pair inside a
   component cannot change a result.
4. Every pair is verified on both full sets; components of the links are found by contraction.

A pair of likeness 0.8 is missed with probability below 1e-6; a group is found through any of its links.

Defined results: NULL, empty and blank texts have an empty set and are linked with nothing; rows that share
an id are one document, linked where any of its texts is, with one component; rows without an id are linked with nothing and kept, with
component NULL; other columns of the frame are not read; an empty frame gives an empty frame. Texts are used
whole; a task holds one text and its set, or a block of band keys.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.llm.columns import map_arrow, mix64, on_workers, text_bytes
from wardlog.llm.graph import components
from wardlog.llm.words import WORD, table
from wardlog.session import join_side, materialize

DOMAIN_BITS = 20
BANDS, ROWS, MIN_SHARED = 56, 6, 2
PERCENT = 80
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21  # nodes of a bucket, and their shingles, that one task compares with as many others
DENSE = 2  # pairs per member above which a block is verified as a whole
SEED = 20_241


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted different hashes of a text's k-word shingles; of all words together if there are fewer.

    A-Z are lowered; the six ASCII white space characters separate words, which is what bytes.split does.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(words))
    n = len(words) - k + 1
    out = mix64(hashes[:n] + np.uint64(k))
    for j in range(1, k):
        out = mix64(out + hashes[j:j + n])
    return np.unique(out)


class Circulant:
    """MinHash coordinates from two permutations: one places the shingles, one circularly shifted step by step ranks them."""

    def __init__(self, size: int, bits=DOMAIN_BITS, seed=SEED):
        rng = np.random.default_rng(seed)
        self.mask = np.uint64((1 << bits) - 1)
        self.odd, self.bits = np.uint64(rng.integers(1 << 62) * 2 + 1), bits
        ranks = rng.permutation(1 << bits).astype(np.uint32)
        around = np.concatenate([ranks, ranks[:size]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(around, size)

    def place(self, shingles: np.ndarray) -> np.ndarray:
        """The first permutation: an odd product and a shifted xor are bijections of the domain."""
        x = (shingles & self.mask) * self.odd & self.mask
        x ^= x >> np.uint64(self.bits // 2)
        return (x * self.odd & self.mask).astype(np.int64)

    def signature(self, shingles: np.ndarray, block=2048) -> np.ndarray:
        """Coordinate k is the least rank of the places shifted by k."""
        places, least = self.place(shingles), None
        for start in range(0, len(places), block):
            part = self.shifted[places[start:start + block]].min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return least


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = mix64(np.arange(bands, dtype=np.uint64) + np.uint64(1))
    for part in signature.reshape(bands, rows).T:
        keys = mix64(keys + part.astype(np.uint64))
    return keys.view(np.int64)


_CIRCULANT: dict = {}


def circulant(size: int) -> Circulant:
    """One per worker process."""
    if size not in _CIRCULANT:
        _CIRCULANT[size] = Circulant(size)
    return _CIRCULANT[size]


def signed(df: DataFrame, id, text, k, bands=BANDS, rows=ROWS) -> DataFrame:
    """id, size of the set, 128-bit key of the set, band keys (none for an empty set)."""

    def sign(batches):
        hasher = circulant(bands * rows)
        for batch in batches:
            sizes, keys, buckets = [], [], []
            for value in batch.column(1).cast(pa.binary()):
                s = shingle_set(value.as_py() or b"", k)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                buckets.append(band_keys(hasher.signature(s), bands, rows) if len(s) else [])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(buckets, pa.list_(pa.int64())),
            ], names=["id", "size", "key", "buckets"])

    return map_arrow(df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")),
                     sign, "id long, size long, key binary, buckets array<long>")


def _sets(df: DataFrame, id, text, k, candidates: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """node, set: the full sets of the candidates (node, first, key), one each, stored once.

    The id of a node's first row says which text it is, unless the id is repeated; then the different texts' keys do.
    """

    def build(batches):
        for batch in batches:
            found = [shingle_set(v.as_py() or b"", k).tobytes() for v in batch.column(1).cast(pa.binary())]
            keys = [xxhash.xxh3_128_digest(s) for s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(found, pa.binary())], names=["of", "key", "set"])

    texts = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    single = candidates.select(F.col("first").alias("id"), "node", "key")
    if repeated is not None:
        several = materialize(single.join(repeated, "id", "left_semi"))
        single = materialize(single.join(repeated, "id", "left_anti"))
    built = "of long, key binary, set binary"
    sets = map_arrow(texts.join(join_side(single.select("id", "node")), "id").select("node", "text"), build, built).select(F.col("of").alias("node"), "set")
    if repeated is not None:
        different = texts.join(join_side(materialize(several.select("id").distinct())), "id", "left_semi").distinct()
        of_keys = map_arrow(different.select("id", "text"), build, built).join(join_side(several.select("node", "key")), "key")
        sets = sets.union(of_keys.dropDuplicates(["node"]).select("node", "set"))
    return materialize(sets)


def _one_id(known: DataFrame, nodes: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between the nodes of a repeated id, and the least node of each such id."""
    members = materialize(known.select("id", "key").join(join_side(repeated), "id", "left_semi").join(nodes, "key").select("id", "node").distinct())
    least = materialize(members.groupBy("id").agg(F.min("node").alias("a")))
    return materialize(members.join(join_side(least), "id").filter("a <> node").select("a", F.col("node").alias("b"))), least


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike."""

    def verify(batches):
        for batch in batches:
            found = []
            for one, two in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(two.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                found.append(100 * shared >= percent * (len(x) + len(y) - shared))
            keep = pa.array(found, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    first = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    both = first.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    return map_arrow(both.select("a", "b", "set_a", "set_b"), verify, "a long, b long")


def _labelled(crowded: DataFrame, labels: DataFrame | None) -> DataFrame:
    """crowded with each node's component, where a bucket holds more than one."""
    if labels is not None:
        crowded = crowded.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    else:
        crowded = crowded.withColumn("component", F.col("node"))
    mixed = crowded.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"), F.sum("size").alias("total")
    ).filter("low < high").drop("high")
    return crowded.join(mixed, "bucket")


def _to_first(crowded: DataFrame, percent: int) -> DataFrame:
    """One pair for each component and the first component of a bucket they share."""
    per = crowded.groupBy("bucket", "low", "component").agg(F.min(F.struct("node", "size")).alias("x"))
    first = per.filter("component = low").select("bucket", F.col("x").alias("y"))
    pairs = per.filter("component <> low").join(first, "bucket").groupBy("component", "low").agg(
        F.min(F.struct("x", "y")).alias("p"))
    return pairs.select(
        F.col("p.x.node").alias("a"), F.col("p.y.node").alias("b"), F.col("p.x.size").alias("n"), F.col("p.y.size").alias("m")
    ).filter(_sizes_allow(percent)).select("a", "b")


def _sizes_allow(percent: int):
    return F.least("n", "m") * 100 >= F.greatest("n", "m") * percent


class _Blocks:
    """Members of two blocks of a bucket, and the pairs of them to be compared: of different components, of
    allowed sizes, with MIN_SHARED common bands, this bucket being the first of them."""

    def __init__(self, key, rows: pa.Table, percent: int):
        self.bucket, self.i, self.j = (k.as_py() for k in key)
        order = np.argsort(rows.column("node").to_numpy())
        self.order, self.percent = order, percent
        self.node, self.size, self.own, self.component = (rows.column(c).to_numpy()[order] for c in ("node", "size", "own", "component"))
        self.bands = np.array(rows.column("buckets").to_pylist(), np.int64)[order]

    def pairs(self):
        """(member, its partners) for every member outside the largest component."""
        kinds, counts = np.unique(self.component, return_counts=True)
        largest = kinds[counts.argmax()]
        for x in np.flatnonzero(self.component != largest):
            fit = (self.component != self.component[x]) & ((self.component == largest) | (np.arange(len(self.node)) > x))
            fit &= np.minimum(self.size, self.size[x]) * 100 >= np.maximum(self.size, self.size[x]) * self.percent
            if self.i != self.j:
                fit &= self.own != self.own[x]
            near = np.flatnonzero(fit)
            if len(near):
                same = self.bands[near] == self.bands[x]
                first = self.bands[x][same.argmax(axis=1)] == self.bucket
                near = near[first & (same.sum(axis=1) >= MIN_SHARED)]
                if len(near):
                    yield int(x), near


MEMBER = "bucket long, i int, j int, own int, node long, size long, component long"


def _across(crowded: DataFrame, keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links between all pairs of different components that share MIN_SHARED bands.

    A bucket of many members is dealt to blocks by a hash; each task compares two blocks. Where pairs are few they
    are given out and verified singly. Where they are many (more than DENSE per member, as between a large group
    and texts just below the threshold), the sets of the members are brought together and verified inside
    the task, which gives out links only. Both ways compare the same pairs.
    """
    on_workers(crowded.sparkSession)
    by_count = F.ceil(F.col("members") / BLOCK)
    by_size = F.ceil(F.col("total") / BLOCK_SHINGLES)
    dealt = crowded.withColumn("parts", F.greatest(by_count, by_size).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "size", "component")

    def compare(key, rows):
        block = _Blocks(key, rows, percent)
        found = list(block.pairs())
        if found and sum(len(near) for _, near in found) > DENSE * len(block.node):
            taken = np.unique(np.concatenate([*(near for _, near in found), np.array([x for x, _ in found])]))
            kept = rows.take(pa.array(block.order[taken])).drop_columns(["buckets"])
            none = pa.nulls(len(taken), pa.int64())
            return kept.append_column("a", none).append_column("b", none)
        a = np.concatenate([np.empty(0, np.int64), *(block.node[near] for _, near in found)])
        b = np.concatenate([np.empty(0, np.int64), *(np.full(len(near), block.node[x]) for x, near in found)])
        empty = rows.slice(0, 0).drop_columns(["buckets"])
        columns = {n: pa.nulls(len(a), empty.schema.field(n).type) for n in empty.column_names}
        return pa.table({**columns, "a": a, "b": b})

    def verify(key, rows):
        block, links = _Blocks(key, rows, percent), []
        raw = rows.column("set").combine_chunks().take(pa.array(block.order))
        values, offsets = text_bytes(raw)
        values, offsets = values.view(np.uint64), offsets // 8
        _, ids = np.unique(values, return_inverse=True)
        mark = np.zeros(int(ids.max()) + 1, bool)
        group = {c: c for c in block.component.tolist()}

        def root(c):
            while group[c] != c:
                c = group[c]
            return c

        for x, near in block.pairs():
            own = ids[offsets[x]:offsets[x + 1]]
            mark[own] = True
            shared = np.add.reduceat(mark[ids], offsets[:-1])[near]
            mark[own] = False
            alike = near[100 * shared >= percent * (block.size[near] + block.size[x] - shared)]
            for y in alike.tolist():  # one link joins two components; more would change nothing
                one, two = root(int(block.component[x])), root(int(block.component[y]))
                if one != two:
                    group[one] = two
                    links.append((block.node[y], block.node[x]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    found = materialize(dealt.join(keys, "node").groupBy("bucket", "i", "j").applyInArrow(
        lambda key, rows: compare(key, rows).select([*(c.split()[0] for c in MEMBER.split(", ")), "a", "b"]), f"{MEMBER}, a long, b long"))
    single = _links(found.where("a IS NOT NULL").select("a", "b"), sets, percent)
    dense = found.where("a IS NULL").drop("a", "b").join(keys, "node").join(sets, "node")
    return single.union(dense.groupBy("bucket", "i", "j").applyInArrow(verify, "a long, b long"))


def near_duplicates(df: DataFrame, id="doc_id", text="text", shingle=5, percent=PERCENT) -> DataFrame:
    """id, n_shingles, component_id (smallest id that links reach) and kept, for every row."""
    rows = materialize(signed(df, id, text, shingle))
    known = rows.filter("size > 0 AND id IS NOT NULL")
    firsts = materialize(known.groupBy("key").agg(
        F.min("id").alias("first"), F.first("size").alias("size"), F.first("buckets").alias("buckets")
    ).withColumn("node", F.monotonically_increasing_id()))
    nodes = firsts.select("key", "node", "first")
    repeated = materialize(rows.filter("id IS NOT NULL").groupBy("id").count().filter("count > 1").select("id"))
    repeated = None if repeated.isEmpty() else repeated
    in_buckets = firsts.select("node", "size", F.explode("buckets").alias("bucket"))
    shared = in_buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    crowded = materialize(in_buckets.join(shared.select("bucket"), "bucket"))
    candidates = materialize(nodes.join(crowded.select("node").distinct(), "node", "left_semi"))
    sets = _sets(df, id, text, shingle, candidates, repeated)
    links, labels = None, None
    if repeated is not None:
        links, of_ids = _one_id(known, nodes, repeated)
        labels = components(links)
    for round in range(3):
        mixed = _labelled(crowded, labels)
        if round < 2:
            found = materialize(_links(_to_first(mixed, percent), sets, percent))
        else:
            keys = firsts.join(candidates, "node", "left_semi").select("node", "buckets")
            found = materialize(_across(mixed, keys, sets, percent))
        links = found if links is None else links.union(found)
        labels = components(links)
    linked = labels.join(nodes.select("node", "first"), "node")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    named = materialize(linked.join(least, "component").select("node", F.col("least").alias("component")))
    placed = rows.select("id", "size", "key").join(nodes, "key", "left")
    if repeated is not None:  # a row without words goes with the others of its id
        blank = rows.filter("size = 0 AND id IS NOT NULL").select("id", "size", "key").join(
            join_side(of_ids.withColumnRenamed("a", "node")), "id", "left").join(nodes.select("node", "first"), "node", "left")
        names = ["id", "size", "node", "first"]
        placed = placed.filter("size > 0 OR id IS NULL").select(names).union(blank.select(names))
    placed = placed.join(named, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "first", "id"))
    return placed.select(
        "id", F.col("size").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def without_near_duplicates(df: DataFrame, id="doc_id", text="text", **options) -> DataFrame:
    """The rows of df, all columns, of one document of each group."""
    judged = materialize(near_duplicates(df, id, text, **options))
    gone = materialize(judged.filter(~F.col("kept")).select(F.col("id").alias("id of a copy")).distinct())
    kept = df.join(join_side(gone), F.col(f"`{id}`").cast("long") == F.col("id of a copy"), "left_anti")
    repeated = judged.filter("kept AND id IS NOT NULL").groupBy("id").count().filter("count > 1")
    if repeated.isEmpty():
        return kept
    return kept.filter(F.col(f"`{id}`").isNotNull()).dropDuplicates([id]).union(kept.filter(F.col(f"`{id}`").isNull()))


def op3_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2).withColumnRenamed("id", "doc_id")


SQL = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
            ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
        FROM texts)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
    WHERE 100 * common >= {PERCENT} * (p.n + q.n - common)
),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least_id USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
