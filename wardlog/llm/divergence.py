"""How far sources of a language differ in their words, by a quadtree over the matrix of sources and terms.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased; a language keeps those in at least MIN_DOCS of its
documents. A group (a source of a language) and the language itself give each kept term the smoothed share
p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), and a term separates p from q by floor((p - q)^2 / (p + q)).

For pairs of groups the matrix is dealt into blocks of columns (by a hash of the term) and tiles of TILE groups. A task
builds the quadtree of a block, columns with equal support next to each other, and walks it once for all pairs of
its groups: where the quadrants of both groups are all zero, the number of columns times the separation of two zero counts is the
price of the whole quadrant; where one is not, it descends, down to leaves that are compared cell by cell. Terms
without a count in a tile never reach its blocks; they are priced when the blocks' sums are added up. A block holds
BLOCK_ENTRIES counts on average, whatever the corpus; the number of blocks follows the counts.

Defined results: NULL text, language or source are ''; every occurring group has its rows in part `pair` (value 0 where
no term is kept), also groups without a term; repeated rows are documents of their own; ties in value are ranked by the
UTF-8 bytes of the item; other columns are not read, so their names cannot clash; an empty frame gives an empty frame.
Integers are 64 bits wide, enough while a group has fewer than 9e15 words.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog.llm.columns import map_arrow, mix64, on_workers, strings, text_bytes
from wardlog.llm.words import table
from wardlog.session import join_side, materialize

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
BLOCK_ENTRIES = 200_000  # counts of a block of columns, on average
TILE = 256  # groups of a tile
LEAF = 3  # leaves are 8 x 8
CELLS = 1 << 21  # cells compared at a time
HELD_ROWS = 500_000  # partial counts a task holds before it hands them on

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


# --- counts ----------------------------------------------------------------------------

def _terms(column) -> tuple[pa.Array, np.ndarray]:
    """All terms of a column of texts, and the row of each."""
    data, offsets = text_bytes(column)
    inside = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    lengths = np.flatnonzero(end) + 1 - starts
    letters = data[inside]
    letters += ((letters >= 65) & (letters < 91)).astype(np.uint8) * np.uint8(32)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return strings(letters, np.concatenate([[0], np.cumsum(lengths)])), row


def _merged(parts: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False)
    return whole.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["lang", "source", "term", "n", "docs"])


def term_counts(df: DataFrame, text="text", lang="lang", source="source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it). Each group also has a row without a term."""
    read = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])

    def run(batches):
        held = []
        for batch in batches:
            terms, row = _terms(batch.column(2))
            coded = terms.cast(pa.string()).dictionary_encode()
            per = pa.table({"row": row, "code": coded.indices}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
            at = per["row"].combine_chunks()
            counted = pa.table({
                "lang": batch.column(0).take(at), "source": batch.column(1).take(at), "term": coded.dictionary.take(per["code"].combine_chunks()),
                "n": per["count_all"].cast(pa.int64()), "docs": pa.array(np.ones(len(at), np.int64)),
            })
            rows = batch.num_rows
            present = pa.table({"lang": batch.column(0), "source": batch.column(1), "term": pa.nulls(rows, pa.string()),
                                "n": pa.array(np.zeros(rows, np.int64)), "docs": pa.array(np.zeros(rows, np.int64))})
            held.append(_merged([counted, present]))
            if sum(map(len, held)) > 2 * HELD_ROWS:
                held = [_merged(held)]
                if len(held[0]) > HELD_ROWS:
                    yield from held.pop().to_batches(max_chunksize=10_000)
        if held:
            yield from _merged(held).to_batches(max_chunksize=10_000)

    rows = map_arrow(read, run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, min_docs=MIN_DOCS) -> DataFrame:
    """Counts of kept terms, with the language's count; `first` marks one row of each term of a language.

    The window holds the sources of a language that use one term.
    """
    of_term = W.partitionBy("lang", "term")
    return counts.filter(F.col("term").isNotNull()).select(
        "lang", "source", "term", "n", F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("lang_n"),
        (F.row_number().over(of_term.orderBy("source")) == 1).alias("first"),
    ).filter(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, whole: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (whole + 2 kept)) as a long; NULL where nothing is kept."""
    over = F.call_function("div", (count + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)"),
                           F.nullif(whole + 2 * kept, F.lit(0)).cast("decimal(19,0)"))
    return over.cast("long") + 1


def separation(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def group_totals(counts: DataFrame, kept: DataFrame, tile=TILE) -> DataFrame:
    """Per group: its number in the language, its words and the language's (kept terms only), the kept terms, tiles.

    The window holds the groups of a language, of which every pair is a row of the result.
    """
    groups = counts.filter(F.col("term").isNull()).select("lang", "source")
    words = kept.groupBy(F.col("lang").alias("of_lang"), F.col("source").alias("of_source")).agg(
        F.sum("n").alias("words"), F.count_if("first").alias("v"))
    own = F.coalesce(F.col("words"), F.lit(0))
    language = W.partitionBy("lang")
    return groups.join(words, (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source")), "left").select(
        "lang", "source", own.alias("words"), (F.row_number().over(language.orderBy("source")) - 1).alias("number"),
        F.sum(own).over(language).alias("lang_words"), F.sum(F.coalesce(F.col("v"), F.lit(0))).over(language).alias("v"),
        F.ceil(F.count(F.lit(1)).over(language) / tile).cast("int").alias("tiles"),
    )


# --- the quadtree of a block --------------------------------------------------------------

def _share(count, denominator):
    """The share in 64-bit integers, by long division in steps of a thousand."""
    out, rest = np.divmod(count + 2, denominator)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, denominator)
        out = out * 1000 + digit
    return out + 1


class Quadtree:
    """Which quadrants of a matrix hold a count, level by level; level 0 is the leaves."""

    def __init__(self, row, column, rows, columns):
        self.columns = columns
        side = max(rows, columns, 1)
        self.height = max(0, int(side - 1).bit_length() - LEAF)
        self.levels = []
        for level in range(self.height + 1):
            bits = LEAF + level
            width = (columns >> bits) + 1
            self.levels.append((width, np.unique((row >> bits) * width + (column >> bits))))

    def holds(self, level, row, column):
        """Place of the node among the nodes of its level, -1 where the quadrant is all zero."""
        width, keys = self.levels[level]
        key = row * width + column
        at = np.searchsorted(keys, key)
        found = (column < width) & (at < len(keys))
        found[found] = keys[at[found]] == key[found]
        return np.where(found, at, -1)

    def width_of(self, level, column):
        """Columns of the matrix inside a node."""
        size = 1 << (LEAF + level)
        return np.clip(self.columns - column * size, 0, size)


def compare_groups(row, column, count, denominator, columns) -> np.ndarray:
    """Sum of the separations over the columns, for all pairs of rows; exact."""
    rows = len(denominator)
    zero = _share(np.zeros(rows, np.int64), denominator)
    size = 1 << LEAF
    padded = -(-rows // size) * size
    base = np.concatenate([zero, np.ones(padded - rows, np.int64)])
    out, zeros = np.zeros((padded, padded), np.int64), np.zeros((padded, padded), np.int64)
    support = np.zeros(columns, np.uint64)  # of each column, a number for the set of its leaf rows
    met = np.unique(column * padded + (row >> LEAF))
    np.add.at(support, met // padded, mix64((met % padded + 1).astype(np.uint64)))
    place = np.empty(columns, np.int64)
    place[np.argsort(support, kind="stable")] = np.arange(columns)
    column = place[column]
    tree = Quadtree(row, column, rows, columns)

    width, keys = tree.levels[0]
    leaves = np.repeat(base[(keys // width)[:, None] * size + np.arange(size)][:, :, None], size, axis=2)
    leaf = np.searchsorted(keys, (row >> LEAF) * width + (column >> LEAF))
    leaves[leaf, row % size, column % size] = _share(count, denominator[row])

    i = j = c = np.zeros(1, np.int64)
    for level in range(tree.height, -1, -1):
        left, right = tree.holds(level, i, c), tree.holds(level, j, c)
        bare = (left < 0) & (right < 0)
        bits = LEAF + level
        of_row = np.arange(padded) >> bits
        priced = np.zeros((of_row[-1] + 1, of_row[-1] + 1), np.int64)  # columns of bare quadrants, by pair of nodes
        np.add.at(priced, (i[bare], j[bare]), tree.width_of(level, c[bare]))
        zeros += priced[of_row][:, of_row]
        i, j, c, left, right = (x[~bare] for x in (i, j, c, left, right))
        if level == 0:
            break
        step = np.arange(8)
        i, j, c = ((x[:, None] * 2 + (step >> s & 1)).ravel() for x, s in ((i, 2), (j, 1), (c, 0)))
        edge = LEAF + level - 1
        inside = (i <= j) & (j << edge < padded) & (tree.width_of(level - 1, c) > 0)
        i, j, c = i[inside], j[inside], c[inside]

    grid = out.reshape(padded // size, size, padded // size, size)
    for start in range(0, len(i), max(1, CELLS // size**3)):
        part = slice(start, start + max(1, CELLS // size**3))
        ri, rj, ci, a, b = i[part], j[part], c[part], left[part], right[part]

        def cells(node, block):
            bare = base.reshape(-1, size)[block][:, :, None]
            return np.where((node >= 0)[:, None, None], leaves[np.maximum(node, 0)], bare)

        p, q = cells(a, ri)[:, :, None, :], cells(b, rj)[:, None, :, :]
        f = (p - q) ** 2 // (p + q)
        f *= (np.arange(size) < tree.width_of(0, ci)[:, None])[:, None, None, :]
        np.add.at(grid, (ri, slice(None), rj), f.sum(axis=3))
    p, q = base[:, None], base[None, :]
    out += zeros * ((p - q) ** 2 // (p + q))
    return out[:rows, :rows]


def _block(found: pa.Table, tile: int) -> pa.Table:
    """Sums over the columns of one block for all pairs of its groups."""
    terms = found["term"].combine_chunks()
    header = terms.is_null().to_numpy(zero_copy_only=False)
    number = found["number"].to_numpy().astype(np.int64)
    groups, first = np.unique(number[header], return_index=True)
    denominator = found["denominator"].to_numpy()[header][first]
    coded = terms.filter(pa.array(~header)).dictionary_encode()
    columns = len(coded.dictionary)
    tile_i, tile_j = (found[c][0].as_py() for c in ("tile_i", "tile_j"))
    g, h = np.triu_indices(len(groups), 1)
    if columns:
        row = np.searchsorted(groups, number[~header])
        sums = compare_groups(row, coded.indices.to_numpy().astype(np.int64), found["n"].to_numpy()[~header].astype(np.int64), denominator, columns)
        value = sums[g, h]
    else:
        value = np.zeros(len(g), np.int64)
    if tile_i != tile_j:  # pairs inside one tile belong to another block
        between = groups[g] // tile != groups[h] // tile
        g, h, value = g[between], h[between], value[between]
    return pa.table({"lang": pa.array([found["lang"][0].as_py()] * len(g), pa.string()), "g": groups[g], "h": groups[h],
                     "value": value, "columns": np.full(len(g), columns)})


# --- the audit --------------------------------------------------------------------------

def pair_divergence(kept: DataFrame, totals: DataFrame, blocks=1, tile=TILE) -> DataFrame:
    """lang, source, item, value for all ordered pairs of different sources of a language."""
    spark = kept.sparkSession
    on_workers(spark)
    denominator = (F.col("words") + 2 * F.col("v")).alias("denominator")
    known = totals.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "number", denominator, "tiles")
    partners = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("partner")
    own = F.floor(F.col("number") / tile).cast("int")
    counts = kept.join(join_side(known), (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source"))).select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"), "number", "denominator", "term", "n", partners)
    headers = known.select("of_lang", "number", "denominator", "tiles", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).select(
        F.col("of_lang").alias("lang"), "block", "number", "denominator", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), partners)
    dealt = counts.unionByName(headers).withColumns({"tile_i": F.least(own, "partner"), "tile_j": F.greatest(own, "partner")}).drop("partner")
    sums = dealt.groupBy("lang", "block", "tile_i", "tile_j").applyInArrow(lambda found: _block(found, tile), "lang string, g long, h long, value long, columns long")
    sums = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns"))
    side = totals.select("lang", "source", F.col("number").cast("long").alias("number"), "v", share(F.lit(0).cast("long"), F.col("words"), F.col("v")).alias("zero"))

    def named(name):
        return join_side(side.select(F.col("lang").alias(f"lang_{name}"), F.col("number").alias(f"number_{name}"),
                                     F.col("source").alias(f"source_{name}"), F.col("zero").alias(f"zero_{name}"),
                                     *([F.col("v").alias("v")] if name == "g" else [])))

    both = sums.join(named("g"), (F.col("lang") == F.col("lang_g")) & (F.col("g") == F.col("number_g"))).join(
        named("h"), (F.col("lang") == F.col("lang_h")) & (F.col("h") == F.col("number_h")))
    absent = F.coalesce((F.col("v") - F.col("columns")) * separation(F.col("zero_g"), F.col("zero_h")), F.lit(0))
    both = both.withColumn("value", F.col("value") + absent)
    sides = F.array(*[F.struct(F.col(f"source_{a}").alias("source"), F.col(f"source_{b}").alias("item")) for a, b in ("gh", "hg")])
    return both.select("lang", F.explode(sides).alias("s"), "value").select("lang", "s.source", "s.item", "value")


def term_divergence(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a source has more often than its language."""
    known = totals.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "words", "lang_words", "v")
    joined = kept.join(join_side(known), (F.col("lang") == F.col("of_lang")) & (F.col("source") == F.col("of_source")))
    shares = joined.filter("n > 0").select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("words"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_words"), F.col("v")).alias("q"))
    return shares.filter("p > q").select("lang", "source", "item", separation(F.col("p"), F.col("q")).alias("value"))


def divergence_audit(df: DataFrame, text="text", lang="lang", source="source", min_docs=MIN_DOCS, top=TOP,
                     block_entries=BLOCK_ENTRIES, tile=TILE) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank."""
    counts = materialize(term_counts(df, text, lang, source))
    kept = materialize(kept_counts(counts, min_docs))
    totals = materialize(group_totals(counts, kept, tile))
    blocks = max(1, -(-kept.count() // block_entries))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(found, part):
        return found.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(order).alias("rank"))

    terms = ranked(term_divergence(kept, totals), "term").filter(F.col("rank") <= top)
    return ranked(pair_divergence(kept, totals, blocks, tile), "pair").unionByName(terms)


def op13_source_divergence(spark, sf_dir):
    return divergence_audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
),
t AS (
    SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT row) >= {MIN_DOCS}),
languages AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
found AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
sized AS (
    SELECT g.lang, g.source, coalesce(s.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM found GROUP BY ALL) s ON g.lang = s.lang AND g.source = s.source
),
grid AS (
    SELECT s.lang, s.source, k.term, coalesce(f.n, 0) AS n, 1 + {SCALE}::HUGEINT * (coalesce(f.n, 0) + 2) // (s.n + 2 * l.v) AS p,
        1 + {SCALE}::HUGEINT * (k.n + 2) // (l.n + 2 * l.v)::HUGEINT AS q
    FROM sized s JOIN kept k ON s.lang = k.lang JOIN languages l ON s.lang = l.lang
    LEFT JOIN found f ON f.lang = s.lang AND f.source = s.source AND f.term = k.term
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM grid WHERE n > 0 AND p > q
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
