"""Shards of near equal bytes by sampled splitters.

Rows are ordered by key: a hash of the text, a hash of the id, and a number of the row that only decides between equal
ones. Samples of keys are drawn with a chance in proportion to size (plus the mean size, so that many small rows count as well);
their quantiles are the borders of ranges, and a range that got more than twice its share is sampled again and subdivided
until none is overfull. Exact sums per range, then inside each range, give every row its place in the whole order, and a
row's shard is the one in which its middle byte lies. So the result depends on the rows only, not on the samples.

Rows of equal text (a group) lie together in one shard, as long as the group holds at most 1/1024 of all bytes and of
all rows (for 16 shards); larger groups are spread row by row. A shard's bytes differ from the mean by at most the larger
of such a group and of the largest row.

Defined results: NULL text has size 1 and is a group apart from the empty text; rows without an id are rows as others;
repeated rows get slots of their own; other columns are carried along, but those named like the outputs (size,
text_crc32, shard, slot) are replaced; an empty frame gives an empty frame. Only keys, sizes and carried columns are
stored; the driver sees the sampled keys and one row per range, of which there are at most MOST_RANGES and some.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog.llm.columns import on_workers
from wardlog.llm.words import table
from wardlog.session import materialize

SHARDS = 16
RANGE_ROWS = 20_000  # rows of a range, as long as there are no more than MOST_RANGES
MOST_RANGES = 65_536
OVERSAMPLE = 8  # keys drawn per range
OVERFULL = 2  # shares a range may hold before it is subdivided
GROUP_SHARE = 64  # groups of up to one part in so many of a shard stay whole
OUTPUTS = ["size", "text_crc32", "shard", "slot"]
KEY = ["_h", "_s", "_t"]
_LEAST = np.iinfo(np.int64).min


def keyed_rows(df: DataFrame, id="doc_id", text="text", carry=None) -> DataFrame:
    """Carried columns in `row`, size, checksum, and the three parts of the key."""
    whole, own = F.col(f"`{text}`").cast("string"), F.col(f"`{id}`").cast("string")
    names = [c for c in (df.columns if carry is None else carry) if c not in OUTPUTS]
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        (F.coalesce(F.octet_length(whole), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(whole, F.lit(""))).alias("text_crc32"),
        F.xxhash64(whole.isNull(), whole).alias("_h"), F.xxhash64(own.isNull(), own).alias("_s"),
        F.monotonically_increasing_id().alias("_t"),
    )


class Borders:
    """Sorted keys at which a new range begins."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys.reshape(-1, 3), axis=0)

    @staticmethod
    def _comparable(keys: np.ndarray) -> np.ndarray:
        """Keys as 24 bytes whose order is that of the three numbers."""
        raw = (keys.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")
        return np.ascontiguousarray(raw).view("S24").ravel()

    def ranges_of(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self._comparable(self.keys), self._comparable(keys), side="right")

    def column(self):
        keys = self.keys

        @F.pandas_udf("int")
        def range_of(h: pd.Series, s: pd.Series, t: pd.Series) -> pd.Series:
            found = Borders(keys).ranges_of(np.column_stack([h.to_numpy(), s.to_numpy(), t.to_numpy()]))
            return pd.Series(found.astype(np.int32))

        return range_of(*KEY)


def _drawn(rows: DataFrame, per_weight: float, mean: float, seed: int) -> np.ndarray:
    """Keys of a sample, each as often as it was drawn; a row is drawn per_weight times its weight on average."""
    lot = F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = F.floor((F.col("size") + F.lit(mean)) * F.lit(per_weight) + lot).cast("int")
    found = rows.select(*KEY, times.alias("times")).filter("times > 0").toPandas()
    return np.repeat(found[KEY].to_numpy(np.int64), found["times"].to_numpy(), axis=0)


def splitters(rows: DataFrame, count: int, size: int, heavy: set[int], ranges: int) -> tuple[Borders, pd.DataFrame]:
    """Borders of ranges, and the bytes and rows of each range (one row per range, in order).

    Only heavy groups are cut inside; a border that falls into another group moves to its beginning.
    """
    mean = size / count
    share = 2 * size / ranges  # of the weight, which is size + mean

    def at_groups(keys):
        whole = ~np.isin(keys[:, 0], list(heavy))
        keys = keys.copy()
        keys[whole, 1:] = _LEAST
        return keys

    def quantiles(keys, parts):
        keys = keys[np.lexsort(keys.T[::-1])]
        return keys[(np.arange(1, parts) * len(keys) // parts)] if len(keys) else keys

    borders = Borders(at_groups(quantiles(_drawn(rows, OVERSAMPLE / share, mean, 0), ranges)))
    before = None
    for turn in range(1, 64):
        placed = rows.withColumn("range", borders.column())
        held = placed.groupBy("range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).toPandas().sort_values("range")
        weight = held["size"] + held["rows"] * mean
        full = held[(weight > OVERFULL * share) & (held["rows"] > 1)]
        if not len(full) or before == len(borders.keys):
            break
        before = len(borders.keys)
        inside = placed.filter(F.col("range").isin(*map(int, full["range"]))) if len(full) < 1000 else placed
        keys = _drawn(inside, OVERSAMPLE / share, mean, turn)
        own = borders.ranges_of(keys)
        parts = (weight[full.index] // share + 1).astype(int)
        extra = [quantiles(keys[own == r], n) for r, n in zip(full["range"], parts)]
        borders = Borders(np.concatenate([borders.keys, at_groups(np.concatenate(extra))]))
    return borders, held


def heavy_groups(rows: DataFrame, count: int, size: int, shards: int) -> list[int]:
    """Groups with more than one part in GROUP_SHARE * shards of the bytes or of the rows: at most twice that number."""
    parts = GROUP_SHARE * shards
    sums = rows.groupBy("_h").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    found = sums.filter((F.col("size").cast("decimal(38,0)") * parts > size) | (F.col("rows").cast("decimal(38,0)") * parts > count))
    return [r["_h"] for r in found.select("_h").collect()]


def sharded(df: DataFrame, id="doc_id", text="text", shards=SHARDS, carry=None, range_rows=RANGE_ROWS) -> DataFrame:
    """The carried columns (all of df), size, text_crc32, shard and the row's slot in it."""
    on_workers(df.sparkSession)
    rows = materialize(keyed_rows(df, id, text, carry))
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not count:
        return rows.select("row.*", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    heavy = heavy_groups(rows, count, size, shards)
    ranges = max(2 * shards, min(MOST_RANGES, -(-count // range_rows)))
    borders, held = splitters(rows, count, size, set(heavy), ranges)
    ends, upto = held["size"].cumsum().to_numpy(), held["rows"].cumsum().to_numpy()
    starts, first = ends - held["size"].to_numpy(), upto - held["rows"].to_numpy()

    spark = df.sparkSession
    offsets = spark.createDataFrame([tuple(map(int, x)) for x in zip(held["range"], starts, first)], "of long, before long, rows_before long")
    placed = rows.withColumn("range", borders.column()).join(F.broadcast(offsets), F.col("range") == F.col("of"))  # one row per range
    inside = W.partitionBy("range").orderBy(*KEY).rowsBetween(W.unboundedPreceding, 0)
    group = W.partitionBy("range", "_h")
    ordered = placed.withColumns({
        "begin": F.col("before") + F.sum("size").over(inside) - F.col("size"),
        "rank": F.col("rows_before") + F.row_number().over(W.partitionBy("range").orderBy(*KEY)) - 1,
    })
    alone = F.col("_h").isin(*heavy) if heavy else F.lit(False)
    begin = F.when(alone, F.col("begin")).otherwise(F.min("begin").over(group))
    width = F.when(alone, F.col("size")).otherwise(F.sum("size").over(group))
    middle = F.call_function("div", (begin * 2 + width) * F.lit(shards), F.lit(2 * size).cast("long"))
    found = ordered.withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))

    # rows before each shard: whole ranges, and a count inside the ranges that hold a border
    marks = np.array([size * k // shards for k in range(1, shards)])
    cut = sorted({int(r) for r in held["range"].to_numpy()[np.minimum(np.searchsorted(ends, marks, side="right"), len(ends) - 1)]})
    parts = found.filter(F.col("range").isin(*cut)).groupBy("shard").agg(F.count(F.lit(1)).alias("rows")).toPandas()
    per = np.zeros(shards, np.int64)
    np.add.at(per, parts["shard"].to_numpy(int), parts["rows"].to_numpy())
    rest = held[~held["range"].isin(cut)]
    middle_of_rest = (2 * starts + held["size"].to_numpy())[~held["range"].isin(cut).to_numpy()]
    np.add.at(per, [min(shards - 1, int(m) * shards // (2 * size)) for m in middle_of_rest], rest["rows"].to_numpy())
    before = np.cumsum(per) - per
    return found.select("row.*", "size", "text_crc32", "shard", (F.col("rank") - F.element_at(
        F.array(*[F.lit(int(b)).cast("long") for b in before]), F.col("shard") + 1)).alias("slot"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Writes the records below path, a folder per shard; rows of a file are in slot order."""
    sharded(df, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op11_shard_by_bytes(spark, sf_dir):
    found = sharded(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
