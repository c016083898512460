"""Ranks and running totals without a global or per-class sort in one task.

A class may hold a large share of all rows, so `row_number() over (partition by class ...)`
would send that share to one task. Both operators here first count rows per small order
bucket. The counts say where each bucket starts; only within a bucket are rows sorted. Ids must
be unique: they spread the rows over the buckets.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog.functions import hash_order
from wardlog.session import join_side, materialize

BUCKET_DIGITS = 4  # hex digits of the hash: 65,536 buckets of equal expected size
RANGE_ROWS = 20_000  # of running totals


def with_hash(df: DataFrame, id_col: str, seed, by=None) -> DataFrame:
    """Adds `_h` (random but fixed order), `_bucket` (its first digits) and `_by` (stratum)."""
    return df.withColumn("_h", hash_order(id_col, seed)).withColumns({
        "_bucket": F.substring("_h", 1, BUCKET_DIGITS),
        "_by": F.col(by).cast("string") if by else F.lit("all"),
    }).withColumn("_by", F.coalesce("_by", F.lit("\0null")))


def bucket_starts(hashed: DataFrame) -> DataFrame:
    """Rows per (stratum, bucket), rows before it, and the stratum's size.

    The windows run over counts: at most 65,536 rows per stratum, whatever the data's size.
    """
    counts = hashed.groupBy("_by", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_by").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumns({
        "_start": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_total": F.sum("_n").over(W.partitionBy("_by")),
    })


def cut_points(hashed: DataFrame, id_col: str, ranks) -> DataFrame:
    """(_by, cuts): the sorted [hash, id] of the rows that hold the asked ranks of each stratum.

    `ranks` maps the stratum's size (a column) to a list of rank columns; rank 0 means none.
    """
    starts = bucket_starts(hashed)
    wanted = starts.select(
        "*", F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("_total"))])).alias("_i", "_rank")
    ).where((F.col("_rank") > F.col("_start")) & (F.col("_rank") <= F.col("_start") + F.col("_n")))
    wanted = materialize(wanted.groupBy("_by", "_bucket", "_start").agg(F.collect_set("_rank").alias("_ranks")))
    # Only the few buckets that contain a cut are sorted.
    order = W.partitionBy("_by", "_bucket").orderBy("_h", id_col)
    at_cut = (
        hashed.select("_by", "_bucket", "_h", id_col)
        .join(join_side(wanted), ["_by", "_bucket"])
        .withColumn("_r", F.row_number().over(order) + F.col("_start"))
        .where(F.array_contains("_ranks", F.col("_r")))
    )
    cuts = F.array_sort(F.collect_list(F.struct(F.col("_h"), F.col(id_col).alias("_id"))))
    return at_cut.groupBy("_by").agg(cuts.alias("_cuts"))


def tile(df: DataFrame, id_col: str, seed, ranks, by=None, name="tile") -> DataFrame:
    """Adds the number of cuts that lie before each row: 0 for ranks up to the first cut, and so on.
    NULL in a stratum without cuts (all asked ranks are 0).

    Two counting passes, made at once, and a narrow lookup: the rows themselves are not shuffled
    unless the table of cuts (one row per stratum) is too large to broadcast. Evaluates `df` three
    times, so pass a stored table when it is costly.
    """
    hashed = with_hash(df, id_col, seed, by)
    cuts = materialize(cut_points(hashed, id_col, ranks))
    here = F.struct(F.col("_h"), F.col(id_col).alias("_id"))
    if by is None:  # one stratum: its few cuts are constants
        found = cuts.first()
        kind = df.schema[id_col].dataType
        fixed = [F.struct(F.lit(c["_h"]).alias("_h"), F.lit(c["_id"]).cast(kind).alias("_id")) for c in (found["_cuts"] if found else [])]
        passed = sum((F.when(c < here, 1).otherwise(0) for c in fixed), F.lit(0))
        return hashed.withColumn(name, passed if fixed else F.lit(None).cast("int")).drop("_h", "_bucket", "_by")
    cuts = join_side(cuts)
    passed = F.size(F.filter("_cuts", lambda c: c < here))
    return (
        hashed.join(cuts, "_by", "left")
        .withColumn(name, F.when(F.col("_cuts").isNotNull(), passed))
        .drop("_h", "_bucket", "_by", "_cuts")
    )


def dense_index(df: DataFrame, id_col: str, seed) -> DataFrame:
    """Adds `row_index`, 0..n-1 in hash order, and `row_total`: one shuffle into even buckets."""
    hashed = with_hash(df, id_col, seed)
    starts = bucket_starts(hashed).select("_bucket", "_start", F.col("_total").alias("row_total"))
    order = W.partitionBy("_bucket").orderBy("_h", id_col)
    return (
        hashed.join(starts, "_bucket")
        .withColumn("row_index", F.col("_start") + F.row_number().over(order) - 1)
        .drop("_h", "_bucket", "_by", "_start")
    )


def running_totals(df: DataFrame, by: str, order_col: str, sums: list[str], ranges=None) -> DataFrame:
    """Running sums of `sums` per `by`, over descending `order_col`. One row per (by, order) is expected.

    Rows are dealt into ranges of (by, order), one for every RANGE_ROWS rows, so a class that holds most rows has most
    ranges. One sum per range and class gives each range its offset; the window for those holds one row per range.
    The dealt rows are stored, since another deal could draw other borders. Evaluates `df` twice: pass a stored table.
    """
    if ranges is None:
        ranges = df.count() // RANGE_ROWS + 1
    dealt = materialize(df.repartitionByRange(ranges, F.col(by), F.desc(order_col)).withColumn("_range", F.spark_partition_id()))
    totals = dealt.groupBy(by, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = W.partitionBy(by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(by)
    offsets = materialize(totals.select(
        by, "_range",
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(everything).alias(f"total_{c}") for c in sums],
    ))
    local = W.partitionBy(by, "_range").orderBy(F.desc(order_col)).rowsBetween(W.unboundedPreceding, 0)
    return (
        dealt.join(join_side(offsets), [by, "_range"])
        .withColumns({f"cum_{c}": F.col(f"_before_{c}") + F.sum(c).over(local) for c in sums})
        .drop("_range", *[f"_before_{c}" for c in sums])
    )


def fraction_rank(total: Column, fraction: float) -> Column:
    """round(total * fraction), halves up."""
    return F.floor(total * F.lit(float(fraction)) + F.lit(0.5))
