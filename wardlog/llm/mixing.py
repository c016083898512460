"""Mixing sources to target weights by weighted fair queueing.

Documents are shuffled by a hash. A document's virtual finish time is the cumulative words of its source,
earlier passes included, divided by the source's target. All copies are ordered by that time and taken while
their words fit the budget, so every source reaches its target at about time 1.

Both running sums (inside a source, and over all copies) are taken in two steps: sums per hash or time range,
then rows inside one range, so no task sees a whole source. The number of ranges follows the rows.

Defined results: NULL text has no words; NULL is a source of its own, last in order; rows that agree in id, source and
size (also all rows without an id) are numbered, hashed CHUNK at a time, and queued one after the other, so they spread
over the queue and each is taken as often as it fits; which of them is taken once more is not defined. Documents without
words are never taken; a source without words has target 0; other columns, whatever their names, are carried along; an
empty frame gives an empty frame. Only narrow rows (id, source, size) are shuffled and stored.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog.llm.words import WORD, table, word_count
from wardlog.session import join_side, materialize

WEIGHTS = (5, 2, 1)  # by the source's place in code point order, repeating
PASSES = 3  # a document is taken so many times at most
SEED = "mix"
CHUNK = 64  # rows of equal id, source and size that share a hash
NUMBER_BUCKETS = 4096
RANGE_ROWS = 2_000  # rows of a hash or time range, as long as there are no more than MOST_RANGES
MOST_RANGES = 65_536
LAST_TIME = 8  # later finish times share one range


def source_targets(sizes: DataFrame, source="source", weights=WEIGHTS, passes=PASSES) -> DataFrame:
    """Per source: its place, size, weight and target. One row per source; the windows run over these rows."""
    per = sizes.groupBy(source).agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col(source).asc_nulls_last()))
    per = per.withColumn("place", place).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") - 1) % len(weights) + 1).cast("long"))
    whole = W.partitionBy()
    before = W.orderBy(F.col("ratio"), F.col("place")).rowsBetween(W.unboundedPreceding, -1)
    cap = F.col("source_size") * passes

    def over_zero(a: Column, b: Column) -> Column:
        return F.try_divide(a.cast("double"), b)

    per = per.withColumn("ratio", cap.cast("double") / F.col("weight")).withColumns({
        "budget": F.sum("source_size").over(whole), "all_weights": F.sum("weight").over(whole),
        "caps_before": F.coalesce(F.sum(cap).over(before), F.lit(0)),
        "weights_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    level = over_zero(F.col("budget") - F.col("caps_before"), F.col("all_weights") - F.col("weights_before"))
    per = per.withColumn("capped", F.col("ratio") < level)
    left = F.col("budget") - F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(whole)
    weights_left = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(whole)
    return per.withColumn("target", F.when(F.col("capped"), cap.cast("double")).otherwise(
        F.least(cap.cast("double"), over_zero(left, weights_left) * F.col("weight"))
    )).select(source, "place", "source_size", "weight", "target", "budget")


def _ranges(rows: int) -> int:
    return max(1, min(MOST_RANGES, 1 << math.ceil(math.log2(max(1, rows / RANGE_ROWS)))))



def _queue(df: DataFrame, id, text, source, seed) -> DataFrame:
    """Rows that agree in id, source and size, CHUNK at a time: id, source, size, chunk, repeats (rows of it), hash."""
    units = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    chunks = units.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("rows") - 1, F.lit(CHUNK).cast("long")))))
    name = F.concat(F.lit(seed), F.when(F.col("chunk") > 0, F.col("chunk").cast("string")).otherwise(""),
                    F.coalesce(F.concat(F.lit(":"), F.col("id").cast("string")), F.lit("/")))
    return chunks.select("id", "source", "size", "chunk", F.least(F.lit(CHUNK), F.col("rows") - F.col("chunk") * CHUNK).alias("repeats"), F.md5(name).alias("h"))


ORDER = ("h", "size", "chunk")  # of the chunks of a source


def mix_sources(df: DataFrame, id="doc_id", text="text", source="source", weights=WEIGHTS, passes=PASSES,
                seed=SEED) -> DataFrame:
    """One row per row of df: id, source, size, source_size, target, copies. Rows that agree in id, source and size
    differ by one copy at most in each pass."""
    chunks = materialize(_queue(df, id, text, source, seed))
    n_chunks = chunks.count()
    ranges = _ranges(n_chunks)
    digits = F.conv(F.substring("h", 1, 4), 16, 10).cast("long")
    targets = materialize(source_targets(chunks, "source", weights, passes))
    side = join_side(targets)
    placed = chunks.join(
        side.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"
    ).drop("of").withColumn("part", F.floor(digits * ranges / 65_536))

    # words before each chunk in its source, by hash range and then by row
    words = F.col("size") * F.col("repeats")
    sums = placed.groupBy("place", "part").agg(F.sum(words).alias("words"))
    earlier = W.partitionBy("place").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("place", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy("place", "part").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, W.currentRow)
    queued = materialize(
        placed.withColumn("before", F.sum(words).over(inside) - words).join(offsets, ["place", "part"])
        .withColumn("before", F.col("before") + F.col("offset")).drop("offset", "part"))

    def finish(turn, number) -> Column:
        done = F.col("source_size") * turn + F.col("before") + F.col("size") * (number + 1)
        return F.try_divide(done.cast("double"), F.col("target"))

    def key(turn, number) -> list[Column]:
        """What orders copies: time, then the place of the source, the chunk, the row in it, and the pass."""
        return [finish(turn, number).alias("finish"), F.col("place"), *map(F.col, ORDER), number.alias("number"), F.lit(turn).alias("pass")]

    numbers = F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1)
    each = F.flatten(F.transform(numbers, lambda n: F.array(*[F.struct(*key(k, n)) for k in range(passes)])))
    copies = queued.filter("size > 0").select(F.explode(each).alias("c")).select("c.*")
    copies = copies.withColumn("span", F.least(F.floor(F.col("finish") * ranges), F.lit(LAST_TIME * ranges)))
    spans = copies.groupBy("span").agg(F.sum("size").alias("words"))
    running = spans.withColumn("upto", F.sum("words").over(W.orderBy("span").rowsBetween(W.unboundedPreceding, 0)))
    budget = (targets.agg(F.max("budget")).first()[0]) or 0
    cut_span = running.filter(F.col("upto") > budget).orderBy("span").first()
    first_left = None
    if cut_span is not None:
        upto = F.sum("size").over(W.orderBy("finish", "place", *ORDER, "number", "pass").rowsBetween(W.unboundedPreceding, 0))
        first_left = copies.filter(F.col("span") == cut_span["span"]).withColumn(
            "upto", upto + (cut_span["upto"] - cut_span["words"])).filter(F.col("upto") > budget).orderBy("upto").first()

    def taken(turn, number) -> Column:
        if first_left is None:
            return F.lit(True)
        at = first_left
        limit = F.struct(F.lit(at["finish"]), F.lit(at["place"]), F.lit(at["h"]), *[F.lit(at[c]).cast("long") for c in ("size", "chunk", "number")], F.lit(at["pass"]))
        return F.struct(*key(turn, number)) < limit

    def count(number) -> Column:
        return F.when(F.col("size") > 0, sum((F.when(taken(k, number), 1).otherwise(0) for k in range(passes)), F.lit(0))).otherwise(0)

    return queued.select("id", "source", "size", "source_size", "target", F.explode(F.transform(numbers, count)).alias("copies"))


def mixed_documents(df: DataFrame, id="doc_id", text="text", source="source", passes=PASSES, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns of df."""
    spark = df.sparkSession
    units = mix_sources(df, id, text, source, passes=passes, **options).groupBy("id", "source", "size").agg(
        *[F.count_if(F.col("copies") >= k).alias(f"with_{k}") for k in range(1, passes + 1)], F.count(F.lit(1)).alias("rows"))
    units = materialize(units.filter("with_1 > 0"))
    split = F.lit(False)  # whether rows of the unit are taken differently often
    for k in range(1, passes + 1):
        split |= F.col(f"with_{k}").between(1, F.col("rows") - 1)

    def joined(some):
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{id}`").alias("own_id"),
                         F.col(f"`{source}`").alias("own_source"), word_count(F.col(f"`{text}`")).alias("own_size"))
        return rows.join(some, F.col("own_id").eqNullSafe(F.col("id")) & F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_size") == F.col("size")))

    def repeated(rows, number):
        """Rows as often as their number in the unit says: row n is taken k times if more than n rows are taken k times."""
        times = sum((F.when(number < F.col(f"with_{k}"), 1).otherwise(0) for k in range(1, passes + 1)), F.lit(0))
        return rows.withColumn("times", times).filter("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")

    whole = repeated(joined(units.filter(~split)), F.lit(0))
    if units.filter(split).isEmpty():
        return whole
    # rows of the other units are numbered in two steps, by bucket and inside it
    rows = materialize(joined(units.filter(split)).withColumn("at", F.monotonically_increasing_id()))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(NUMBER_BUCKETS)))
    unit = ["id", "source", "size"]
    counts = rows.groupBy(*unit, "bucket").agg(F.count(F.lit(1)).alias("held"))
    before = W.partitionBy(*unit).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"of_{c}") for c in (*unit, "bucket")], F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier"))
    same = (F.col("id").eqNullSafe(F.col("of_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size"))
            & (F.col("bucket") == F.col("of_bucket")))
    numbered = rows.join(counts, same).withColumn("number", F.col("earlier") + F.row_number().over(W.partitionBy(*unit, "bucket").orderBy("at")) - 1)
    return whole.union(repeated(numbered, F.col("number")))


def op2_mix_sources(spark, sf_dir):
    mix = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mix.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


SQL = f"""
WITH counted AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS number FROM counted),
units AS (
    SELECT *, number // {CHUNK} AS chunk, md5('{SEED}' || CASE WHEN number >= {CHUNK} THEN CAST(number // {CHUNK} AS VARCHAR) ELSE '' END
        || coalesce(':' || CAST(doc_id AS VARCHAR), '/')) AS h FROM numbered
),
sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM units GROUP BY source
),
weighted AS (
    SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
        CAST({PASSES} * source_size AS DOUBLE) / (CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END) AS ratio
    FROM sizes
),
levels AS (
    SELECT *, sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weights,
        coalesce(sum({PASSES} * source_size) OVER before, 0) AS caps_before, coalesce(sum(weight) OVER before, 0) AS weights_before
    FROM weighted WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
capping AS (
    SELECT *, ratio < CAST(budget - caps_before AS DOUBLE) / CAST(all_weights - weights_before AS DOUBLE) AS capped FROM levels
),
targets AS (
    SELECT source, place, source_size, budget, CASE WHEN capped THEN CAST({PASSES} * source_size AS DOUBLE)
        ELSE least(CAST({PASSES} * source_size AS DOUBLE),
            CAST(budget - sum(CASE WHEN capped THEN {PASSES} * source_size ELSE 0 END) OVER () AS DOUBLE)
            / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS DOUBLE) * weight) END AS target
    FROM capping
),
queued AS (
    SELECT u.*, t.place, t.source_size, t.budget, t.target, CAST(sum(u.size) OVER (PARTITION BY t.place ORDER BY u.h, u.size, u.chunk, u.number
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
    FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source
),
copies AS (
    SELECT q.*, p.pass, CAST(source_size * p.pass + cumulative AS DOUBLE) / target AS finish
    FROM queued q, (SELECT unnest([{", ".join(map(str, range(PASSES)))}]) AS pass) p WHERE size > 0
),
taking AS (
    SELECT doc_id, source, size, number, sum(size) OVER (
        ORDER BY finish, place, h, size, chunk, number, pass ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= budget AS took
    FROM copies
),
times AS (SELECT doc_id, source, size, number, count(*) AS n FROM taking WHERE took GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(c.n, 0) AS BIGINT) AS taken, q.source
FROM queued q LEFT JOIN times c ON q.doc_id IS NOT DISTINCT FROM c.doc_id AND q.source IS NOT DISTINCT FROM c.source
    AND q.size = c.size AND q.number = c.number
"""
