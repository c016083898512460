"""Reproducible splits, folds, class repair and noise."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog.functions import hash_order
from wardlog.operators.ranks import dense_index, fraction_rank, tile
from wardlog.session import join_side, materialize


def stratified_split(df: DataFrame, label="label", id_col="id", test_size=0.25, seed=42) -> DataFrame:
    """Adds is_test: exactly round(test_size * n) rows of each class."""
    out = tile(df, id_col, seed, lambda n: [fraction_rank(n, test_size)], by=label, name="_tile")
    # A class whose share rounds to 0 has no cut, and no test rows.
    return out.withColumn("is_test", F.coalesce(F.col("_tile") == 0, F.lit(False))).drop("_tile")


def random_split(df: DataFrame, id_col="id", test_size=0.25, seed=42) -> DataFrame:
    """Adds is_test: exactly round(test_size * n) rows, those first in hash order. Counting passes find the cut;
    the rows themselves are not shuffled."""
    out = tile(df, id_col, seed, lambda n: [fraction_rank(n, test_size)], name="_tile")
    return out.withColumn("is_test", F.coalesce(F.col("_tile") == 0, F.lit(False))).drop("_tile")


def kfold(df: DataFrame, label="label", id_col="id", folds=5, seed=42) -> DataFrame:
    """Adds fold 0..folds-1; within a class the sizes differ by at most one."""
    def borders(n):
        small = F.floor(n / folds)
        large = n - small * folds  # the first `large` folds get one row more
        return [F.lit(i) * small + F.least(F.lit(i), large) for i in range(1, folds)]

    return tile(df, id_col, seed, borders, by=label, name="fold")


def class_counts(df: DataFrame, label="label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def needs_stratified(df: DataFrame, label="label", minimum=10) -> bool:
    """Whether the smallest class has fewer than `minimum` rows, but two at least: a class of one
    row cannot be divided, and the plain split is used instead."""
    smallest = class_counts(df, label).agg(F.min("count")).first()[0]
    return smallest is not None and 2 <= smallest < minimum


def missing_classes(split: DataFrame, label="label") -> DataFrame:
    """Classes of all rows that the test rows lack; and those that the training rows lack."""
    present = split.groupBy(label).agg(
        F.bool_or("is_test").alias("in_test"), F.bool_or(~F.col("is_test")).alias("in_train")
    )
    return present.where(~F.col("in_test") | ~F.col("in_train"))


def repaired_rows(split: DataFrame, label="label", id_col="id", seed=42, most=5, share=0.1) -> DataFrame:
    """Training rows to move: min(most, int(share * class rows)) per class that test lacks."""
    train = split.where(~F.col("is_test"))
    lacking = split.groupBy(label).agg(
        F.bool_or("is_test").alias("_in_test"), F.count_if(~F.col("is_test")).alias("_n")
    ).where(~F.col("_in_test")).select(label, "_n")
    order = W.partitionBy(label).orderBy(hash_order(id_col, seed), id_col)
    # The constant bound lets every task drop all but its first rows before the shuffle.
    first = train.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most)
    return (
        first.join(lacking, label)
        .where(F.col("_rank") <= F.floor(F.col("_n") * F.lit(share)))
        .drop("_rank", "_n")
    )


def repair_test_classes(split: DataFrame, label="label", id_col="id", seed=42) -> DataFrame:
    """The split after moving rows of the classes that test lacks: train without, test with them."""
    moved = materialize(repaired_rows(split, label, id_col, seed))  # a few rows per class
    train = split.where(~F.col("is_test")).join(join_side(moved.select(id_col)), id_col, "left_anti")
    return train.unionByName(split.where("is_test")).unionByName(moved.withColumn("is_test", F.lit(True)))


def improved_split(df: DataFrame, label="label", id_col="id", test_size=0.25, seed=42) -> DataFrame:
    """Stratified when a class is small, plain otherwise; then test gets the classes it lacks."""
    if needs_stratified(df, label):
        out = stratified_split(df, label, id_col, test_size, seed)
    else:
        out = random_split(df, id_col, test_size, seed)
    return repair_test_classes(out, label, id_col, seed)


def drawn_rows(df: DataFrame, id_col="id", seed=42, least=5, share=0.1) -> DataFrame:
    """max(least, int(share * n)) rows drawn with replacement.

    Draw j picks row hash(seed, j) mod n. The draws are made from the rows themselves (row i
    makes the draws i, i + n, ...), so nothing passes the driver.
    """
    rows = dense_index(df, id_col, seed)
    n = F.col("row_total")
    draws = F.greatest(F.lit(least).cast("bigint"), F.floor(n * F.lit(share)))
    drawn = (
        rows.where(F.col("row_index") < draws)
        .select(F.explode(F.sequence(F.col("row_index"), draws - 1, n)).alias("draw"), "row_total")
    )
    number = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("draw"), "draw")), 1, 15), 16, 10)
    picks = drawn.select("draw", F.pmod(number.cast("bigint"), "row_total").alias("row_index"))
    return picks.join(rows.drop("row_total"), "row_index").drop("row_index")


def synthesize_minority(df: DataFrame, label="label", id_col="id", seed=42) -> DataFrame:
    """A table of a single class gets drawn rows of a second class; others stay as they are."""
    two = df.select(label).distinct().limit(2).collect()
    if len(two) != 1:
        return df
    other = 1 if two[0][0] == 0 else 0
    drawn = drawn_rows(df, id_col, seed).drop("draw").withColumn(label, F.lit(other).cast(df.schema[label].dataType))
    return df.unionByName(drawn)


def with_noise(df: DataFrame, columns, id_col="id", level=0.05, seed=42) -> DataFrame:
    """Adds N(0, level) to every column: two hash uniforms per cell, Box-Muller."""
    def uniform(column, salt):
        digits = F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}"), F.col(id_col).cast("string"),
                                               F.lit(f"{column}{salt}"))), 1, 12)
        return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**12))

    def normal(column):
        radius = F.sqrt(F.log(uniform(column, "a")) * -2.0)
        return radius * F.cos(uniform(column, "b") * (2 * 3.141592653589793))

    return df.withColumns({
        c: F.col(c).cast("double") + normal(c) * float(level) for c in columns
    })
