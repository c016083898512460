"""Connected components of an edge table, by randomised contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of edges (a, b).

    In each round every node goes to the neighbour, or itself, that a hash of the round puts first; edges are
    then drawn between the targets. A constant share of the nodes is expected to disappear per round, whatever
    the shape of the graph. Rounds are tables in the shared folder: nothing comes to the driver, and a hot node
    is an aggregate and a join key, never one group in a task.
    """
    rounds = []
    left = materialize(edges.select("a", "b").filter("a <> b").distinct())
    while not left.isEmpty():
        salt = F.lit(len(rounds))

        def ranked(name, salt=salt):
            return F.struct(F.xxhash64(salt, F.col(name)).alias("rank"), F.col(name).alias("node"))

        both = left.union(left.select("b", "a"))
        target = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("near"))
        step = materialize(target.select("node", F.least(ranked("node"), F.col("near"))["node"].alias("target")))
        rounds.append(step)
        left = materialize(
            left.join(step.select(F.col("node").alias("a"), F.col("target").alias("to_a")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("target").alias("to_b")), "b")
            .filter("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct())
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    label = rounds[-1]
    for step in reversed(rounds[:-1]):
        label = step.join(
            label.select(F.col("node").alias("target"), F.col("target").alias("end")), "target", "left"
        ).select("node", F.coalesce("end", "target").alias("target"))
    label = materialize(label)
    least = label.groupBy("target").agg(F.min("node").alias("component"))
    return materialize(label.join(least, "target").select("node", "component"))
