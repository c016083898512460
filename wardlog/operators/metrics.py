"""Classifier metrics over a table of (label, prediction) or (class, label, score)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlog.operators.ranks import running_totals
from wardlog.session import materialize

WEIGHTED = ["accuracy", "precision", "recall", "f1"]


def confusion_matrix(predictions: DataFrame, label="label", prediction="prediction") -> DataFrame:
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("count"))


def _ratio(a, b):
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))


def class_report(predictions: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """Precision, recall, F1 and support per class seen as label or prediction."""
    cells = confusion_matrix(predictions, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    truth = cells.select(F.col("label").alias("class"), "count", F.lit(0).cast("bigint").alias("guessed"),
                         F.lit(0).cast("bigint").alias("hit"))
    guess = cells.select(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("count"),
                         F.col("count").alias("guessed"), hit.cast("bigint").alias("hit"))
    sums = truth.unionByName(guess).groupBy("class").agg(
        F.sum("count").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit")
    )
    shares = sums.withColumns({"precision": _ratio("hit", "guessed"), "recall": _ratio("hit", "support")})
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0))
    return shares.withColumn("f1", f1).select("class", "precision", "recall", "f1", "support", "hit")


def weighted_metrics(predictions: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """One row: accuracy, and precision, recall, F1 weighted by class support."""
    report = class_report(predictions, label, prediction)
    total = F.sum("support").cast("double")

    def weighted(name):
        return F.try_divide(F.sum(F.col(name) * F.col("support")), total).alias(name)

    return report.agg(
        F.try_divide(F.sum("hit").cast("double"), total).alias("accuracy"),
        weighted("precision"), weighted("recall"), weighted("f1"),
    )


def macro_metrics(predictions: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """One row: accuracy, and plain averages of precision, recall and F1 over the classes."""
    return class_report(predictions, label, prediction).agg(
        F.try_divide(F.sum("hit").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
        *[F.avg(n).alias(n) for n in WEIGHTED[1:]],
    )


def classification_report(predictions: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """Class rows followed by accuracy, macro and weighted averages, as (name, metrics, support)."""
    report = class_report(predictions, label, prediction)
    support = report.agg(F.sum("support")).scalar()
    columns = ["precision", "recall", "f1", "support"]
    averages = [
        macro_metrics(predictions, label, prediction).select(
            F.lit("macro avg").alias("name"), *WEIGHTED[1:], support.alias("support")),
        weighted_metrics(predictions, label, prediction).select(
            F.lit("weighted avg").alias("name"), *WEIGHTED[1:], support.alias("support")),
        weighted_metrics(predictions, label, prediction).select(
            F.lit("accuracy").alias("name"), F.lit(None).cast("double").alias("precision"),
            F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), support.alias("support")),
    ]
    classes = report.select(F.col("class").cast("string").alias("name"), *columns)
    return reduce(DataFrame.unionByName, averages, classes)


def roc_points(scores: DataFrame, buckets=None) -> DataFrame:
    """ROC per class over (class, label, score): one point per different score, and the origin.

    `label` is the true class; a row counts as positive where it equals `class`. Rows are first
    reduced to different scores; running counts then use even score ranges instead of one task
    per class.
    """
    positive = F.col("label") == F.col("class")
    counts = materialize(scores.groupBy("class", "score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    ))
    run = running_totals(counts, "class", "score", ["pos", "neg"], buckets)
    points = run.select(
        "class", F.col("score").alias("threshold"),
        F.coalesce(F.try_divide(F.col("cum_neg").cast("double"), F.col("total_neg").cast("double")), F.lit(0.0)).alias("fpr"),
        F.coalesce(F.try_divide(F.col("cum_pos").cast("double"), F.col("total_pos").cast("double")), F.lit(0.0)).alias("tpr"),
    )
    origin = counts.select("class").distinct().select(
        "class", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc_auc(scores: DataFrame, buckets=None) -> DataFrame:
    """Area under the curve per class, by the rank form of the trapezoid sum.

    Each negative counts the positives above it, plus half of those at the same score, so the
    sum needs no neighbouring points.
    """
    positive = F.col("label") == F.col("class")
    counts = materialize(scores.groupBy("class", "score").agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    ))
    run = running_totals(counts, "class", "score", ["pos", "neg"], buckets)
    # Twice the area, as a whole number: exact and independent of the order of the rows.
    twice = F.col("neg").cast("decimal(19,0)") * (2 * F.col("cum_pos") - F.col("pos")).cast("decimal(19,0)")
    return run.groupBy("class").agg(
        F.try_divide(
            F.sum(twice).cast("double"),
            F.lit(2.0) * F.max("total_pos").cast("double") * F.max("total_neg").cast("double"),
        ).alias("auc")
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """Name and F1 of the best model; of equal ones the one that was tried first."""
    return metrics.agg(
        F.max_by("model", F.struct(F.col("f1"), -F.col("position"))).alias("model"), F.max("f1").alias("f1")
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("f1"), "model")


def align_metrics(hold_out: DataFrame, folds: DataFrame) -> DataFrame:
    """Hold-out metrics next to the cross-validation means of the same model."""
    renamed = folds.select("model", *[F.col(n).alias(f"cv_{n}") for n in WEIGHTED])
    return hold_out.join(renamed, "model", "full_outer")


def elbow(inertia: DataFrame) -> DataFrame:
    """k with the largest second difference of inertia; the smallest k of equal ones.

    The table has one row per tried k (nine by default), so its window is a fixed small size.
    """
    by_k = W.orderBy("k")
    bend = F.lead("inertia").over(by_k) - 2 * F.col("inertia") + F.lag("inertia").over(by_k)
    return (
        inertia.withColumn("bend", F.abs(bend)).where(F.col("bend").isNotNull())
        .orderBy(F.desc("bend"), "k").limit(1).select("k", "bend")
    )
