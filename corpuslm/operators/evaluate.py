"""Multiclass metrics. All follow from the counts of (label, prediction), the only pass over the data.

Classes are the actual labels: a class that is only ever predicted has no row, but still counts as error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.operators.scoring import expand_classes
from corpuslm.plans.shared import materialize


def pred_labels(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return predictions.select(prediction, label)


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion(pairs: DataFrame) -> DataFrame:
    """(label, prediction, n) for every pair of actual classes, zeros included.

    The counts, at most one narrow row per pair of classes, are written first: whatever makes the pairs runs once.
    """
    counts = materialize(pair_counts(pairs), "pair-counts")
    labels = counts.select("label").distinct()
    cells = expand_classes(labels, labels, "label", spread_by="label", name="prediction")
    cells = cells.join(counts, ["label", "prediction"], "left")
    return cells.select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def class_metrics(pairs: DataFrame) -> DataFrame:
    """(label, n, precision, recall, f1, false_positive_rate) of each actual class."""
    counts = pair_counts(pairs)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    # each count adds to the row total of its label and the column total of its prediction
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    )
    per_class = counts.select(F.inline(sides)).groupBy("c").agg(
        F.sum("actual").alias("n"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    total = counts.agg(F.sum("n")).scalar()
    p = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0))
    r = F.col("tp") / F.col("n")
    others = total - F.col("n")
    fpr = F.when(others == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.col("predicted") - F.col("tp"), others))
    rated = per_class.where("n > 0").select(
        F.col("c").alias("label"), "n", p.alias("precision"), r.alias("recall"), fpr.alias("false_positive_rate")
    )
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return rated.select("label", "n", "precision", "recall", f1.alias("f1"), "false_positive_rate")


def weighted_metrics(pairs: DataFrame) -> DataFrame:
    """Class metrics averaged with the number of actual posts as weight."""
    def mean(metric: str):
        return (F.sum(F.col(metric) * F.col("n")) / F.sum("n")).alias(f"weighted_{metric}")

    return class_metrics(pairs).agg(*[mean(m) for m in ("precision", "recall", "f1", "false_positive_rate")])
