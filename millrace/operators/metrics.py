"""Scores of predictions against targets, each a one-pass aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.columns import guarded_ln, guarded_ratio


def mse(prediction: Column, target: Column) -> Column:
    return F.avg((prediction - target) * (prediction - target))


def rmse(prediction: Column, target: Column) -> Column:
    return F.sqrt(mse(prediction, target))


def accuracy(prediction: Column, target: Column) -> Column:
    return F.avg((prediction == target).cast("double"))


def binary_log_loss(target: Column, probability: Column) -> Column:
    return -F.avg(target * guarded_ln(probability) + (1 - target) * guarded_ln(1 - probability))


def class_log_loss(probabilities: Column, target: Column) -> Column:
    """Mean negative log of the target's probability; probabilities is an array."""
    return -F.avg(guarded_ln(F.element_at(probabilities, (target + 1).cast("int"))))


def edit_totals(gold: Column, predicted: Column, correct: Column, weight: Column | None = None) -> list[Column]:
    w = F.lit(1) if weight is None else weight
    return [
        F.sum(w * correct).alias("tp"),
        F.sum(w * (predicted - correct)).alias("fp"),
        F.sum(w * (gold - correct)).alias("fn"),
    ]


def f_beta(tp: Column, fp: Column, fn: Column, beta: Column) -> Column:
    """(1 + b^2) TP / ((1 + b^2) TP + b^2 FN + FP); 0 where nothing was gold or predicted."""
    scaled = (1.0 + beta * beta) * tp
    return guarded_ratio(scaled, scaled + beta * beta * fn + fp)


def class_counts(df: DataFrame, prediction: str, target: str) -> DataFrame:
    """TP, FP, FN of every class seen in prediction or target.

    The confusion table is aggregated first, so only classes x classes rows go further.
    """
    confusion = df.groupBy(F.col(prediction).alias("p"), F.col(target).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.when(
        F.col("p") == F.col("t"), F.array(F.struct(F.col("p").alias("c"), F.col("n").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.lit(0).cast("bigint").alias("fn")))
    ).otherwise(
        F.array(
            F.struct(F.col("p").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("fp"), F.lit(0).cast("bigint").alias("fn")),
            F.struct(F.col("t").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.col("n").alias("fn")),
        )
    )
    return (
        confusion.select(F.explode(sides).alias("s"))
        .groupBy(F.col("s.c").alias("class"))
        .agg(F.sum("s.tp").alias("tp"), F.sum("s.fp").alias("fp"), F.sum("s.fn").alias("fn"))
    )


def macro_f1(df: DataFrame, prediction: str, target: str, name: str = "macro_f1") -> DataFrame:
    counts = class_counts(df, prediction, target)
    f1 = guarded_ratio(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn"))
    return counts.agg(F.avg(f1).alias(name))


def binary_f1(prediction: Column, target: Column) -> Column:
    tp = F.sum(((prediction == 1) & (target == 1)).cast("double"))
    wrong = F.sum((prediction != target).cast("double"))
    return guarded_ratio(2.0 * tp, 2.0 * tp + wrong)


def majority(label: Column) -> Column:
    """Most frequent value, lowest on ties."""
    return F.mode(label, True)


def weighted_vote(df: DataFrame, query: str, label: str, weight: Column, name: str = "prediction") -> DataFrame:
    """Class with the largest weight sum per query, lowest class on ties."""
    votes = df.groupBy(query, label).agg(F.sum(weight).alias("_w"))
    # Equal sums may differ in the last bits by summation order; a share of the query's total has no scale.
    share = F.try_divide(F.col("_w"), F.sum("_w").over(Window.partitionBy(query)))
    votes = votes.withColumn("_s", share)
    order = F.struct((-F.round("_s", 9)).alias("w"), F.col(label).alias("c"))
    return votes.groupBy(query).agg(F.min_by(label, order).alias(name))


def impurity(counts: list[Column], criterion: str = "entropy") -> Column:
    """Impurity times node size from class counts; empty classes add nothing."""
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    if criterion == "gini":
        squares = sum((c * c for c in counts[1:]), counts[0] * counts[0])
        return F.when(total > 0, total - squares / total).otherwise(F.lit(0.0))
    terms = F.lit(0.0)
    for c in counts:
        terms = terms + F.when(c > 0, c * F.ln(c / total)).otherwise(F.lit(0.0))
    return -terms
