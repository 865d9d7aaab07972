"""Which F_beta follows the human rating best: bootstrap, score, correlate, in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import even_grid
from millrace.operators.metrics import edit_totals, f_beta
from millrace.operators.sampling import bootstrap_rows


def replicate_totals(edits: DataFrame, keys: list[str], replicates: int, seed=42) -> DataFrame:
    """Mean rating and TP, FP, FN of each weighted replicate.

    Columns of edits: gold_edits, predicted_edits, predicted_correct, human_rating.
    """
    rows = bootstrap_rows(edits, keys, replicates, seed)
    w = F.col("weight").cast("bigint")
    totals = edit_totals(F.col("gold_edits"), F.col("predicted_edits"), F.col("predicted_correct"), w)
    return rows.groupBy("replicate").agg(
        (F.sum(w * F.col("human_rating")) / F.sum(w)).alias("rating"), *totals
    )


def beta_curve(edits: DataFrame, keys: list[str], replicates: int = 100, betas: int = 201, highest: float = 2.0, seed=42) -> DataFrame:
    """Pearson correlation of F_beta and mean rating over the replicates, per beta."""
    totals = replicate_totals(edits, keys, replicates, seed)
    grid = totals.select("*", F.posexplode(even_grid(F.lit(0.0), F.lit(highest), betas)).alias("step", "beta"))
    scored = grid.withColumn("f", f_beta(F.col("tp"), F.col("fp"), F.col("fn"), F.col("beta")))
    return scored.groupBy("step").agg(F.first("beta").alias("beta"), F.corr("f", "rating").alias("correlation"))


def best_beta(curve: DataFrame) -> DataFrame:
    return curve.orderBy(F.round("correlation", 9).desc(), "step").limit(1).select("beta", "correlation")


