"""Naive Bayes: class statistics are one group-by, scoring is one more."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.linalg import matrix
from millrace.operators.ordering import with_rank
from millrace.operators.scoring import score_rows
from millrace.session import cut_lineage

#: Classes scored together.
CLASS_BLOCK = 1024


def class_priors(train: DataFrame, label: str) -> DataFrame:
    """Row count and share of each class; the share needs no window over rows."""
    counts = train.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("prior", F.col("n") / counts.agg(F.sum("n")).scalar())


def row_total(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def gaussian_fit(train: DataFrame, features: str, label: str, alpha: float, dims: int) -> DataFrame:
    """One row per class: priors, and arrays of means and smoothed population variances.

    The statistics are plain aggregate columns, so each task sends one row per class.
    """
    x = [F.col(features)[i] for i in range(dims)]
    stats = train.groupBy(F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in x]).alias("mean"),
        F.array(*[F.var_pop(c) + F.lit(alpha) for c in x]).alias("variance"),
    )
    return stats.select("class", "mean", "variance", (F.col("n") / row_total(train)).alias("prior"))


@dataclass
class DenseBayes:
    """Scores constant + linear . y - square . y^2 per class, with y = x - center; the first class of the highest wins.

    Scores within a billionth of the highest, relative to its size, count as equal.
    """

    classes: list
    center: np.ndarray
    constant: np.ndarray
    linear: np.ndarray
    square: np.ndarray

    @classmethod
    def gaussian(cls, model: DataFrame) -> "DenseBayes":
        """From (class, mean, variance, prior) rows."""
        rows = model.orderBy("class").toArrow()
        mean, variance = matrix(rows.column("mean")), matrix(rows.column("variance"))
        prior = rows.column("prior").to_numpy()
        # Distances are taken from the middle of the means, which keeps the squares small.
        center = prior @ mean / prior.sum() if len(prior) else np.zeros(0)
        mean = mean - center
        constant = np.log(prior) - 0.5 * np.log(2 * np.pi * variance).sum(axis=1) - (mean * mean / (2 * variance)).sum(axis=1)
        return cls(rows.column("class").to_pylist(), center, constant, mean / variance, 0.5 / variance)

    @classmethod
    def weighted(cls, model: DataFrame) -> "DenseBayes":
        """From (class, weight, constant, prior) rows."""
        rows = model.orderBy("class").toArrow()
        weight = matrix(rows.column("weight"))
        constant = np.log(rows.column("prior").to_numpy()) + rows.column("constant").to_numpy()
        return cls(rows.column("class").to_pylist(), np.zeros(weight.shape[1]), constant, weight, np.zeros_like(weight))

    def places(self, x: np.ndarray) -> np.ndarray:
        """The place of the best class of each row; classes are scored a block at a time."""
        y = x - self.center
        best, place = np.full(len(x), -np.inf), np.zeros(len(x), np.int64)
        for low in range(0, len(self.classes), CLASS_BLOCK):
            part = slice(low, low + CLASS_BLOCK)
            scores = y @ self.linear[part].T - (y * y) @ self.square[part].T + self.constant[part]
            top = scores.max(axis=1)
            first = (scores >= (top - 1e-9 * np.maximum(1.0, np.abs(top)))[:, None]).argmax(axis=1)
            better = top > best + 1e-9 * np.maximum(1.0, np.abs(best), where=np.isfinite(best), out=np.ones(len(best)))
            place = np.where(better, low + first, place)
            best = np.maximum(best, top)
        return place

    def transform(self, df: DataFrame, features: str, name: str = "prediction") -> DataFrame:
        """Best class of every row, null without one; batch or streaming frames."""
        kind = "string" if any(isinstance(c, str) for c in self.classes) else "int"
        if not self.classes:
            return df.withColumn(name, F.lit(None).cast(kind))
        classes = np.array(self.classes, dtype=object)
        return score_rows(df, F.col(features), name, kind, lambda x: classes[self.places(x)], len(self.center))


def gaussian_predict(model: DataFrame, test: DataFrame, features: str, name: str = "prediction") -> DataFrame:
    """Log density plus log prior; the class statistics travel with the tasks, so scoring has no shuffle."""
    return DenseBayes.gaussian(model).transform(test, features, name)


def multinomial_fit(terms: DataFrame, docs: DataFrame, label: str, alpha: float, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sparse multinomial model over (doc, term, count) rows.

    Returns per-class (prior, log of the probability of an unseen term) and per (class, term) the
    log probability of the terms that occur in the class.
    """
    priors = class_priors(docs, label)
    by_term = terms.groupBy(F.col(label).alias("class"), "term").agg(F.sum("cnt").cast("double").alias("s"))
    totals = by_term.groupBy("class").agg(F.sum("s").alias("total_s"))
    size = row_total(vocabulary)
    classes = (
        priors.join(totals, "class", "left")
        .withColumn("denominator", F.coalesce("total_s", F.lit(0.0)) + F.lit(alpha) * size)
        .select("class", F.ln("prior").alias("log_prior"), "denominator", F.ln(F.lit(alpha) / F.col("denominator")).alias("log_missing"))
    )
    weights = by_term.join(classes, "class").select(
        "class", "term", (F.ln((F.col("s") + F.lit(alpha)) / F.col("denominator")) - F.col("log_missing")).alias("w")
    )
    return classes, weights


def bernoulli_fit(terms: DataFrame, docs: DataFrame, label: str, alpha: float, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sparse Bernoulli model over (doc, term) presence rows.

    The sum of ln(1 - p) over the vocabulary is a constant of the class, so a document only touches
    its own terms.
    """
    priors = class_priors(docs, label)
    by_term = terms.groupBy(F.col(label).alias("class"), "term").agg(F.count(F.lit(1)).cast("double").alias("s"))
    p = lambda s: (s + F.lit(alpha)) / (F.col("n") + F.lit(2.0 * alpha))
    seen = by_term.join(priors, "class").select(
        "class",
        "term",
        (F.ln(p(F.col("s"))) - F.ln(1.0 - p(F.col("s")))).alias("logit"),
        F.ln(1.0 - p(F.col("s"))).alias("log_absent"),
    )
    sums = seen.groupBy("class").agg(F.sum("log_absent").alias("sum_absent"), F.count(F.lit(1)).alias("seen"))
    size = row_total(vocabulary)
    unseen = p(F.lit(0.0))
    classes = (
        priors.join(sums, "class", "left")
        .select(
            "class",
            (
                F.ln("prior")
                + F.coalesce("sum_absent", F.lit(0.0))
                + (size - F.coalesce("seen", F.lit(0))) * F.ln(1.0 - unseen)
            ).alias("log_prior"),
            (F.ln(unseen) - F.ln(1.0 - unseen)).alias("log_missing"),
        )
    )
    weights = seen.join(classes, "class").select("class", "term", (F.col("logit") - F.col("log_missing")).alias("w"))
    return classes, weights


def sparse_predict(classes: DataFrame, weights: DataFrame, terms: DataFrame, docs: DataFrame, key: str, count: Column) -> DataFrame:
    """All columns of docs and the prediction: the class with the highest log prior + sum of count * log weight.

    Every known term adds count * log_missing of the class; terms seen in the class add the rest. The model stays a table:
    a term's weights of CLASS_BLOCK classes are one map, so that a document's term meets a block once, and sums are
    added per document and block. Both sides of that join are plain shuffles, which adaptive execution splits at a very
    frequent term. Classes within a billionth of the best, relative to its size, count as equal and the first wins.
    """
    numbered = with_rank(classes, [], ["class"], "place").withColumn("block", F.floor(F.col("place") / CLASS_BLOCK).cast("int"))
    numbered = cut_lineage(numbered.withColumn("slot", F.pmod("place", F.lit(CLASS_BLOCK)).cast("int")))
    last = numbered.agg(F.max("block")).first()[0]
    if last is None:
        return docs.withColumn("prediction", F.lit(None).cast(classes.schema["class"].dataType))
    ordered = F.sort_array(F.collect_list(F.struct("slot", "class", "log_prior", "log_missing")))
    blocks = numbered.groupBy("block").agg(ordered.alias("e")).select("block", "e.class", "e.log_prior", "e.log_missing")
    wide = weights.join(numbered.select("class", "block", "slot"), "class").groupBy("term", "block")
    wide = wide.agg(F.map_from_entries(F.collect_list(F.struct("slot", "w"))).alias("w"))
    counted = terms.select(key, "term", count.cast("double").alias("c"))
    hits = counted.join(wide, "term").select(key, "block", F.explode("w").alias("slot", "w"), "c")
    sums = hits.groupBy(key, "block", "slot").agg(F.sum(F.col("c") * F.col("w")).alias("s"))
    sums = sums.groupBy(key, "block").agg(F.map_from_entries(F.collect_list(F.struct("slot", "s"))).alias("s"))
    totals = counted.groupBy(key).agg(F.sum("c").alias("n"))
    met = docs.select(key).join(totals, key, "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last))))
    met = met.join(sums, [key, "block"], "left").join(blocks, "block")
    empty = F.create_map().cast("map<int,double>")
    base = F.zip_with("log_prior", "log_missing", lambda p, m: p + F.coalesce("n", F.lit(0.0)) * m)
    scores = F.transform(base, lambda b, i: b + F.coalesce(F.element_at(F.coalesce("s", empty), i.cast("int")), F.lit(0.0)))
    scored = met.select(key, "block", "class", scores.alias("scores"))
    top = F.array_max("scores")
    level = top - F.lit(1e-9) * F.greatest(F.abs(top), F.lit(1.0))
    first = F.array_position(F.transform("scores", lambda v: v >= level), F.lit(True)).cast("int")
    best = scored.select(key, "block", top.alias("top"), F.element_at("class", first).alias("class"))
    # Of several blocks the first whose best is as good as any.
    step = F.lit(1e-9) * F.greatest(F.abs(F.max("top")), F.lit(1.0))
    held = best.groupBy(key).agg((F.max("top") - step).alias("least"), F.sort_array(F.collect_list(F.struct("block", "top", "class"))).alias("found"))
    chosen = held.select(key, F.get(F.filter("found", lambda f: f["top"] >= F.col("least")), 0)["class"].alias("prediction"))
    return docs.join(chosen, key, "left")


def dense_multinomial_fit(train: DataFrame, features: str, label: str, alpha: float, dims: int) -> DataFrame:
    """Multinomial model over non-negative array features: (sum + a) / (total + a D) per class."""
    sums = F.array(*[F.sum(F.col(features)[i]) for i in range(dims)])
    stats = train.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"), sums.alias("s"))
    grand = F.aggregate("s", F.lit(0.0), lambda t, v: t + v)
    return stats.select(
        "class",
        (F.col("n") / row_total(train)).alias("prior"),
        F.transform("s", lambda v: F.ln((v + F.lit(alpha)) / (grand + F.lit(alpha * dims)))).alias("weight"),
        F.lit(0.0).alias("constant"),
    )


def dense_bernoulli_fit(train: DataFrame, features: str, label: str, alpha: float, dims: int) -> DataFrame:
    """Bernoulli model over 0/1 array features."""
    sums = F.array(*[F.sum(F.col(features)[i]) for i in range(dims)])
    stats = train.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"), sums.alias("s"))
    p = F.transform("s", lambda v: (v + F.lit(alpha)) / (F.col("n") + F.lit(2.0 * alpha)))
    return stats.withColumn("p", p).select(
        "class",
        (F.col("n") / row_total(train)).alias("prior"),
        F.transform("p", lambda v: F.ln(v / (1.0 - v))).alias("weight"),
        F.aggregate("p", F.lit(0.0), lambda t, v: t + F.ln(1.0 - v)).alias("constant"),
    )


def dense_predict(model: DataFrame, test: DataFrame, features: str, name: str = "prediction") -> DataFrame:
    """ln prior + constant + x . weight per class, best class; no shuffle."""
    return DenseBayes.weighted(model).transform(test, features, name)
