"""Kernel machines: scoring from a support table, fitting on explicit feature maps, one-vs-one."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import sign_label
from millrace.operators.blocks import block_join
from millrace.operators.linalg import matrix, sum_vectors
from millrace.operators.metrics import majority
from millrace.operators.scoring import score_rows
from millrace.plans.classification import cached
from millrace.plans.solver import VECTOR_CELLS, minimise, row_parts

SUPPORT_CELLS = 4_000_000  # values of a support table that may travel with a task


def kernel_matrix(a: np.ndarray, b: np.ndarray, kind: str, gamma: float, degree: int) -> np.ndarray:
    if kind == "poly":
        return (gamma * (a @ b.T) + 1.0) ** degree
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.exp(-gamma * np.maximum(squared, 0.0))


def kernel_scores(
    rows: DataFrame, key: str, features: str, supports: DataFrame, bias: float = 0.0, kind: str = "rbf", gamma: float = 1.0, degree: int = 2
) -> DataFrame:
    """sum of weight * K(x, support) + bias for every row; supports has columns sv, weight.

    A support table within SUPPORT_CELLS values travels with the tasks and scoring is one narrow
    pass. A larger one is met block by block, and the partial sums are added per row.
    """
    asked = rows.select(F.col(key).alias("key"), F.col(features).cast("array<double>").alias("x"))
    table = supports.select(F.col("sv").cast("array<double>").alias("sv"), F.col("weight").cast("double").alias("weight"))
    shape = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("sv")).alias("d")).first()
    if shape.n * (shape.d or 1) <= SUPPORT_CELLS:
        held = table.orderBy("sv").toArrow()
        sv, weight = matrix(held.column("sv")), held.column("weight").to_numpy()

        def score(batches):
            for batch in batches:
                x = matrix(batch.column(1))
                if not len(x):
                    continue
                values = kernel_matrix(x, sv, kind, gamma, degree) @ weight + bias
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["key", "score"])

        return asked.mapInArrow(score, "key bigint, score double")

    def partial(a: pa.Table, b: pa.Table) -> pa.Table:
        values = kernel_matrix(matrix(a.column("x")), matrix(b.column("sv")), kind, gamma, degree) @ b.column("weight").to_numpy()
        return pa.table({"key": a.column("key"), "part": pa.array(values)})

    left = asked.withColumn("cell", F.lit(0))
    right = table.withColumn("cell", F.lit(0)).withColumn("sid", F.xxhash64("sv", "weight"))
    parts = block_join(left, right, "cell", "key", "sid", partial, "key bigint, part double")
    return parts.groupBy("key").agg((F.sum("part") + F.lit(bias)).alias("score"))


def kernel_labels(scores: DataFrame) -> DataFrame:
    return scores.withColumn("prediction", sign_label(F.col("score")))


def class_pairs(df: DataFrame, label: str) -> DataFrame:
    """Every pair of classes i < j."""
    classes = df.select(F.col(label).alias("first")).distinct()
    others = classes.select(F.col("first").alias("second"))
    return classes.join(others, F.col("first") < F.col("second"))  # classes x classes rows


@dataclass
class PairMachines:
    """One machine per class pair on the features of a map: weights (features + bias) x pairs, and the losses reached."""

    pairs: list[tuple[int, int]]
    weights: np.ndarray
    losses: np.ndarray
    feature_map: object

    def transform(self, df: DataFrame, features: str, name: str = "prediction") -> DataFrame:
        """Majority vote, lowest class on ties, in one narrow pass; batch or streaming frames."""
        classes, _, at = _places(self.pairs)
        weights, feature_map = self.weights, self.feature_map

        def vote(x: np.ndarray) -> np.ndarray:
            votes = np.zeros((len(x), len(classes)), dtype=np.int64)
            for part in row_parts(len(x), len(weights) + len(at)):
                wins = _with_ones(feature_map.apply(x[part])) @ weights > 0
                for c in range(len(classes)):
                    votes[part, c] = wins[:, at[:, 0] == c].sum(axis=1) + (~wins[:, at[:, 1] == c]).sum(axis=1)
            return classes[votes.argmax(axis=1)]

        return score_rows(df, F.col(features), name, "int", vote)


def _with_ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def _places(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, dict, np.ndarray]:
    """The classes of the pairs, rising, their places, and the places of each pair."""
    classes = np.array(sorted({c for p in pairs for c in p}))
    place = {c: i for i, c in enumerate(classes.tolist())}
    return classes, place, np.array([[place[a], place[b]] for a, b in pairs]).reshape(-1, 2)


def rounded_hinge(margin: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """Hinge loss with its corner rounded over `smoothing`, and how much a larger margin would take off it."""
    lack = 1.0 - margin
    slope = np.clip(lack / smoothing, 0.0, 1.0)
    return slope * (lack - slope * smoothing / 2.0), slope


def fit_pair_machines(
    df: DataFrame,
    features: Column,
    label: Column,
    is_test: Column,
    pairs: list[tuple[int, int]],
    feature_map,
    strength: float = 1.0,
    tolerance: float = 1e-4,
    smoothing: float = 0.1,
) -> PairMachines:
    """Soft-margin machines of class pairs on explicit kernel features.

    Minimises |w|^2 / 2 + C * hinge per pair, the corner of the hinge rounded over ``smoothing`` and the bias free, until
    the gradient is ``tolerance`` times the first one. One scan serves all pairs that still move: a row adds only to the
    pairs of its own class. Pairs are fitted in blocks of VECTOR_CELLS values, so that neither width nor number of
    classes meets a limit or another rule.
    """
    size, m = feature_map.size + 1, len(pairs)
    classes, place, at = _places(pairs)
    data = df.where(~is_test).select(features.cast("array<double>").alias("x"), label.cast("int").alias("y"))
    data = data.where(F.col("y").isin(classes.tolist()) & F.col("x").isNotNull()) if m else data

    def by_class(batch: pa.RecordBatch):
        x, y = matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
        for part in row_parts(len(x), size):
            mapped = _with_ones(feature_map.apply(x[part]))
            for c in np.unique(y[part]):
                yield place[int(c)], mapped[y[part] == c]

    weights, losses = np.zeros((size, m)), np.zeros(m)
    if not m:
        return PairMachines(pairs, weights, losses, feature_map)
    with cached(data):

        def extent(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros((len(classes), 2 * size))
            for c, x in by_class(batch):
                total[c] += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])
            return total.ravel()

        sums = sum_vectors(data, extent)
        sums = (np.zeros(len(classes) * 2 * size) if sums is None else sums).reshape(len(classes), 2 * size)
        both = sums[at[:, 0]] + sums[at[:, 1]]
        count = np.maximum(both[:, size - 1], 1.0)
        shrink = 1.0 / (strength * count)
        # The bias is free, so weights may be sought for centred features: the same optimum, reached in far fewer scans.
        mean = both[:, : size - 1] / count[:, None]
        spread = np.maximum(both[:, size:-1] / count[:, None] - mean * mean, 0.0)
        block = max(1, VECTOR_CELLS // size)
        for begin in range(0, m, block):
            here = range(begin, min(begin + block, m))

            def evaluate(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
                moving = np.array(sorted(points))
                w = np.column_stack([points[i] for i in moving])
                where, center = at[moving + begin], mean[moving + begin].T
                plain = w.copy()
                plain[-1] -= (center * w[:-1]).sum(axis=0)

                def fn(batch: pa.RecordBatch) -> np.ndarray:
                    total = np.zeros((size + 1, len(moving)))
                    for c, x in by_class(batch):
                        for side, sign in ((0, 1.0), (1, -1.0)):
                            own = np.flatnonzero(where[:, side] == c)
                            if len(own):
                                loss, slope = rounded_hinge(sign * (x @ plain[:, own]), smoothing)
                                total[0, own] += loss.sum(axis=0)
                                total[1:, own] -= sign * (x.T @ slope)
                    return total.ravel()

                total = sum_vectors(data, fn)
                total = (np.zeros((size + 1) * len(moving)) if total is None else total).reshape(size + 1, -1) / count[moving + begin]
                total[1:-1] -= center * total[-1]
                penalty = shrink[moving + begin] * w
                penalty[-1] = 0.0  # the bias is not shrunk
                total[0] += (penalty * w).sum(axis=0) / 2.0
                return {int(i): (float(total[0, k]), total[1:, k] + penalty[:, k]) for k, i in enumerate(moving)}

            curved = [1.0 / (np.append(spread[j], 1.0) / smoothing + shrink[j]) for j in here]
            for j, model in zip(here, minimise(evaluate, [np.zeros(size) for _ in here], curved, tolerance)):
                weights[:, j], losses[j] = model.x, model.loss
                weights[-1, j] -= mean[j] @ model.x[:-1]
    return PairMachines(pairs, weights, losses, feature_map)


def fit_pairs(df: DataFrame, features: Column, label: Column, is_test: Column, pairs, feature_map, strength: float = 1.0, tolerance: float = 1e-4) -> np.ndarray:
    """Weights (features + bias) x pairs of fit_pair_machines()."""
    return fit_pair_machines(df, features, label, is_test, pairs, feature_map, strength, tolerance).weights


def pair_votes(df: DataFrame, key: str, features: str, pairs: list[tuple[int, int]], weights: np.ndarray, feature_map) -> DataFrame:
    """(key, prediction): majority vote of all pair machines, lowest class on ties; one narrow pass."""
    asked = df.select(F.col(key).alias("key"), F.col(features).alias("x"))
    return PairMachines(pairs, weights, np.zeros(len(pairs)), feature_map).transform(asked, "x").select("key", "prediction")


def vote_table(votes: DataFrame, key: str, label: str) -> DataFrame:
    """Majority vote over a long table of votes."""
    return votes.groupBy(key).agg(majority(F.col(label)).alias("prediction"))
