"""Regression jobs: the scan is one Gram aggregate, the solve is parameter-sized."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import linear_score_columns
from millrace.functions.hashing import Md5Units
from millrace.operators.linalg import Gram, gram_by, matrix, sum_vectors
from millrace.session import cut_lineage


@dataclass
class LinearModel:
    """Weights over named columns; the last weight is the bias."""

    columns: list[str]
    weights: list[float]

    def score(self) -> Column:
        return linear_score_columns([F.col(c).cast("double") for c in self.columns], self.weights[:-1], self.weights[-1])

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Works on batch and streaming frames alike."""
        return df.withColumn(name, self.score())


def metric_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def part_grams(df: DataFrame, columns: list[Column], target: Column, is_test: Column) -> tuple[Gram, Gram]:
    """Train and test Grams, with a constant last column, from a single scan; a test part without rows has n = 0."""
    grams = gram_by(df, [is_test], [*columns, F.lit(1.0)], target)
    if (False,) not in grams:
        raise ValueError("no complete train row")
    size = len(columns) + 1
    return grams[(False,)], grams.get((True,), Gram(np.zeros((size, size)), np.zeros(size), 0.0, 0))


def solve_normal(g: Gram) -> np.ndarray:
    """(X'X)^-1 X'y; a singular X'X gets the shortest solution."""
    return np.linalg.lstsq(g.xx, g.xy, rcond=None)[0] if np.linalg.matrix_rank(g.xx) < len(g.xy) else np.linalg.solve(g.xx, g.xy)


def normal_weights(train: Gram) -> np.ndarray:
    """The solution after scaling columns to unit root mean square, which keeps the solve well conditioned."""
    scale = np.sqrt(np.diag(train.xx) / train.n)
    scale[scale == 0] = 1.0
    scaled = Gram(train.xx / np.outer(scale, scale), train.xy / scale, train.yy, train.n)
    return solve_normal(scaled) / scale


def normal_equations(df: DataFrame, columns: list[str], target: str, is_test: str = "is_test") -> tuple[LinearModel, float]:
    """Least squares with bias; returns the model and its test RMSE."""
    train, test = part_grams(df, [F.col(c) for c in columns], F.col(target), F.col(is_test))
    weights = normal_weights(train)
    return LinearModel(columns, list(weights)), test.rmse(weights)


def log_strengths(low: float = 0.01, high: float = 10.0, n: int = 500) -> np.ndarray:
    return np.exp(np.log(low) + np.arange(n) * (np.log(high) - np.log(low)) / (n - 1))


def ridge_path(train: Gram, strengths: np.ndarray) -> np.ndarray:
    """Ridge weights for every strength from one Gram; the last column is the free intercept."""
    p = len(train.xy) - 1
    mean_x, mean_y = train.xx[:p, p] / train.n, train.xy[p] / train.n
    sxx = train.xx[:p, :p] - train.n * np.outer(mean_x, mean_x)
    sxy = train.xy[:p] - train.n * mean_x * mean_y
    values, vectors = np.linalg.eigh(sxx)
    rotated = vectors.T @ sxy
    slopes = (rotated / (values + strengths[:, None])) @ vectors.T
    return np.column_stack([slopes, mean_y - slopes @ mean_x])


def ridge_sweep(df: DataFrame, columns: list[Column], target: Column, is_test: Column, strengths=None) -> DataFrame:
    """Test RMSE of every strength, from one scan."""
    strengths = log_strengths() if strengths is None else np.asarray(strengths, dtype=float)
    train, test = part_grams(df, columns, target, is_test)
    paths = ridge_path(train, strengths)
    rows = [(i, float(a), test.rmse(w)) for i, (a, w) in enumerate(zip(strengths, paths))]
    return metric_table(df.sparkSession, rows, "step INT, strength DOUBLE, rmse DOUBLE")


def best_of(sweep: DataFrame, metric: str, order: str, largest: bool = False) -> DataFrame:
    """First best row of a sweep."""
    return sweep.orderBy(F.col(metric).desc() if largest else F.col(metric), order).limit(1)


def order_sweep(df: DataFrame, x: Column, target: Column, is_test: Column, max_order: int = 9) -> DataFrame:
    """Test RMSE for the power features x .. x^m, m = 1 .. max_order.

    The powers are taken of x scaled to [-1, 1], which spans the same functions and keeps the Gram
    matrix well conditioned; lower orders are blocks of the same matrix.
    """
    bounds = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    half = (bounds.hi - bounds.lo) / 2.0 or 1.0
    unit = (x - F.lit(float(bounds.lo))) / F.lit(float(half)) - 1.0
    powers = [F.pow(unit, F.lit(float(i))) for i in range(1, max_order + 1)]
    train, test = part_grams(df, powers, target, is_test)
    rows = []
    for order in range(1, max_order + 1):
        index = [*range(order), max_order]
        weights = solve_normal(train.take(index))
        rows.append((order, test.take(index).rmse(weights)))
    return metric_table(df.sparkSession, rows, "order INT, rmse DOUBLE")


def linear_gradient(
    df: DataFrame,
    columns: list[Column],
    target: Column,
    is_test: Column,
    epochs: int,
    rate: float,
    l2: float = 0.0,
    batches: int = 1,
    keys: list[Column] | None = None,
    seed=42,
) -> tuple[np.ndarray, DataFrame]:
    """Mini-batch gradient steps w -= rate * (mean((x.w - y) x) + l2 w), bias included in w.

    The gradient of a batch only needs the Gram of that batch, so every epoch and batch comes from one scan in which
    each task adds up its own sums and no row is copied. The sums are reduced by (epoch, batch) and read in that order.
    """
    xs = [*columns, F.lit(1.0)]
    whole, sums = batch_grams(df, xs, target, is_test, epochs if batches > 1 else 0, batches, keys or [], seed)
    train, test = whole
    weights = np.zeros(len(xs))
    rows = []
    for epoch in range(epochs):
        for g in [train] if batches == 1 else (next(sums) for _ in range(batches)):
            if g.n:
                weights = weights - rate * ((g.xx @ weights - g.xy) / g.n + l2 * weights)
        rows.append((epoch + 1, train.rmse(weights), test.rmse(weights)))
    return weights, metric_table(df.sparkSession, rows, "epoch INT, train_rmse DOUBLE, test_rmse DOUBLE")


def batch_grams(
    df: DataFrame, xs: list[Column], target: Column, is_test: Column, epochs: int, batches: int, keys: list[Column], seed
) -> tuple[tuple[Gram, Gram], Iterator[Gram]]:
    """Grams of the train and test rows, and those of every batch of every epoch in order, from one scan.

    A task holds the sums of epochs x batches x columns squared, whatever its rows. The driver reads one batch at a time.
    """
    q = len(xs) + 1
    upper = np.triu_indices(q)
    cells = len(upper[0]) + 1
    complete = target.isNotNull()
    for x in xs:
        complete &= x.isNotNull()
    items = F.array(*[c.cast("double") for c in (*xs, target)])
    code = F.concat_ws("-", *[k.cast("string") for k in keys]) if keys else F.lit("")
    data = df.where(complete & is_test.isNotNull()).select(items.alias("z"), is_test.alias("t"), code.alias("k"))

    def add(parts):
        total = np.zeros((epochs * batches + 2, cells))
        for batch in parts:
            if not batch.num_rows:
                continue
            z, tests = matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            products = np.column_stack([z[:, upper[0]] * z[:, upper[1]], np.ones(len(z))])
            total[-1] += products[tests].sum(axis=0)
            products = products[~tests]
            total[-2] += products.sum(axis=0)
            codes = [c.encode() for c, t in zip(batch.column(2).to_pylist(), tests) if not t] if epochs else []
            units, columns = Md5Units(codes), np.ascontiguousarray(products.T)
            for epoch in range(epochs):
                # The same digest and bucket as batch_number().
                number = np.floor(units(f"{seed}-{epoch}-".encode()) * batches).astype(int)
                for cell in range(cells):
                    total[epoch * batches : (epoch + 1) * batches, cell] += np.bincount(number, weights=columns[cell], minlength=batches)
        place, cell = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(place), "cell": pa.array(cell), "v": pa.array(total[place, cell])})

    reduced = data.mapInArrow(add, "place bigint, cell bigint, v double").groupBy("place", "cell").agg(F.sum("v").alias("v"))
    reduced = cut_lineage(reduced)

    def gram_of(values: np.ndarray) -> Gram:
        full = np.zeros((q, q))
        full[upper] = values[:-1]
        full = full + np.triu(full, 1).T
        return Gram(full[:-1, :-1], full[:-1, -1], full[-1, -1], int(round(values[-1])))

    ends = np.zeros((2, cells))
    for r in reduced.where(F.col("place") >= epochs * batches).collect():
        ends[r["place"] - epochs * batches, r["cell"]] = r["v"]
    if not ends[0, -1]:
        raise ValueError("no complete train row")

    def in_order() -> Iterator[Gram]:
        rows = reduced.where(F.col("place") < epochs * batches).orderBy("place", "cell").toLocalIterator()
        row = next(rows, None)
        for place in range(epochs * batches):
            values = np.zeros(cells)
            while row is not None and row["place"] == place:
                values[row["cell"]] = row["v"]
                row = next(rows, None)
            yield gram_of(values)

    return (gram_of(ends[0]), gram_of(ends[1])), in_order()


class PolynomialMap:
    """Exact finite feature map of the kernel (gamma x.y + 1)**degree: monomials by degree, each from one of a degree less."""

    def __init__(self, dims: int, degree: int = 2, gamma: float = 1.0):
        self.dims, self.degree, self.gamma = dims, degree, gamma
        self.size = comb(dims + degree, degree)
        #: Per degree from 1 on: the place of the shorter monomial one degree below, and the column it is multiplied by.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        scales = [np.ones(1)]
        last, run = np.full(1, 0), np.zeros(1)
        for used in range(1, degree + 1):
            # Columns rise along a monomial, so that each set of factors is met once.
            reps = dims - last
            parent = np.repeat(np.arange(len(last)), reps)
            column = np.concatenate([np.arange(i, dims) for i in last]) if dims else np.zeros(0, int)
            same = np.where(column == last[parent], run[parent], 0) + 1 if used > 1 else np.ones(len(column))
            # Ways to order the factors: one more factor multiplies them by its place over its own repetitions.
            scales.append(scales[-1][parent] * (gamma * (degree - used + 1) / same) ** 0.5)
            self.levels.append((parent, column))
            last, run = column, same
        self.scales = np.concatenate(scales)

    def apply(self, x: np.ndarray) -> np.ndarray:
        parts = [np.ones((len(x), 1))]
        for parent, column in self.levels:
            parts.append(parts[-1][:, parent] * x[:, column])
        return np.concatenate(parts, axis=1) * self.scales


class FourierMap:
    """Random Fourier features of the kernel exp(-gamma |x - y|^2); error falls as 1/sqrt(size)."""

    def __init__(self, dims: int, size: int = 256, gamma: float = 1.0, seed: int = 42):
        generator = np.random.RandomState(seed)
        self.size = size
        self.frequencies = generator.normal(scale=(2.0 * gamma) ** 0.5, size=(dims, size))
        self.phases = generator.uniform(0.0, 2.0 * np.pi, size=size)

    @classmethod
    def of(cls, frequencies: np.ndarray, phases: np.ndarray) -> "FourierMap":
        """The map with these waves."""
        made = cls(0, 0)
        made.size, made.frequencies, made.phases = len(phases), frequencies, phases
        return made

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (2.0 / self.size) ** 0.5 * np.cos(x @ self.frequencies + self.phases)


def kernel_map(kind: str, dims: int, gamma: float, degree: int = 2, size: int = 256, seed: int = 42):
    """'poly' is exact; every other name is the radial kernel."""
    return PolynomialMap(dims, degree, gamma) if kind == "poly" else FourierMap(dims, size, gamma, seed)


def kernel_regression(
    df: DataFrame,
    features: Column,
    target: Column,
    is_test: Column,
    feature_map,
    iterations: int = 200,
    rate: float = 0.01,
    l2: float = 0.02,
) -> tuple[np.ndarray, float, DataFrame]:
    """Kernel regression with the bias fixed at the mean training target.

    One dual step changes each beta by -rate * error / n and then shrinks all betas by l2 * rate.
    In the mapped space the same step is w -= rate * mean(error * phi), w *= 1 - l2 * rate, which
    needs the mapped Gram only: one scan whatever the number of iterations, no pair of rows.
    """
    data = df.select(features.cast("array<double>").alias("x"), target.cast("double").alias("y"), is_test.alias("t"))
    size = feature_map.size
    block = size * size + size + 3

    def fn(batch: pa.RecordBatch) -> np.ndarray:
        mapped = feature_map.apply(matrix(batch.column(0)))
        y = batch.column(1).to_numpy(zero_copy_only=False)
        tests = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        sums = []
        for part in (~tests, tests):
            a, b = mapped[part], y[part]
            full = np.column_stack([a, b])
            product = full.T @ full
            sums.append(np.concatenate([product[:size, :size].ravel(), product[:size, size], [product[size, size], b.sum(), len(b)]]))
            sums.append(a.sum(axis=0))
        return np.concatenate(sums)

    total = sum_vectors(data, fn)
    grams = []
    bias = None
    for part in (0, 1):
        start = part * (block + size)
        values = total[start : start + block]
        phi_sum = total[start + block : start + block + size]
        n = int(round(values[-1]))
        xx = values[: size * size].reshape(size, size)
        xy = values[size * size : size * size + size]
        yy, y_sum = values[-3], values[-2]
        if bias is None:
            bias = y_sum / n
        # Errors are taken against y - bias.
        grams.append(Gram(xx, xy - bias * phi_sum, yy - 2 * bias * y_sum + n * bias * bias, n))
    train, test = grams
    weights = np.zeros(size)
    rows = []
    for i in range(iterations):
        weights = weights - rate * (train.xx @ weights - train.xy) / train.n
        weights = weights - l2 * rate * weights
        rows.append((i + 1, train.rmse(weights), test.rmse(weights)))
    table = metric_table(df.sparkSession, rows, "iteration INT, train_rmse DOUBLE, test_rmse DOUBLE")
    return weights, float(bias), table
