"""Gram matrices and summed vectors: the distributed half of every fit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 64


@dataclass
class Gram:
    """Sums over rows of x x', x y, y y and 1."""

    xx: np.ndarray
    xy: np.ndarray
    yy: float
    n: int

    def take(self, index: list[int]) -> "Gram":
        return Gram(self.xx[np.ix_(index, index)], self.xy[index], self.yy, self.n)

    def mean_squared_error(self, weights: np.ndarray) -> float | None:
        """None without rows."""
        if not self.n:
            return None
        value = (self.yy - 2.0 * weights @ self.xy + weights @ self.xx @ weights) / self.n
        return max(0.0, float(value))

    def rmse(self, weights: np.ndarray) -> float | None:
        error = self.mean_squared_error(weights)
        return None if error is None else error**0.5


def _gram_sums(columns: list[Column], target: Column) -> list[Column]:
    items = [*columns, target]
    sums = [
        F.coalesce(F.sum(items[i] * items[j]), F.lit(0.0)).alias(f"g_{i}_{j}")
        for i in range(len(items))
        for j in range(i, len(items))
    ]
    return [F.count(F.lit(1)).alias("n"), *sums]


def _complete(columns: list[Column], target: Column) -> Column:
    """Rows that have every value; the others stay out of all sums alike."""
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in (*columns, target)])


def _read_gram(row, p: int) -> Gram:
    full = np.zeros((p + 1, p + 1))
    for i in range(p + 1):
        for j in range(i, p + 1):
            full[i, j] = full[j, i] = float(row[f"g_{i}_{j}"])
    return Gram(full[:p, :p], full[:p, p], full[p, p], int(row["n"]))


def gram(df: DataFrame, columns: list[Column], target: Column) -> Gram:
    """One generated-code aggregate over scalar columns."""
    return _read_gram(df.where(_complete(columns, target)).agg(*_gram_sums(columns, target)).first(), len(columns))


def gram_by(df: DataFrame, keys: list[Column], columns: list[Column], target: Column) -> dict[tuple, Gram]:
    """A Gram per key tuple in one scan; the keys must have few values (parts, batches, folds)."""
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select(
        *[k.alias(n) for k, n in zip(keys, names)],
        *[c.cast("double").alias(f"_x{i}") for i, c in enumerate(columns)],
        target.cast("double").alias("_y"),
    )
    xs = [F.col(f"_x{i}") for i in range(len(columns))]
    sums = _gram_sums(xs, F.col("_y"))
    rows = keyed.where(_complete(xs, F.col("_y"))).groupBy(*names).agg(*sums).collect()
    return {tuple(row[n] for n in names): _read_gram(row, len(columns)) for row in rows}


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a 2-D array, without copying rows one by one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def vector_batch(vector: np.ndarray) -> pa.RecordBatch:
    """One row holding the vector."""
    values = pa.array(np.ascontiguousarray(vector, dtype="float64"))
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)], names=["vec"])


def sum_vectors(df: DataFrame, fn: Callable[[pa.RecordBatch], np.ndarray | None]) -> np.ndarray | None:
    """Sum fn(batch) over all record batches.

    Each task adds up its own batches and emits one vector. More than FAN_IN vectors are added in
    rounds of FAN_IN on the executors, so the driver never sees more than FAN_IN of them.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fn(batch)
                if part is not None:
                    total = part if total is None else total + part
        if total is not None:
            yield vector_batch(total)

    return add_up(df.mapInArrow(partial, "vec array<double>"))


def add_up(partials: DataFrame) -> np.ndarray | None:
    """Add the rows of a ``vec array<double>`` frame, FAN_IN per task and round."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = matrix(batch.column("vec")).sum(axis=0)
                total = part if total is None else total + part
        if total is not None:
            yield vector_batch(total)

    tasks = partials.rdd.getNumPartitions()
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        partials = partials.repartition(tasks).mapInArrow(add, "vec array<double>")
    collected = partials.toArrow().column("vec")
    return matrix(collected).sum(axis=0) if len(collected) else None


def gram_wide(df: DataFrame, features: str, target: str) -> Gram:
    """Gram of an array column: per-task matrix products, added pairwise."""

    def fn(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column(0))
        y = batch.column(1).to_numpy(zero_copy_only=False)
        return np.concatenate([(x.T @ x).ravel(), x.T @ y, [y @ y, len(y)]])

    data = df.select(F.col(features).cast("array<double>"), F.col(target).cast("double"))
    total = sum_vectors(data, fn)
    p = int(round((-1 + np.sqrt(1 + 4 * (len(total) - 2))) / 2))
    return Gram(total[: p * p].reshape(p, p), total[p * p : p * p + p], float(total[-2]), int(total[-1]))
