"""Grid search: every fold, strength and degree is fitted by the same scans."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from millrace.operators.linalg import matrix, sum_vectors
from millrace.plans.classification import cached_evenly
from millrace.plans.solver import VECTOR_CELLS, minimise, row_parts


def expanded(x: np.ndarray, degree: int) -> np.ndarray:
    """All monomials from degree 1 up to ``degree`` and a last constant column."""
    n, dims = x.shape
    held = np.empty((comb(dims + degree, degree), n))  # a monomial is a row, so that whole runs are multiplied at once
    held[:dims] = x.T
    level, begin = [(i, i) for i in range(dims)], dims  # place and last factor of each monomial of the degree before
    for _ in range(1, degree):
        made = []
        for at, i in level:
            stop = begin + dims - i
            np.multiply(held[at], held[i:dims], out=held[begin:stop])
            made += zip(range(begin, stop), range(i, dims))
            begin = stop
        level = made
    held[-1] = 1.0
    return held.T


def grid_search(
    df: DataFrame,
    features: Column,
    label: Column,
    fold: Column,
    dims: int,
    degrees: list[int],
    strengths: list[float],
    folds: int = 5,
    tolerance: float = 1e-4,
) -> DataFrame:
    """Cross-validated accuracy and loss of L2 logistic models per (degree, C), refit and test accuracy.

    features are scaled on train; fold is 0 .. folds-1 on train rows and -1 on test rows. Each model
    minimises C * log loss + |w|^2 / 2 with a free intercept until its gradient is ``tolerance`` times the first.
    For every combination there are ``folds`` models that leave one fold out and one refit on all train rows.
    One scan moves all models that are not done, in blocks of VECTOR_CELLS values; no width has another rule. ``loss``
    is what the refit reached, by row.
    """
    left_out = np.array([f for _ in strengths for f in range(folds + 1)])  # fold == folds: refit
    power = np.repeat(np.asarray(strengths, dtype=float), folds + 1)
    models = len(left_out)
    sizes = {d: comb(dims + d, d) for d in degrees}
    data = df.select(features.cast("array<double>").alias("x"), label.cast("double").alias("y"), fold.cast("int").alias("f"))

    def parts(batch: pa.RecordBatch):
        x, y, f = matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
        for part in row_parts(len(x), max(sizes.values())):
            yield x[part], y[part], f[part]

    with cached_evenly(data) as dealt:
        def start(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros(2 * sum(sizes.values()) + folds)
            for x, _, f in parts(batch):
                wide = [expanded(x[f >= 0], d) for d in degrees]
                sums = [np.concatenate([e.sum(axis=0), (e * e).sum(axis=0)]) for e in wide]
                total += np.concatenate([*sums, np.bincount(f[f >= 0], minlength=folds)[:folds]])
            return total

        total = sum_vectors(dealt, start)
        total = np.zeros(2 * sum(sizes.values()) + folds) if total is None else total
        per_fold = total[-folds:]
        count = np.maximum(np.array([per_fold.sum() - (per_fold[f] if f < folds else 0.0) for f in left_out]), 1.0)
        shrink = 1.0 / (power * count)
        # The intercept is free, so weights may be sought for centred columns: the same optimum, reached in far fewer scans.
        center, spread = {}, {}
        rows = max(per_fold.sum(), 1.0)
        for d, sums in zip(degrees, np.split(total[:-folds], np.cumsum([2 * sizes[d] for d in degrees])[:-1])):
            center[d] = sums[: sizes[d] - 1] / rows
            spread[d] = np.append(np.maximum(sums[sizes[d] : -1] / rows - center[d] ** 2, 0.0), 1.0)
        tasks = [(d, j) for d in degrees for j in range(models)]
        blocks, used = [[]], 0
        for task in tasks:
            if blocks[-1] and used + sizes[task[0]] > VECTOR_CELLS:
                blocks.append([])
                used = 0
            blocks[-1].append(task)
            used += sizes[task[0]]
        weights = {d: np.zeros((sizes[d], models)) for d in degrees}
        losses = {d: np.zeros(models) for d in degrees}
        for block in blocks:

            def evaluate(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
                moving = {d: [i for i in sorted(points) if block[i][0] == d] for d in degrees}
                now = {d: np.column_stack([points[i] for i in own]) for d, own in moving.items() if own}
                which = {d: np.array([block[i][1] for i in own]) for d, own in moving.items() if own}
                ends = {d: (sizes[d] + 1) * w.shape[1] for d, w in now.items()}
                plain = {d: np.vstack([w[:-1], w[-1] - center[d] @ w[:-1]]) for d, w in now.items()}

                def slope(batch: pa.RecordBatch) -> np.ndarray:
                    total = np.zeros(sum(ends.values()))
                    for x, y, f in parts(batch):
                        keep = f >= 0
                        x, y, f = x[keep], y[keep], f[keep]
                        sums = []
                        for d, w in plain.items():
                            uses = f[:, None] != left_out[which[d]][None, :]
                            e = expanded(x, d)
                            z = e @ w
                            loss = np.logaddexp(0.0, z) - y[:, None] * z
                            p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
                            sums.append(np.vstack([(loss * uses).sum(axis=0)[None, :], e.T @ ((p - y[:, None]) * uses)]).ravel())
                        total += np.concatenate(sums)
                    return total

                total = sum_vectors(dealt, slope)
                total = np.zeros(sum(ends.values())) if total is None else total
                made = {}
                for (d, w), part in zip(now.items(), np.split(total, np.cumsum(list(ends.values()))[:-1])):
                    part = part.reshape(sizes[d] + 1, -1) / count[which[d]]
                    part[1:-1] -= np.outer(center[d], part[-1])
                    penalty = shrink[which[d]] * w
                    penalty[-1] = 0.0
                    part[0] += (penalty * w).sum(axis=0) / 2.0
                    for k, i in enumerate(moving[d]):
                        made[i] = (float(part[0, k]), part[1:, k] + penalty[:, k])
                return made

            curved = [1.0 / (0.25 * spread[d] + shrink[j]) for d, j in block]
            for (d, j), model in zip(block, minimise(evaluate, [np.zeros(sizes[d]) for d, _ in block], curved, tolerance)):
                weights[d][:, j], losses[d][j] = model.x, model.loss
                weights[d][-1, j] -= center[d] @ model.x[:-1]

        def judge(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros((1 + len(degrees)) * models)
            for x, y, f in parts(batch):
                # A model is judged on its own left-out fold; a refit on the test rows.
                own = np.where(left_out[None, :] == folds, f[:, None] == -1, f[:, None] == left_out[None, :])
                hits = [((expanded(x, d) @ weights[d] > 0) == (y[:, None] > 0.5)) & own for d in degrees]
                total += np.concatenate([own.sum(axis=0), *[h.sum(axis=0) for h in hits]])
            return total

        total = sum_vectors(dealt, judge)
        total = np.zeros((1 + len(degrees)) * models) if total is None else total
    seen = np.maximum(total[:models], 1.0)
    table = []
    for i, d in enumerate(degrees):
        share = (total[(i + 1) * models : (i + 2) * models] / seen).reshape(len(strengths), folds + 1)
        for c, row, loss in zip(strengths, share, losses[d].reshape(len(strengths), folds + 1)):
            table.append((int(d), float(c), float(row[:folds].mean()), float(row[folds]), float(loss[folds])))
    best = max(range(len(table)), key=lambda i: (round(table[i][2], 9), -i))
    rows = [(*r, i == best) for i, r in enumerate(table)]
    return df.sparkSession.createDataFrame(rows, "degree INT, strength DOUBLE, cv_accuracy DOUBLE, test_accuracy DOUBLE, loss DOUBLE, best BOOLEAN")
