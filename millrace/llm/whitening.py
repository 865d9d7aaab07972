"""Embedding whitening: exact covariance sums by Spark, leading components by contour integration (FEAST)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.linalg import matrix

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Nodes of the quadrature on the upper half circle, and rounds of subspace iteration at most.
NODES, ROUNDS = 8, 60
#: Eigenvalues below this share of the matrix norm are rounding: four digits of a smaller one would not be sure.
ROUNDING = 1e-11
_LONG = 2**63 - 1


# --- the eigenvalues of a symmetric matrix in an interval -------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to v, by reflections."""
    a = v.copy()
    for k in range(len(a) - 2):
        u = a[k + 1 :, k].copy()
        length = np.sqrt(u @ u)
        if length == 0:
            continue
        u[0] += length if u[0] >= 0 else -length
        u /= np.sqrt(u @ u)
        part = a[k + 1 :, k + 1 :]
        p = part @ u
        p -= u * (u @ p)
        a[k + 1 :, k + 1 :] = part - 2 * (np.outer(u, p) + np.outer(p, u))
        a[k + 1 :, k] -= 2 * u * (u @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed the shift: the positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    above, pivot = 0, 1.0
    tiny = float(np.finfo(float).eps) * (float(np.abs(diagonal).max()) + float(np.abs(off).max(initial=0.0))) + 1e-300
    for d, e in zip(diagonal.tolist(), [0.0, *off.tolist()]):
        pivot = d - shift - e * e / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def contour_pairs(v: np.ndarray, low: float, high: float, count: int, known: np.ndarray) -> np.ndarray:
    """Vectors of the `count` eigenvalues between low and high; `known` vectors, of other eigenvalues, are kept out.

    A filtered subspace is the sum over nodes z of a circle through low and high of the solutions of (z - v) x = y,
    weighed by Gauss-Legendre quadrature; Rayleigh-Ritz takes values and vectors from it. Repeated until what is left
    of v x - e x is rounding. Finding other than `count` values is an error.
    """
    n = len(v)
    at, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (1 - at) / 2)
    center, radius = (low + high) / 2, (high - low) / 2
    width = min(n - known.shape[1], count + max(4, count // 2))
    fresh = np.random.default_rng(7).standard_normal
    y, best, found, worse = fresh((n, width)), np.inf, None, 0
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for t, w in zip(turn, weight):
            q += 0.5 * w * radius * np.real(t * np.linalg.solve((center + radius * t) * np.eye(n) - v, y.astype(complex)))
        for _ in range(2):
            q -= known @ (known.T @ q)
        basis, sizes, _ = np.linalg.svd(q, full_matrices=False)
        basis = basis[:, sizes > sizes[0] * 1e-14]
        ritz, turned = np.linalg.eigh(basis.T @ v @ basis)
        y = basis @ turned
        inside = np.flatnonzero((ritz > low) & (ritz <= high))
        left = np.abs(v @ y[:, inside] - y[:, inside] * ritz[inside]).max(initial=0.0)
        if len(inside) == count:
            worse = worse + 1 if left > 0.8 * best else 0
            if left < best:
                best, found = left, y[:, inside]
            if best <= 1e-15 or (worse > 1 and best <= 1e-12):
                break
        if y.shape[1] < width:
            y = np.hstack([y, fresh((n, width - y.shape[1]))])
    if found is None or best > 1e-9:
        raise ArithmeticError(f"an interval of {count} eigenvalues was not solved")
    return found


def top_pairs(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; those that are zero but for rounding stay out.

    Inertia counts set an edge below the wanted values, or below all that cannot be told from the last, and cut what
    is above it where values differ by orders. Each interval is solved by its contour and must hold what its inertia says.
    """
    n = len(v)
    reach = np.abs(v).sum(axis=1).max(initial=0.0)
    if not reach > 0:
        return np.zeros(0), np.zeros((n, 0))
    v = (v + v.T) / (2 * reach)
    held = tridiagonal(v)
    floor, high = max(ROUNDING, n * 1e-14), 1 + 1e-9
    wanted = min(wanted, count_above(*held, floor))
    low, over = floor, high
    while over - low > 1e-9 and count_above(*held, low) != wanted:
        middle = (low + over) / 2
        if count_above(*held, middle) >= wanted:
            low = middle
        else:
            over = middle
    spans, vectors = [(low, high)], np.zeros((n, 0))
    while spans:
        a, b = spans.pop()
        count = count_above(*held, a) - count_above(*held, b)
        if count and b > 4 * a and b - a > 1e-6:
            # The upper part is solved first: its vectors are kept out of the lower one.
            middle = float(np.sqrt(a * b))
            spans += [(a, middle), (middle, b)]
        elif count:
            vectors = np.hstack([vectors, contour_pairs(v, a, b, count, vectors)])
    basis, _ = np.linalg.qr(vectors)
    values, turned = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order] * reach, basis @ turned[:, order]


# --- sums by Spark -----------------------------------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def _levels(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x as 64-bit integers) by vector length; an x beyond 64 bits becomes the nearest that has them."""
    values = batch.column(column)
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        v = np.floor(matrix(values.take(pa.array(at))) * SCALE)
        edge = float(2**62)
        x = np.where(np.abs(v) < edge, v, 0.0).astype(np.int64) + SHIFT
        if np.abs(v).max() >= edge:
            wide = np.abs(v) >= edge
            x[wide] = [min(max(int(c) + SHIFT, -_LONG - 1), _LONG) if np.isfinite(c) else (_LONG if c > 0 else -_LONG - 1) for c in v[wide]]
        yield at, x


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length: n and the exact sum of x of every dimension, in two halves of 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, x in _levels(batch, 0) if batch.num_rows else ():
                part = np.array([np.full(x.shape[1], len(at)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + part
        for size, (n, high, low) in totals.items():
            columns = [np.full(size, size), np.arange(size), n, high, low]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "i", "n", "high", "low"])

    parts = rows.mapInArrow(run, "size bigint, i bigint, n bigint, high bigint, low bigint")
    found: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("size", "i").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).orderBy("size", "i").collect():
        found.setdefault(r["size"], (r["n"], []))[1].append((r["high"] << 32) + r["low"])
    return found


def _products(rows: DataFrame, centers: dict[int, list[int]]) -> dict[int, np.ndarray]:
    """Per vector length: sums of products of x - center, centers being whole numbers.

    Products of whole numbers below 2**53 in sum are exact as doubles; they are added up in two halves as integers,
    so that neither order nor repeated tasks change a digit. Larger ones are added as doubles.
    """
    sent = rows.sparkSession.sparkContext.broadcast(centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact: dict[int, np.ndarray] = {}
        rough: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _levels(batch, 0) if batch.num_rows else ():
                size = x.shape[1]
                center = np.array(sent.value[size], dtype=np.int64)
                y = x.astype(float) - center
                most = np.abs(y).max()
                high, low = exact.setdefault(size, np.zeros((2, size, size), np.int64))
                rough.setdefault(size, np.zeros((size, size)))
                if most < 2**26 and most**2 * len(y) < 2**53:
                    part = (y.T @ y).astype(np.int64)
                    high += part >> 32
                    low += part & 0xFFFFFFFF
                else:
                    rough[size] += y.T @ y
        for size, (high, low) in exact.items():
            i, j = np.triu_indices(size)
            columns = [np.full(len(i), size), i, j, high[i, j], low[i, j], rough[size][i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "i", "j", "high", "low", "rough"])

    parts = rows.mapInArrow(run, "size bigint, i bigint, j bigint, high bigint, low bigint, rough double")
    sums = parts.groupBy("size", "i", "j").agg(*[F.sum(c).alias(c) for c in ("high", "low", "rough")]).toArrow()
    size, i, j, high, low, rough = (sums.column(c).to_numpy() for c in ("size", "i", "j", "high", "low", "rough"))
    out = {}
    for s in centers:
        at = size == s
        made = np.zeros((s, s))
        made[i[at], j[at]] = high[at].astype(float) * 2.0**32 + low[at] + rough[at]
        out[s] = np.triu(made) + np.triu(made, 1).T
    return out


# --- the operator ------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """For vectors of one length: n, sums of x, components as columns, their eigenvalues and shares."""

    n: int
    sums: list[int]
    center: np.ndarray
    shift: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    shares: np.ndarray
    error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """(x - S / n) on the components, over the root of their eigenvalues."""
        return ((x.astype(float) - self.center) - self.shift) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Exact sums of (n x - S)^2; plain integers where these could pass 64 bits."""
        # Of n x - S both parts are taken from the center first, so that they stay small.
        center = [int(c) for c in self.center]
        rest = np.array([s - self.n * c for s, c in zip(self.sums, center)], dtype=object)
        far = max(abs(int(c)) + abs(c0) for c, c0 in zip(np.abs(x.astype(float)).max(axis=0), center))
        if self.n * far + self.n < 2**62:
            t = self.n * (x - np.array(center)) - rest.astype(np.int64)
            if int(np.abs(t).max()) ** 2 * x.shape[1] < 2**63:
                return (t * t).sum(axis=1)
        y = x.astype(object) - np.array(center, dtype=object)
        return [int(row @ row) for row in (self.n * y - rest)]


def _spread(rows: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Per vector length: the largest entry of the covariance of the whitened vectors minus the identity, measured."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _levels(batch, 0) if batch.num_rows else ():
                size = x.shape[1]
                w = sent.value[size].project(x)
                totals[size] = totals.get(size, 0) + np.vstack([w.T @ w, w.sum(axis=0)[None, :]])
        for size, total in totals.items():
            i, j = np.indices(total.shape).reshape(2, -1)
            columns = [np.full(len(i), size), i, j, total.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "i", "j", "s"])

    parts = rows.mapInArrow(run, "size bigint, i bigint, j bigint, s double")
    errors = dict.fromkeys(models, 0.0)
    tables = {size: np.zeros((len(m.values) + 1, len(m.values))) for size, m in models.items()}
    for r in parts.groupBy("size", "i", "j").agg(F.sum("s").alias("s")).collect():
        tables[r["size"]][r["i"], r["j"]] = r["s"] / models[r["size"]].n
    for size, table in tables.items():
        if table.size:
            errors[size] = float(np.abs(table[:-1] - np.outer(table[-1], table[-1]) - np.eye(table.shape[1])).max())
    return errors


def fit_whitening(table: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> dict[int, Whitening]:
    """A whitening per vector length, from all usable vectors; what the driver holds is a square matrix of that length.

    x is floor(1024 c) + 100000. Sums are exact, products are taken of x minus the whole number next to its mean, and
    what that leaves of the mean is taken off at the end.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(x.alias("c")).where(_usable(F.col("c")))
    sums = _sums(rows)
    centers = {size: [round(Fraction(s, n)) for s in total] for size, (n, total) in sums.items()}
    products = _products(rows, centers) if centers else {}
    models = {}
    for size, (n, total) in sums.items():
        shift = np.array([float(Fraction(s, n) - c) for s, c in zip(total, centers[size])])
        v = products[size] / n - np.outer(shift, shift)
        values, vectors = top_pairs(v, components)
        # The same components whatever the sign a run finds.
        sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
        trace = float(np.trace(v))
        shares = values / trace if len(values) else values
        models[size] = Whitening(n, total, np.array(centers[size], dtype=float), shift, vectors * sign, values, shares)
    for size, error in (_spread(rows, models) if models else {}).items():
        models[size].error = error
    return models


def whiten(table: DataFrame, models: dict[int, Whitening], key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, deviation_wide, whitened, explained, identity_error) of every usable row and component.

    Vectors that are null, empty or hold null or non-finite entries have no rows; vectors of another length are
    fitted by themselves. Repeated rows and null ids stay as they are, other columns are passed over. Components
    without variance do not exist, so that equal vectors, or a single one, have no rows; of equal eigenvalues any basis is
    taken. A deviation beyond 64 bits is null, and whole in deviation_wide (null beyond 38 digits); an entry whose x
    passes 64 bits takes the nearest that does not.
    """
    sent = table.sparkSession.sparkContext.broadcast(models)
    fields = [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
    fields += [("deviation_wide", pa.decimal128(38, 0)), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            for at, x in _levels(batch, 1) if batch.num_rows else ():
                model = sent.value.get(x.shape[1])
                if model is None or not len(model.values):
                    continue
                k, rows = len(model.values), len(at)
                each = pa.array(np.repeat(np.arange(rows), k))
                deviation = model.deviations(x)
                if isinstance(deviation, list):
                    wide = pa.array([Decimal(d) if d < 10**38 else None for d in deviation], pa.decimal128(38, 0))
                    deviation = pa.array([d if d <= _LONG else None for d in deviation], pa.int64())
                else:
                    deviation = pa.array(deviation)
                    wide = deviation.cast(pa.decimal128(38, 0))
                tiled = lambda values: pa.array(np.tile(values, rows))
                columns = [
                    batch.column(0).take(pa.array(at)).take(each),
                    tiled(np.arange(1, k + 1, dtype=np.int32)),
                    pa.array(np.full(rows * k, model.n)),
                    deviation.take(each),
                    wide.take(each),
                    pa.array(model.project(x).ravel()),
                    tiled(model.shares),
                    pa.array(np.full(rows * k, model.error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    x = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), x.alias("c")).where(_usable(F.col("c")))
    kinds = "vec_id bigint, component int, n bigint, deviation bigint, deviation_wide decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, kinds)


def query(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings, fit_whitening(embeddings))
