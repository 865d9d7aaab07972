"""Exact k nearest neighbours under L1, L2 or L3 without comparing every pair of rows.

Train rows are put into cells around pivots, as many as the rows ask for, in a tree of two levels. A query first searches
its own cell, which bounds its k-th distance, and then only the cells that the triangle inequality (or, under L2, the plane
between two pivots) does not rule out. Equal vectors are folded before: of a group of equal train rows only the k lowest ids
can ever be chosen, and equal queries share one search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import digest
from millrace.operators.blocks import block_join
from millrace.operators.linalg import matrix
from millrace.operators.metrics import weighted_vote
from millrace.session import cut_lineage

#: Train rows per cell, and bytes of all pivots at most: they travel with the tasks.
CELL_ROWS, PIVOT_BYTES = 1024, 32 << 20
#: Values of a difference block that stay in a core's cache, and pairs whose sums a task holds at once.
CACHE_CELLS, PAIR_CELLS = 1 << 15, 1 << 21
#: Rows of a block that meets the cells of a top: blocks are copied once per partner block, so they are large.
VISIT_ROWS = 16_384
#: Pairs are measured one by one if a bound leaves at most one of so many; not under L2, where sums of all pairs cost little.
FEW, FEW_SUMS = 16, 4
SLACK = 1e-9  # relative; keeps rounding of computed distances from pruning a true neighbour


def significant(d: np.ndarray, digits: int = 12) -> np.ndarray:
    """Values at so many significant digits, so that equal distances tie whatever the summation order, at any scale."""
    size = np.floor(np.log10(np.where(d > 0, d, 1.0)))
    unit = 10.0 ** np.clip(digits - 1 - size, -300, 300)
    return np.round(d * unit) / unit


def lengths(gap: np.ndarray, p: int) -> np.ndarray:
    """L_p lengths along the last axis of what is no lower than 0. Powers are products: a power function costs 20 times as much."""
    if p == 1:
        return gap.sum(axis=-1)
    power = gap * gap
    for _ in range(p - 2):
        power *= gap
    return np.sqrt(power.sum(axis=-1)) if p == 2 else power.sum(axis=-1) ** (1.0 / p)


def distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """L_p distances between the rows of a and b, as many at a time as stay in a core's cache."""
    out = np.empty((len(a), len(b)))
    step = max(1, CACHE_CELLS * 4 // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = lengths(np.abs(a[i : i + step, None, :] - b[None, :, :]), p)
    return out


def power_sums(a: np.ndarray, b: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """L_p distances to the p between the rows of a and b, about, and per row of a how far off they are at most.

    Under L2 one matrix product; else differences of as many rows as stay in a core's cache.
    """
    width = max(1, a.shape[1])
    if p == 2:
        na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
        out = a @ b.T
        out *= -2.0
        out += na[:, None]
        out += nb[None, :]
        return out, (na + nb.max(initial=0.0)) * (1e-15 * (width + 8))
    out = np.empty((len(a), len(b)))
    cols = max(1, min(len(b), CACHE_CELLS // width))
    gap, cube = np.empty((cols, width)), np.empty((cols, width))
    for j in range(0, len(b), cols):
        part = b[j : j + cols]
        g, c = gap[: len(part)], cube[: len(part)]
        for i in range(len(a)):
            np.subtract(part, a[i], out=g)
            np.abs(g, out=g)
            if p > 1:
                np.multiply(g, g, out=c)
                for _ in range(p - 2):
                    np.multiply(c, g, out=c)
            (c if p > 1 else g).sum(axis=1, out=out[i, j : j + cols])
    return out, 1e-15 * (width + 8) * out.max(axis=1, initial=0.0)


def pairs_within(a: np.ndarray, b: np.ndarray, bound: np.ndarray, p: int = 2) -> tuple[np.ndarray, np.ndarray] | None:
    """Row of a and row of b of all pairs that may lie within the bound, or nothing if that rules out too few.

    One product of single precision, from which each row's limit and the most it can be off are taken inside the product, so
    that pairs are read by their sign.
    """
    if p not in WITHIN or not len(a) or not len(b) or not a.shape[1]:
        return None
    centre, free = b.mean(axis=0), np.isinf(bound)
    if free.all():
        return None
    sides = WITHIN[p](a - centre, b - centre, np.where(free, bound[~free].max(), bound))
    if sides is None:
        return None
    inside = sides[0] @ sides[1].T >= 0
    inside[free] = True
    at = np.flatnonzero(inside)
    return None if len(at) * (FEW if p == 2 else FEW_SUMS) > len(a) * len(b) else np.divmod(at, len(b))


def _square_sides(x: np.ndarray, y: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows whose products are half of bound squared less the sum of squares, and no less than 0 within the bound."""
    width = x.shape[1]
    nx, ny = (x * x).sum(axis=1), (y * y).sum(axis=1)
    far = (bound * (1 + 8 * SLACK)) ** 2
    size = nx + ny.max() + far
    if not size.max() < 1e30:
        return None
    left, right = np.empty((len(x), width + 2), np.float32), np.empty((len(y), width + 2), np.float32)
    left[:, :-2], left[:, -2], left[:, -1] = x, 1.0, (far - nx) / 2 + size * (2e-7 * (width + 8)) + 1e-30
    right[:, :-2], right[:, -2], right[:, -1] = y, -ny / 2, 1.0
    return left, right


def _cube_sides(x: np.ndarray, y: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """As _square_sides for L3: rows whose products are bound cubed less a sum that the sum of cubes is no lower than.

    With u the square of a difference over the bound, its cube u ** 1.5 is at least q(u) = A u + B u u - C for all u up to 1: q touches
    it at u0 and meets it at 1, and the third derivative of the cube is negative. A pair within the bound has no u above 1.
    Sums of q are products of powers of the coordinates. Any u0 is right; this one is close for differences of normal spread.
    """
    width = x.shape[1]
    norm = lambda v: np.sqrt((v * v).sum(axis=1))
    unit = max(norm(x).mean(), norm(y).mean())  # a bound may be raised: more pairs are measured then
    far = np.maximum(bound * (1 + 8 * SLACK), 0.1 * unit)
    if not 0 < unit < 1e30 or not far.max() < 1e30:
        return None
    x, y, far = x / unit, y / unit, (far / unit)[:, None]
    u0 = min(0.5, 1.1 / (1.6 * width) ** (2 / 3))
    B = (1 - u0**1.5 - 1.5 * u0**0.5 * (1 - u0)) / (1 - u0) ** 2
    A, C = 1.5 * u0**0.5 - 2 * B * u0, 0.5 * u0**1.5 - B * u0 * u0
    x2, y2 = x * x, y * y
    u, uu, c = A * far, B / far, (1 + width * C) * far**3
    rest = c - u * x2.sum(axis=1, keepdims=True) - uu * (x2 * x2).sum(axis=1, keepdims=True)
    left = np.concatenate([2 * u * x + 4 * uu * x2 * x, -6 * uu * x2, 4 * uu * x, u, uu, rest], axis=1)
    right = np.concatenate([y, y2, y2 * y, -y2.sum(axis=1, keepdims=True), -(y2 * y2).sum(axis=1, keepdims=True), np.ones((len(y), 1))], axis=1)
    size = norm(left) * norm(right).max()
    if not size.max() < 1e30:
        return None
    left[:, -1] += size * (2e-7 * (left.shape[1] + 8)) + 1e-30
    return left.astype(np.float32), right.astype(np.float32)


def _gap_sides(x: np.ndarray, y: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """As _square_sides for L1: rows whose products are the bound less a sum that the sum of gaps is no lower than.

    Each axis is cut into three parts, of which two coordinates cover the shares a and b. The gap is no lower than the sum over
    parts of width times |a - b|, and |a - b| no lower than a + b - 2 a b - 2 sqrt(a (1 - a) b (1 - b)): for a <= b that root is at least
    a (1 - b). It is equal where a or b is 0 or 1. Any cuts are right; these are close for coordinates of normal spread.
    """
    norm = lambda v: np.sqrt((v * v).sum(axis=1))
    spread = y.std(axis=0)
    unit = spread.max()
    if not 0 < unit < 1e30 or not bound.max() < 1e30 * unit:
        return None
    x, y, far = x / unit, y / unit, bound / unit * (1 + 8 * SLACK)
    cuts = spread / unit * np.array([[-2.0], [-0.5], [0.5], [2.0]])
    wide = np.diff(cuts, axis=0)

    def shares(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = np.clip((v[:, None, :] - cuts[:-1]) / np.where(wide > 0, wide, 1.0), 0.0, 1.0)
        return part.reshape(len(v), -1), np.sqrt(part * (1 - part)).reshape(len(v), -1), (part * wide).sum(axis=(1, 2))[:, None]

    (a, both, sa), (b, both_there, sb), twice = shares(x), shares(y), 2 * wide.ravel()
    left = np.concatenate([a * twice, both * twice, far[:, None] - sa, np.ones((len(x), 1))], axis=1)
    right = np.concatenate([b, both_there, np.ones((len(y), 1)), -sb], axis=1)
    left[:, -2] += norm(left) * norm(right).max() * (2e-7 * (left.shape[1] + 8)) + 1e-30
    return left.astype(np.float32), right.astype(np.float32)


#: What rules pairs out by a product.
WITHIN = {1: _gap_sides, 2: _square_sides, 3: _cube_sides}


def closest(a: np.ndarray, b: np.ndarray, p: int, k: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k closest rows of b, with all that tie, and none that is surely beyond the bound.

    Sums that are quick and a little off leave few pairs; those are measured as distances() does.
    """
    rows, cols, found = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
    step = max(1, PAIR_CELLS // max(1, len(b)))
    for i in range(0, len(a), step):
        part = a[i : i + step]
        with np.errstate(over="ignore", invalid="ignore"):
            within = None if bound is None else pairs_within(part, b, bound[i : i + step], p)
            s, off = power_sums(part, b, p) if within is None else (np.zeros((0, len(b))), np.zeros(0))
        kk = min(k, s.shape[1])
        if within is not None:
            row, col = within
        elif np.isfinite(s).all():
            border = np.partition(s, kk - 1, axis=1)[:, kk - 1] if kk > 1 else s.min(axis=1)
            limit = border + 2 * off
            if bound is not None:
                limit = np.minimum(limit, bound[i : i + step] ** p + off)
            row, col = np.nonzero(s <= (limit + off + np.abs(limit) * 4 * SLACK)[:, None])
        else:  # beyond what sums of powers can hold
            row, col = np.repeat(np.arange(len(part)), len(b)), np.tile(np.arange(len(b)), len(part))
        exact = np.empty(len(row))
        few = max(1, CACHE_CELLS * 4 // max(1, b.shape[1]))
        for j in range(0, len(row), few):
            r, c = row[j : j + few], col[j : j + few]
            exact[j : j + few] = lengths(np.abs(part[r] - b[c]), p)
        if within is not None:
            inside = exact <= bound[i : i + step][row] * (1 + 4 * SLACK)
            row, col, exact = row[inside], col[inside], exact[inside]
        row, col, exact = k_best(row, col, exact, k)
        rows.append(row + i)
        cols.append(col)
        found.append(exact)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(found)


def k_best(row: np.ndarray, col: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (row, col) the k with the lowest d per row and all that tie with the last of them; NaN never counts."""
    real = ~np.isnan(d)
    row, col, d = row[real], col[real], d[real]
    order = np.lexsort((d, row))
    row, col, d = row[order], col[order], d[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    size = np.diff(np.append(first, len(row)))
    border = np.repeat(d[first + np.minimum(size, k) - 1], size) if len(row) else d
    keep = d <= border * (1 + SLACK)
    return row[keep], col[keep], d[keep]


def keep_lowest(lowest: np.ndarray, row: np.ndarray, d: np.ndarray) -> None:
    """Put distances, which lie in order of row and distance, among the lowest known ones of their rows, which stay in order."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    if len(first):
        here = row[first]
        nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        made = np.full((len(here), lowest.shape[1]), np.inf)
        some = nth < lowest.shape[1]
        made[np.repeat(np.arange(len(here)), np.diff(np.append(first, len(row))))[some], nth[some]] = d[some]
        lowest[here] = np.sort(np.concatenate([lowest[here], made], axis=1), axis=1)[:, : lowest.shape[1]]


def distinct_vectors(rows: DataFrame, key: str, features: str, k: int, tag: Column | None = None) -> DataFrame:
    """One row per distinct vector: its lowest key, and its k lowest keys with what they carry.

    The window limit keeps k rows per vector in every task before the shuffle.
    """
    code = F.xxhash64(F.col(features))
    order = Window.partitionBy("_code", features).orderBy(key)
    kept = rows.withColumn("_code", code).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    member = F.struct(F.col(key).alias("neighbor"), (F.lit(None).cast("int") if tag is None else tag).alias("tag"))
    return kept.groupBy("_code", features).agg(F.min(key).alias("rep"), F.sort_array(F.collect_list(member)).alias("members")).drop("_code")


def choose_pivots(train: DataFrame, features: str, count: int) -> np.ndarray:
    """Seeded choice of vectors as cell centres; any choice gives exact results."""
    rows = train.select(features).orderBy(digest("pivot", F.col(features))).limit(count).collect()
    return np.array([r[0] for r in rows], dtype=float)


class MetricIndex:
    """Pivots in two levels: the first ones are tops, every pivot is a cell below its nearest top.

    A row belongs to its nearest top and there to the nearest cell, so that placing it costs about twice the root of the
    number of cells. Per top and cell the index keeps how many rows it holds, and how near and far they lie.
    """

    def __init__(self, pivots: np.ndarray, p: int):
        self.pivots, self.p = pivots, p
        tops = int(np.ceil(np.sqrt(len(pivots))))
        self.tops = pivots[:tops]
        top = distances(pivots, self.tops, p).argmin(axis=1)
        top[:tops] = np.arange(tops)  # a top is a cell of its own, also next to an equal one
        self.top_of = top.astype(np.int32)
        self.cells = [np.flatnonzero(top == t) for t in range(tops)]
        self.inner, self.radius = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
        self.top_reach, self.top_count = np.full(tops, -np.inf), np.zeros(tops)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, distance to its pivot, top, distance to the top."""
        far = distances(x, self.tops, self.p)
        top = far.argmin(axis=1)
        cell, near = np.zeros(len(x), int), np.zeros(len(x))
        for t in np.unique(top):
            rows = np.flatnonzero(top == t)
            d = distances(x[rows], self.pivots[self.cells[t]], self.p)
            best = d.argmin(axis=1)
            cell[rows], near[rows] = self.cells[t][best], d[np.arange(len(rows)), best]
        return cell, near, top, far[np.arange(len(x)), top]

    def learn(self, rows: DataFrame) -> "MetricIndex":
        """Counts and reaches from placed rows (cell, near, top, far, m): a few numbers per cell reach the driver."""
        stats = rows.groupBy("top", "cell").agg(F.min("near").alias("inner"), F.max("near").alias("radius"), F.max("far").alias("far"), F.sum("m").alias("m"))
        for r in stats.collect():
            self.inner[r["cell"]], self.radius[r["cell"]] = r["inner"], r["radius"]
            self.top_reach[r["top"]] = max(self.top_reach[r["top"]], r["far"])
            self.top_count[r["top"]] += r["m"]
        return self

    def _plane(self, d: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        """Under L2: how far a row in each pivot's part lies at least, from the plane between that pivot and the query's nearest."""
        own = d.argmin(axis=1)
        gap = distances(pivots, pivots, 2)[own]
        return np.where(gap > 0, (d * d - d.min(axis=1)[:, None] ** 2) / (2 * np.where(gap > 0, gap, 1.0)), 0.0)

    def reached(self, x: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells that may hold something within the bound; without a bound one from the tops alone."""
        far = distances(x, self.tops, self.p)
        # The k-th row lies at most as far as the far side of the tops that hold k rows together.
        side = np.where(self.top_count > 0, far + self.top_reach, np.inf)
        order = np.argsort(side, axis=1)
        enough = np.cumsum(self.top_count[order], axis=1) >= k
        sides = np.take_along_axis(side, order, axis=1)
        limit = np.where(enough.any(axis=1), sides[np.arange(len(x)), enough.argmax(axis=1)], np.inf)
        bound = np.minimum(bound, limit)
        allowed = lambda low, d, b: low <= b + SLACK * (d + np.where(np.isfinite(b), b, 0.0))
        low = far - self.top_reach
        if self.p == 2:
            low = np.maximum(low, self._plane(far, self.tops))
        open_top = allowed(low, far, bound[:, None]) & (self.top_count > 0)
        rows, cells = [], []
        for t in np.flatnonzero(open_top.any(axis=0)):
            at, own = np.flatnonzero(open_top[:, t]), self.cells[t]
            d = distances(x[at], self.pivots[own], self.p)
            low = np.maximum(d - self.radius[own], self.inner[own] - d)
            if self.p == 2:
                low = np.maximum(low, self._plane(d, self.pivots[own]))
            row, cell = np.nonzero(allowed(low, d, bound[at][:, None]) & (self.radius[own] >= 0))
            rows.append(at[row])
            cells.append(own[cell])
        empty = np.zeros(0, int)
        return np.concatenate([empty, *rows]), np.concatenate([empty, *cells])


def _placed(rows: DataFrame, index, fields: str) -> DataFrame:
    """rows, which begin with x, and cell, near, top, far of each."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell, near, top, far = index.value.place(matrix(batch.column(0)))
                made = [pa.array(cell, pa.int32()), pa.array(near), pa.array(top, pa.int32()), pa.array(far)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "cell", "near", "top", "far"])

    return rows.mapInArrow(run, f"{fields}, cell int, near double, top int, far double")


def _best_of_cells(asked: DataFrame, held: DataFrame, k: int, p: int, members: str) -> DataFrame:
    """(asker, distance, neighbor, tag, rank): the k best of asked (asker, x, cell) among the held rows of the same cells."""

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        row, col, d = closest(matrix(a.column("x")), matrix(b.column("x")), p, k)
        return _found(a, b, row, col, d)

    found = block_join(asked, held.select("x", "rep", "members", "cell"), "cell", "asker", "rep", best, f"asker bigint, distance double, members {members}")
    return ranked(found.select("asker", "distance", F.inline("members")), k)


def _found(a: pa.Table, b: pa.Table, row: np.ndarray, col: np.ndarray, d: np.ndarray) -> pa.Table:
    """Equal distances at the border are all kept here; the final rank picks the lowest keys."""
    asker = a.column("asker").to_numpy()
    columns = [pa.array(asker[row], pa.int64()), pa.array(significant(d), pa.float64()), b.column("members").combine_chunks().take(pa.array(col, pa.int64()))]
    return pa.Table.from_arrays(columns, names=["asker", "distance", "members"])


def _best_of_visits(visiting: DataFrame, held: DataFrame, k: int, p: int, members: str) -> DataFrame:
    """As _best_of_cells, for askers (x, asker, bound, top, cells) that visit several cells of a top: only those are searched."""

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        x, y, bound = matrix(a.column("x")), matrix(b.column("x")), a.column("bound").to_numpy()
        lists = a.column("cells").combine_chunks()
        goal = lists.flatten().to_numpy()
        who = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(goal, kind="stable")
        goal, who = goal[order], who[order]
        cell = b.column("cell").to_numpy()
        place = np.argsort(cell, kind="stable")
        cells, first = np.unique(cell[place], return_index=True)
        rows, cols, found = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
        lowest = np.full((len(x), k), np.inf)
        for c, here in zip(cells, np.split(place, first[1:])):
            asks = who[np.searchsorted(goal, c, "left") : np.searchsorted(goal, c, "right")]
            if len(asks):
                row, col, d = closest(x[asks], y[here], p, k, np.minimum(bound[asks], lowest[asks, -1]))
                rows.append(asks[row])
                cols.append(here[col])
                found.append(d)
                keep_lowest(lowest, asks[row], d)
        return _found(a, b, *k_best(np.concatenate(rows), np.concatenate(cols), np.concatenate(found), k))

    found = block_join(visiting, held.select("x", "rep", "members", "cell", "top"), "top", "asker", "rep", best, f"asker bigint, distance double, members {members}", rows=VISIT_ROWS)
    return ranked(found.select("asker", "distance", F.inline("members")), k)


def ranked(rows: DataFrame, k: int) -> DataFrame:
    rank = Window.partitionBy("asker").orderBy("distance", "neighbor")
    return rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)


def search(
    train: DataFrame, queries: DataFrame, key: str, features: str, k: int, p: int = 2, tag: Column | None = None, pivots: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """((query, neighbor, tag, distance, rank), (asker, cell) visited beyond the own cell).

    ``tag`` is what a train row brings along, its label for example. Without ``pivots`` there is one per CELL_ROWS rows,
    PIVOT_BYTES of them at most; a crowded cell is compared in blocks.
    """
    carried = F.lit(None).cast("int") if tag is None else tag
    base = train.select(F.col(key).alias("key"), F.col(features).alias("x"), carried.alias("tag"))
    base = cut_lineage(distinct_vectors(base, "key", "x", k, F.col("tag")).select("x", "rep", "members"))
    shape = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    if not shape["n"]:
        raise ValueError("no train rows")
    most = max(1, PIVOT_BYTES // (8 * max(1, shape["d"])))
    index = MetricIndex(choose_pivots(base, "x", pivots or min(most, -(-shape["n"] // CELL_ROWS))), p)
    context = train.sparkSession.sparkContext
    members = base.schema["members"].dataType.simpleString()
    held = cut_lineage(_placed(base, context.broadcast(index), f"x array<double>, rep bigint, members {members}"))
    index.learn(held.withColumn("m", F.size("members")))
    sent = context.broadcast(index)
    asked = queries.select(F.col(key).alias("query"), F.col(features).alias("x"))
    unique = cut_lineage(_placed(asked.groupBy("x").agg(F.min("query").alias("asker")), sent, "x array<double>, asker bigint").select("x", "asker", "cell"))
    own = cut_lineage(_best_of_cells(unique, held, k, p, members))
    bound = own.where(F.col("rank") == k).select("asker", F.col("distance").alias("bound"))
    bounded = unique.join(bound, "asker", "left").select("x", "asker", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            home, within = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            row, cell = sent.value.reached(matrix(batch.column(0)), within, k)
            other = cell != home[row]
            row, cell = row[other], cell[other]
            top = sent.value.top_of[cell]
            order = np.lexsort((cell, top, row))
            row, cell, top = row[order], cell[order], top[order]
            first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(top, prepend=-1) != 0))
            take = pa.array(row[first], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(cell, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in (0, 1, 3)), pa.array(top[first], pa.int32()), lists], names=["x", "asker", "bound", "top", "cells"]
            )

    visiting = cut_lineage(bounded.mapInArrow(run, "x array<double>, asker bigint, bound double, top int, cells array<int>"))
    top = own.drop("rank").unionByName(_best_of_visits(visiting, held, k, p, members).drop("rank"))
    # Give each query of a group of equal vectors the result of its asker.
    owners = asked.join(unique.select("x", "asker"), "x").select("query", "asker")
    found = owners.join(ranked(top, k), "asker").select("query", "neighbor", "tag", "distance", "rank")
    return found, visiting.select("asker", F.explode("cells").alias("cell"))


def nearest(train: DataFrame, queries: DataFrame, key: str, features: str, k: int, p: int = 2, pivots: int | None = None) -> DataFrame:
    """The k nearest train rows of every query: (query, neighbor, distance, rank); ties by lowest key."""
    return search(train, queries, key, features, k, p, None, pivots)[0].drop("tag")


def vote_weight(neighbors: DataFrame, weights: str) -> DataFrame:
    """Add ``weight``: uniform, inverse distance, or softmax of the negative distance.

    With inverse weights a query that has neighbours at distance 0 is decided by those alone.
    """
    if weights == "uniform":
        return neighbors.withColumn("weight", F.lit(1.0))
    per_query = Window.partitionBy("query")  # k rows per query
    if weights == "inverse":
        closest = F.min("distance").over(per_query)
        at_zero = (F.col("distance") == 0).cast("double")
        return neighbors.withColumn("_c", closest).withColumn(
            "weight", F.when(F.col("_c") == 0, at_zero).otherwise(F.lit(1.0) / F.when(F.col("distance") != 0, F.col("distance")))
        ).drop("_c")
    shifted = neighbors.withColumn("_e", F.exp(F.min("distance").over(per_query) - F.col("distance")))
    return shifted.withColumn("weight", F.col("_e") / F.sum("_e").over(per_query)).drop("_e")


def classify(
    train: DataFrame, queries: DataFrame, key: str, features: str, label: str, k: int = 3, p: int = 2, weights: str = "uniform"
) -> DataFrame:
    """Weighted vote of the k nearest; lowest class on ties. Columns: query, prediction."""
    found = search(train, queries, key, features, k, p, F.col(label))[0].withColumnRenamed("tag", "class")
    return weighted_vote(vote_weight(found, weights), "query", "class", F.col("weight"))


def first_mistakes(predictions: DataFrame, label: str, order: Column) -> DataFrame:
    """First misclassified row of each class."""
    wrong = predictions.where(F.col("prediction") != F.col(label))
    columns = [c for c in predictions.columns if c != label]
    return wrong.groupBy(label).agg(F.min_by(F.struct(*columns), order).alias("s")).select(label, "s.*")
