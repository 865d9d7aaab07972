"""Embedding near-dedup: exact metric range join over pivot cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import LOWEST, components, id_of, map_batches, stored
from millrace.operators.blocks import block_join
from millrace.operators.linalg import matrix

COSINE = 0.93
#: Vectors aimed at per cell, the most pivots over all labels, and the vectors of a block.
CELL_ROWS, MOST_PIVOTS, BLOCK = 1024, 1 << 17, 1024


def choose_pivots(classes: DataFrame) -> DataFrame:
    """(space, u) pivots of each space: one per CELL_ROWS vectors, fewer if all spaces together would exceed MOST_PIVOTS.

    A space of one cell needs none. Pivots are the rows with the lowest hash; only a hash share of the rows,
    some times the pivots wanted, is numbered per space.
    """
    total = max(1, classes.count())
    share = min(1.0 / CELL_ROWS, MOST_PIVOTS / total / 2)
    wanted = stored(classes.groupBy("space").agg(F.floor(F.count(F.lit(1)) * share).alias("pivots")).where("pivots > 1"))
    unit = F.pmod(F.xxhash64(F.lit(5), "h", "g"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = classes.where(unit < F.lit(min(1.0, share * 8 + 1e-9))).join(wanted, "space")
    order = Window.partitionBy("space").orderBy(F.xxhash64(F.lit(5), "h", "g"), "h")
    return some.withColumn("k", F.row_number().over(order)).where("k <= pivots").select("space", "u")


def place(classes: DataFrame, pivots: dict, radius: float) -> DataFrame:
    """(rep, n, u, cell, native): each vector in the cell of its nearest pivot and in the later cells its range reaches.

    By the triangle inequality a partner y of x whose nearest pivot is q has |x - q| <= |x - p| + 2 radius.
    """
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spaces = np.array(batch.column(0).to_pylist(), dtype=object)
        out = []
        for space in set(spaces.tolist()):
            at = np.flatnonzero(spaces == space)
            here = sent.value.get(space)
            if here is None:
                out.append((at, np.zeros(len(at), np.int64), np.ones(len(at), bool), space))
                continue
            x = matrix(batch.column(3).take(pa.array(at)))
            for i in range(0, len(at), 4096):
                # Distances are compared with a margin far above their rounding errors.
                d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x[i : i + 4096] @ here.T)))
                home = d.argmin(axis=1)
                reach = d <= d.min(axis=1)[:, None] + 2 * radius + 1e-6
                reach &= np.arange(len(here))[None, :] > home[:, None]
                row, cell = np.nonzero(reach)
                part = at[i : i + 4096]
                out.append((part, home, np.ones(len(part), bool), space))
                out.append((part[row], cell, np.zeros(len(row), bool), space))
        index = pa.array(np.concatenate([o[0] for o in out]))
        cells = [f"{space}/{c}" for _, cell, _, space in out for c in cell]
        columns = [batch.column(i).take(index) for i in (1, 2, 3)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(cells), pa.array(np.concatenate([o[2] for o in out]))], names=["rep", "n", "u", "cell", "native"]
        )

    return map_batches(classes.select("space", "rep", "n", "u"), run, "rep bigint, n bigint, u array<double>, cell string, native boolean")


def compare_blocks(left: pa.Table, right: pa.Table, cosine: float) -> pa.Table:
    """Links of a block of natives with a block of its cell: rows (a, b, n), b null where n adds to the links of a.

    Of two natives only the one with the smaller id on the left counts. The links themselves leave as a
    forest: every linked vector names one representative of its part.
    """
    if not left.num_rows or not right.num_rows:
        return pa.table({name: pa.array([], pa.int64()) for name in ("a", "b", "n")})
    a, b = left.column("rep").to_numpy(), right.column("rep").to_numpy()
    near = matrix(left.column("u")) @ matrix(right.column("u")).T >= cosine
    native = right.column("native").to_numpy(zero_copy_only=False)
    near &= ~native[None, :] | (a[:, None] < b[None, :])
    rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near, a, b = near[np.ix_(rows, cols)], a[rows], b[cols]
    gain_a, gain_b = near @ right.column("n").to_numpy()[cols], left.column("n").to_numpy()[rows] @ near
    tag_a, tag_b = a.copy(), b.copy()
    while len(a):
        new_b = np.minimum(tag_b, np.where(near, tag_a[:, None], np.iinfo(np.int64).max).min(axis=0))
        new_a = np.minimum(tag_a, np.where(near, new_b[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new_a == tag_a).all() and (new_b == tag_b).all():
            break
        tag_a, tag_b = new_a, new_b
    nodes, tags, gains = np.concatenate([a, b]), np.concatenate([tag_a, tag_b]), np.concatenate([gain_a, gain_b])
    edge = nodes != tags
    return pa.table(
        {
            "a": pa.array(np.concatenate([nodes, nodes[edge]]), pa.int64()),
            "b": pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(tags[edge], pa.int64())]),
            "n": pa.array(np.concatenate([gains, np.zeros(edge.sum(), np.int64)]), pa.int64()),
        }
    )


def near_vectors(table: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id) of every row.

    Two rows are linked if their labels are equal and not null, their vectors have one length, and their
    cosine in double precision is at least `cosine`. Null, empty and zero vectors and those with null or
    non-finite components are linked with nothing. Every row is a vector of its own, also one with a repeated
    id; a null id comes before all others and comes back as null. Other columns are passed over.

    Equal vectors of one label are folded and counted. Cells are compared block by block inside tasks, so a
    crowded cell is many blocks; links leave a task as counts and as a forest, never pair by pair.
    """
    if not -1 < cosine <= 1:
        raise ValueError("cosine must lie in (-1, 1]")
    x = F.col(vector).cast("array<double>")
    fit = F.coalesce(
        (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False)
    )
    rows = table.select(
        id_of(key).alias("id"),
        F.when(fit & F.col(label).isNotNull(), F.transform(x, lambda v: v + F.lit(0.0))).alias("x"),
        F.concat_ws(":", F.size(x).cast("string"), F.col(label).cast("string")).alias("space"),
    )
    rows = rows.withColumn("h", F.when(F.col("x").isNotNull(), F.xxhash64("space", "x"))).withColumn(
        "g", F.when(F.col("x").isNotNull(), F.xxhash64(F.lit(1), "space", "x"))
    )
    folded = rows.where("x is not null").groupBy("h", "g").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("x").alias("x"), F.first("space").alias("space")
    )

    def unit(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for v in batch.column(4).to_pylist():
            v = np.array(v)
            v = v / np.abs(v).max()
            made.append(v / np.sqrt(v @ v))
        u = pa.array([v.tolist() for v in made], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 3, 5)), u], names=["h", "g", "rep", "n", "space", "u"])

    classes = stored(map_batches(folded, unit, "h bigint, g bigint, rep bigint, n bigint, space string, u array<double>"))
    # Ids may repeat, so that links run over the place of a class, not over its id.
    nodes = classes.withColumn("node", F.col("h"))
    chosen: dict = {}
    for row in choose_pivots(classes).collect():
        chosen.setdefault(row["space"], []).append(row["u"])
    pivots = {space: np.array(us) for space, us in chosen.items()}
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    placed = stored(place(nodes.select("space", F.col("node").alias("rep"), "n", "u"), pivots, radius))
    found = stored(
        block_join(
            placed.where("native"), placed.toDF(*placed.columns), "cell", "rep", "rep", lambda a, b: compare_blocks(a, b, cosine), "a bigint, b bigint, n bigint", BLOCK
        )
    )
    links = stored(found.where("b is null").groupBy("a").agg(F.sum("n").alias("more")))
    tree = stored(components(found.where("b is not null").select("a", "b")))
    known = stored(
        nodes.join(links, F.col("node") == F.col("a"), "left")
        .join(tree.withColumnRenamed("node", "t"), F.col("node") == F.col("t"), "left")
        .select("h", "g", "rep", "n", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("component", "node").alias("part"))
    )
    lowest = stored(known.groupBy("part").agg(F.min("rep").alias("low")))
    known = stored(known.join(lowest, "part").select("h", "g", (F.col("n") - 1 + F.col("more")).alias("links"), "low"))
    out = lambda c: F.when(c != LOWEST, c)
    return rows.select("id", "h", "g").join(known, ["h", "g"], "left").select(
        out(F.col("id")).alias("vec_id"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        out(F.coalesce("low", "id")).alias("component_id"),
    )


def query(embeddings: DataFrame) -> DataFrame:
    found = near_vectors(embeddings)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
