"""Compare two row sets block by block inside matching cells.

Both sides are cut into blocks of bounded size, a block meets each partner block of its cell in one
task, and only reduced rows (the k best, a partial sum) leave the task. No pair of rows is emitted,
and a cell that holds most of the data is simply many blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def block_join(
    left: DataFrame,
    right: DataFrame,
    cell: str,
    left_key: str,
    right_key: str,
    fn: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply fn(left block, right block) to every pair of blocks of the same cell."""
    counts_left = left.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_bl"))
    counts_right = right.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_br"))
    # Sizes are one row per cell; the optimizer broadcasts them when they are small.
    sizes = counts_left.join(counts_right, cell)
    numbered_left = (
        left.join(sizes, cell)
        .withColumn("_l", F.pmod(F.xxhash64(left_key), F.col("_bl")).cast("int"))
        .withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("_br") - 1)))
        .drop("_bl", "_br")
    )
    numbered_right = (
        right.join(sizes, cell)
        .withColumn("_r", F.pmod(F.xxhash64(right_key), F.col("_br")).cast("int"))
        .withColumn("_l", F.explode(F.sequence(F.lit(0), F.col("_bl") - 1)))
        .drop("_bl", "_br")
    )
    grouped = numbered_left.groupBy(cell, "_l", "_r").cogroup(numbered_right.groupBy(cell, "_l", "_r"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return fn(a, b)

    return grouped.applyInArrow(run, schema)
