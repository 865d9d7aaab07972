"""Ranks and running totals that never put a whole group into one task.

Rows are cut into value ranges by literal edges. Ranges are counted in one small aggregate, and the
window runs inside a range only; the totals of the ranges before it are added afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_unit

SINGLE_RANGE_ROWS = 200_000  # below this a plain window is one cheap task
MAX_RANGES = 4096


def range_edges(df: DataFrame, order: Column, *more: Column, rows_per_range: int = SINGLE_RANGE_ROWS) -> list:
    """Upper edges of value ranges of ``order``, from a seeded sample of the rows; empty for little data.

    ``more`` are the further order columns; together they tell rows apart for the sample. The sample
    only places the edges: every row is ranked whatever they are. Rows with one and the same value
    share a range, so the first order column should be an identifier or already distinct.
    """
    total = df.count()
    if total <= rows_per_range:
        return []
    ranges = min(MAX_RANGES, max(2, total // rows_per_range + 1))
    wanted = 40 * ranges
    code = hash_unit("edges", order, *more)
    sample = (
        df.select(order.alias("v"), code.alias("code"))
        .where(F.col("v").isNotNull() & (F.col("code") < F.lit(min(1.0, wanted / total))))
        .orderBy("code")
        .limit(4 * wanted)
    )
    values = sorted(row.v for row in sample.collect())
    step = max(1, len(values) // ranges)
    return sorted(set(values[step::step]))


def range_number(order: Column, edges: list) -> Column:
    """Number of edges at or below the value, by nested halving."""
    if not edges:
        return F.lit(0)

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(order < F.lit(edges[middle]), halve(low, middle)).otherwise(halve(middle + 1, high))

    return halve(0, len(edges))


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    edges: list,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Inclusive running sums per key in the given order.

    ``edges`` are ranges of the first order column. ``extra`` columns are evaluated as first-value
    look-aheads: the value of the next row, crossing range borders.
    """
    extra = extra or {}
    ranged = df.withColumn("_range", range_number(F.col(order[0]), edges))
    names = list(sums)
    ranged = ranged.select("*", *[sums[n].alias(f"_v_{n}") for n in names])
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*",
        *[F.sum(f"_v_{n}").over(upto).alias(f"_s_{n}") for n in names],
        *[F.lead(c).over(inside).alias(f"_n_{n}") for n, c in extra.items()],
    )
    if not edges:
        done = local
        for n in names:
            done = done.withColumn(n, F.col(f"_s_{n}"))
        for n in extra:
            done = done.withColumn(n, F.col(f"_n_{n}"))
        return done.drop("_range", *[f"_v_{n}" for n in names], *[f"_s_{n}" for n in names], *[f"_n_{n}" for n in extra])

    first = F.struct(*order)
    per_range = ranged.groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names],
        *[F.min_by(c, first).alias(f"_f_{n}") for n, c in extra.items()],
    )
    across = Window.partitionBy(*keys).orderBy("_range")  # at most MAX_RANGES + 1 rows per key
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names],
        *[F.lead(f"_f_{n}").over(across).alias(f"_g_{n}") for n in extra],
    )
    on = [*keys, "_range"]
    done = local.join(offsets, on)
    for n in names:
        done = done.withColumn(n, F.col(f"_s_{n}") + F.col(f"_o_{n}"))
    for n in extra:
        done = done.withColumn(n, F.coalesce(F.col(f"_n_{n}"), F.col(f"_g_{n}")))
    helper = [f"_{k}_{n}" for k in "vso" for n in names] + [f"_{k}_{n}" for k in "ng" for n in extra]
    return done.drop("_range", *helper)


def with_rank(df: DataFrame, keys: list[str], order: list[str], name: str = "rank", rows_per_range: int = SINGLE_RANGE_ROWS) -> DataFrame:
    """Position 0, 1, .. of each row within its key, in the given order."""
    edges = range_edges(df, *[F.col(c) for c in order], rows_per_range=rows_per_range)
    ranked = running_totals(df, keys, order, {name: F.lit(1).cast("bigint")}, edges)
    return ranked.withColumn(name, F.col(name) - 1)
