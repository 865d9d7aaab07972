"""Splits, folds, bootstrap weights, batches, row picking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import digest, hash_bucket, hash_unit, poisson_one, word_of
from millrace.operators.ordering import with_rank


def parse_size(size) -> int | float:
    """All digits: a row count; anything else: a fraction."""
    if isinstance(size, str):
        return int(size) if size.isdigit() else float(size)
    return size


def _radix_threshold(df: DataFrame, code: Column, n: int) -> str | None:
    """The n-th smallest hex code, found by two histograms of at most 65,536 cells."""
    coded = df.select(code.alias("code"))
    prefix, left = "", n
    for width in (4, 8):
        cells = (
            coded.where(F.col("code").startswith(prefix))
            .groupBy(F.substring("code", 1, width).alias("cell"))
            .count()
            .collect()
        )
        found = False
        for cell in sorted(cells, key=lambda r: r["cell"]):
            if left <= cell["count"]:
                prefix, found = cell["cell"], True
                break
            left -= cell["count"]
        if not found:
            return None
    rest = coded.where(F.col("code").startswith(prefix)).orderBy("code").limit(left).agg(F.max("code").alias("m"))
    return rest.first()["m"]


def with_split(df: DataFrame, keys: list[Column], test_size, seed=42, name: str = "is_test") -> DataFrame:
    """Mark test rows. A count is met exactly without any global sort; a fraction by hash bucket."""
    size = parse_size(test_size)
    if isinstance(size, float):
        return df.withColumn(name, hash_unit(seed, *keys) < F.lit(size))
    if size <= 0:
        return df.withColumn(name, F.lit(False))
    code = digest(seed, *keys)
    threshold = _radix_threshold(df, code, size)
    if threshold is None:
        return df.withColumn(name, F.lit(True))
    return df.withColumn(name, code <= F.lit(threshold))


def train_test(df: DataFrame, keys: list[Column], test_size, seed=42) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, keys, test_size, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def with_stratified_fold(df: DataFrame, label: str, order: list[str], folds: int = 5, name: str = "fold") -> DataFrame:
    """Contiguous folds per class in row order; the first classes' folds take the remainder."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    ranked = with_rank(df, [label], order, "_rank").join(sizes, label)
    short = F.floor(F.col("_size") / folds)
    extra = F.col("_size") % folds
    head = extra * (short + 1)
    fold = F.when(F.col("_rank") < head, F.floor(F.col("_rank") / (short + 1))).otherwise(
        extra + F.floor((F.col("_rank") - head) / F.greatest(short, F.lit(1)))
    )
    return ranked.withColumn(name, fold.cast("int")).drop("_rank", "_size")


def bootstrap_rows(df: DataFrame, keys: list[str], replicates: int, seed=42) -> DataFrame:
    """One row per (row, replicate) with a Poisson(1) weight; rows of weight 0 are left out.

    One digest serves four replicates. Aggregates over ``weight`` combine map-side, so the expanded
    rows are never shuffled.
    """
    groups = (replicates + 3) // 4
    grouped = df.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    coded = grouped.withColumn("_code", digest(seed, *[F.col(k) for k in keys], F.col("_group")))
    words = F.array(*[F.struct((F.col("_group") * 4 + i).alias("replicate"), word_of(F.col("_code"), i).alias("word")) for i in range(4)])
    rows = coded.withColumn("_w", F.explode(words)).select(
        *df.columns,
        F.col("_w.replicate").alias("replicate"),
        poisson_one(F.col("_w.word") / F.lit(4294967296.0)).alias("weight"),
    )
    return rows.where((F.col("weight") > 0) & (F.col("replicate") < replicates))


def batch_number(seed, epoch: int, batches: int, *keys: Column) -> Column:
    """Batch of a row in one epoch."""
    return hash_bucket(f"{seed}-{epoch}", batches, *keys)


def pick_rows(df: DataFrame, ids: DataFrame | list, key: str) -> DataFrame:
    """Rows whose key is listed."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key).distinct(), key, "left_semi")
    return df.where(F.col(key).isin(list(ids)))


def two_classes(df: DataFrame, label: str, first: int, second: int) -> DataFrame:
    return df.where(F.col(label).isin(first, second))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by key; row order is always a column."""
    return df.orderBy(*order).limit(n)
