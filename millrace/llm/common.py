"""Helpers shared by the corpus operators: row keys, stored steps, connected components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

LOWEST = -(2**63)


def id_of(column: str = "doc_id") -> Column:
    """The id as BIGINT; a null id counts as one id below all others."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(LOWEST))


def text_of(column: str = "text") -> Column:
    """The whole text; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder."""
    return cut_lineage(df)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """fn over every Arrow batch; empty batches are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(batch)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def released(df: DataFrame) -> DataFrame:
    """As stored(), and Spark's cleaner is woken, so that shuffle files of steps nothing refers to any more leave the disks."""
    made = cut_lineage(df)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return made


def sent_if_small(df: DataFrame, size: Column, most: int = 32 << 20) -> DataFrame:
    """A stored table marked for broadcast if `size`, summed over its rows, is at most `most` bytes; else left to a shuffle."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (a, b).

    Every node takes the smallest label among its neighbours, then the label of its label, until nothing
    changes. Labels are written to the shared folder, the minimum is a partial aggregate, and the joins have
    plain shuffles on both sides, so that adaptive execution splits a node with very many edges.
    """
    pairs = edges.where("a <> b").select("a", "b")
    both = stored(
        pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        .distinct()
    )
    labels = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("component")))
    last = None
    while True:
        onward = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = labels.join(onward, "component").select("node", F.col("root").alias("component"))
        near = both.join(jumped, F.col("v") == F.col("node")).select(F.col("u").alias("node"), "component")
        labels = stored(jumped.unionByName(near).groupBy("node").agg(F.min("component").alias("component")))
        seen = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if seen == last:
            return labels
        last = seen
