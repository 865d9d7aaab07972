"""One way for every array model to score rows: Arrow batches in, all columns and a prediction out, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.linalg import matrix

_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}
_SPARK = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def score_rows(df: DataFrame, features: Column, name: str, kind: str, fn: Callable[[np.ndarray], np.ndarray], width: int | None = None) -> DataFrame:
    """All columns of df and ``name`` (int, bigint, double or string): fn of the matrix of their feature arrays.

    Works on batch and streaming frames. Input columns travel inside a struct, so that no name can clash; one called
    ``name`` is replaced. Rows whose array is null, holds nulls, or is not ``width`` long get a null.
    """
    names = [c for c in df.columns if c != name]
    x = features.cast("array<double>")
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull())
    if width is not None:
        whole &= F.size(x) == width
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.when(whole, x).alias("x"))

    def run(batches):
        for batch in batches:
            known = batch.column(1).is_valid()
            at = np.flatnonzero(known.to_numpy(zero_copy_only=False))
            made = fn(matrix(batch.column(1).take(pa.array(at)))) if len(at) else np.zeros(0)
            values = pa.array(made, _ARROW[kind])
            if len(at) < batch.num_rows:
                place = np.full(batch.num_rows, -1)
                place[at] = np.arange(len(at))
                values = values.take(pa.array(place, mask=place < 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["row", name])

    made = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField(name, _SPARK[kind])]))
    return made.select(*[F.col("row")[c].alias(c) for c in names], F.col(f"`{name}`"))
