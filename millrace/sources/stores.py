"""Saved parameters, derived tables, metric reports and prediction output."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_arrays(spark: SparkSession, arrays: dict[str, np.ndarray], path: str) -> None:
    """Named parameter arrays as a Parquet table (name, shape, values)."""
    rows = [(k, [int(s) for s in np.shape(v)], [float(x) for x in np.ravel(v)]) for k, v in arrays.items()]
    save_table(spark.createDataFrame(rows, "name STRING, shape ARRAY<INT>, values ARRAY<DOUBLE>"), path)


def load_arrays(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    return {r["name"]: np.array(r["values"]).reshape(r["shape"]) for r in load_table(spark, path).collect()}


def metric_report(metrics: DataFrame, run: str, order: str) -> DataFrame:
    """Wide metrics to rows (run, epoch, split, metric, value); columns are named split_metric."""
    names = [c for c in metrics.columns if c != order]
    items = F.array(
        *[
            F.struct(F.lit(n.split("_", 1)[0]).alias("split"), F.lit(n.split("_", 1)[1]).alias("metric"), F.col(n).alias("value"))
            for n in names
        ]
    )
    return metrics.select(F.lit(run).alias("run"), F.col(order).alias("epoch"), F.inline(items))
