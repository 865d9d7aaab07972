"""Readers for feature tables and labelled documents."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Input schemas, as Spark DDL.
FEATURES = "id BIGINT, features ARRAY<DOUBLE>, target DOUBLE"
CLASSES = "id BIGINT, features ARRAY<DOUBLE>, target INT"


def table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A Parquet table by name; a given schema saves the footer read and fixes the types."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a plain scan out by key if it has fewer file splits than the session has cores.

    What moves is bounded: fewer splits than cores are at most cores times spark.sql.files.maxPartitionBytes.
    A larger table, in however few files, has more splits and is read as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


def feature_table(spark: SparkSession, path: str, classes: bool = False, labelled: bool = True) -> DataFrame:
    schema = CLASSES if classes else FEATURES
    if not labelled:
        schema = schema.rsplit(",", 1)[0]
    return spark.read.schema(schema).parquet(path)


def lowest_classes(df: DataFrame, label: str, n_class: int) -> DataFrame:
    """Rows of the classes 0 .. n_class - 1."""
    return df.where(F.col(label) < n_class)


def labelled_documents(docs: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    return docs.join(labels, key)


def lineitem_key() -> list[Column]:
    """Columns that identify a lineitem row, as text both engines build alike."""
    return [
        F.col("l_orderkey"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.col("l_linenumber"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        F.date_format("l_shipdate", "yyyyMMdd"),
    ]
