"""Bindings of the library to the supplied tables, and SQL text shared by the check queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import as_doubles
from millrace.sources.tables import lineitem_key, spread, table

SEED = 42


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "lineitem"), "l_orderkey")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """embeddings with double features."""
    return table(spark, folder, "embeddings").select("vec_id", as_doubles(F.col("embedding")).alias("features"), "label")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def text_parts(spark: SparkSession, folder: str) -> int | None:
    """Partitions for the terms of documents: four a file split, or nothing where the session's own number is enough."""
    wanted = 4 * table(spark, folder, "documents").rdd.getNumPartitions()
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def lineitem_keys() -> list[Column]:
    return lineitem_key()


def sql_digest(seed, *keys: str) -> str:
    return f"md5(concat_ws('-', '{seed}', {', '.join(keys)}))"


def sql_unit(seed, *keys: str) -> str:
    return f"(('0x' || substr({sql_digest(seed, *keys)}, 1, 8))::BIGINT / 4294967296::DOUBLE)"


SQL_LINEITEM_KEY = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "strftime(l_shipdate, '%Y%m%d')",
)
SQL_LINEITEM_UNIT = sql_unit(SEED, *SQL_LINEITEM_KEY)
SQL_VECTORS = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings"


class Registry:
    """Query functions by name, each with its SQL twin where SQL can express it."""

    def __init__(self):
        self.queries = {}
        self.sql = {}

    def add(self, name: str, sql: str | None = None):
        def keep(fn):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return keep

    def merge(self, other: "Registry") -> None:
        self.queries.update(other.queries)
        self.sql.update(other.sql)
