"""Readers for label lines, raw text and variant dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.strings import without_bom


def parse_label_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """label<TAB>text lines; a line without exactly two fields is an error."""
    fields = F.split(without_bom(F.col(column)), "\t")
    checked = F.when(F.size(fields) == 2, fields).otherwise(
        F.raise_error(F.concat(F.lit("not two fields: "), F.col(column)))
    )
    keep = [c for c in lines.columns if c != column]
    split = lines.select(*keep, checked.alias("_f"))
    return split.select(*keep, F.col("_f")[0].cast("int").alias("label"), F.col("_f")[1].alias("text"))


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_label_lines(spark.read.text(path))


def read_corpus(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Lines, or one row per file."""
    return spark.read.text(path, wholetext=whole).select(
        F.col("_metadata.file_path").alias("source"), without_bom(F.col("value")).alias("text")
    )


def parse_variant_lines(lines: DataFrame, column: str = "value", line_no: str = "line_no") -> DataFrame:
    """'word variant variant ..' lines; the last line of a repeated word wins."""
    tokens = F.filter(F.split(without_bom(F.col(column)), r"\s+"), lambda t: t != "")
    split = lines.select(line_no, tokens.alias("_t")).where(F.size("_t") > 0)
    rows = split.select(line_no, F.col("_t")[0].alias("word"), F.slice("_t", 2, F.size("_t")).alias("variants"))
    return rows.groupBy("word").agg(F.max_by("variants", line_no).alias("variants"), F.max(line_no).alias("line_no"))


def read_variant_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line order is file, block, and position within the block."""
    order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    return parse_variant_lines(spark.read.text(path).select("value", order.alias("line_no")))
