"""A corpus pipeline of five stages: quality, line dedup, near-dedup, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
docs of the next. All stages but the last return the columns of documents, in their order and whatever else they hold:
columns pass through inside a struct, so that no name can clash. Empty tables give empty tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import lines, minhash, mixing, packing, quality
from millrace.session import shared_folder


#: Units whose ids a packing worker keeps: far fewer than the operator's own number, since workers outlive their stage.
KEPT_UNITS = 30_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from labelled rows that are not held out.

    Null and empty texts get the score of the bias alone; rows without an id are scored and never learned from; repeated
    rows are scored alike. Without any label all scores are one half, and all rows stay.
    """
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    model = quality.fit_quality(docs, labels, ~quality.held_out())
    scored = quality.score_quality(docs, model)
    return scored.where(F.col("score") >= quality.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def thin_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars is counted anew.

    A null text becomes empty; rows of one id, and those without one, count as one document each and all stay, ties go to
    the largest id. A document may lose all its lines and stays as an empty one.
    """
    thinned = lines.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        thinned = thinned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return thinned.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id and word sequence.

    Rows without a word all stay, null texts too. Rows without an id are told apart by their words, equal ones are one.
    """
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of smaller sources up to twice, so that the sources meet their tempered weights.

    A null source is a source of its own; null and empty texts count as one token.
    """
    return mixing.mix_sources(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens.

    A null or empty text is its end token alone, a null id stays null, repeated rows are documents of their own.
    """
    return packing.pack_documents(docs, packing.default_tokenizer(), kept=KEPT_UNITS)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", thin_lines),
    ("minhash near-dedup", drop_near_copies),
    ("source mixing", mix),
    ("packing", pack),
]

#: The classifier's scores have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces made from documents; what lies between the stages is written under the shared checkpoint folder."""
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(os.path.join(folder, str(number)))
        docs = spark.read.parquet(os.path.join(folder, str(number)))
    return docs
