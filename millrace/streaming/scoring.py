"""Score arriving rows with a fitted model: the same projection as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def feature_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def score_stream(model, rows: DataFrame, output: str, checkpoint: str, *args) -> StreamingQuery:
    """Write model.transform(rows) as Parquet; restarts from the checkpoint without repeats."""
    scored = model.transform(rows, *args)
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
