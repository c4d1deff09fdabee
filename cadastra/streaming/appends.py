"""Incremental load: what is new in a folder is appended once, whatever the number of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_new(spark: SparkSession, source: str, target: str, state: str) -> DataFrame:
    """Append the Parquet files under ``source`` not seen by ``state`` to ``target``; all of ``target``."""
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(target)
