"""Plain table reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Split a table that arrives in fewer than two pieces for a core; a larger one is left where it lies: each reading would shuffle it."""
    pieces = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= pieces else df.repartition(pieces, *keys)
