"""The given tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.functions.embedders import embed
from ravelin.operators.transforms import sentence_windows, word_windows
from ravelin.session import shared_path
from ravelin.sources.tables import read_table, spread


def scratch(spark: SparkSession, name: str) -> str:
    return shared_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back: later reads take only the columns they need."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def documents(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text, tenant_id, modality)."""
    rows = read_table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("source").alias("tenant_id"), F.col("lang").alias("modality")
    )
    return spread(rows, "doc_id")


def document_index(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents as searchable items."""
    return embed(documents(spark, d).select(F.col("doc_id").alias("chunk_id"), "text", "tenant_id"))


def chunk_index(spark: SparkSession, d: str, size: int, overlap: int) -> DataFrame:
    return embed(word_windows(documents(spark, d).select("doc_id", "text"), size, overlap))


def sentences(spark: SparkSession, d: str, window: int = 3) -> DataFrame:
    return sentence_windows(documents(spark, d).select("doc_id", "text"), window)


def sentence_index(spark: SparkSession, d: str) -> DataFrame:
    return embed(sentences(spark, d).withColumnRenamed("original_text", "text").select("chunk_id", "text"))


def questions(spark: SparkSession, d: str) -> DataFrame:
    """User turns as questions (query_id, conv_id, text)."""
    turns = read_table(spark, d, "conversations").where(F.col("role") == "user")
    rows = turns.select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), "conv_id", "text")
    return rows


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark passages as questions whose answer must hold the passage (query_id, text, expected)."""
    rows = read_table(spark, d, "benchmark")
    return rows.select(F.col("item_id").cast("string").alias("query_id"), "text", F.col("text").alias("expected"))


def unanswerable(spark: SparkSession, d: str) -> DataFrame:
    """System turns as questions the corpus is not asked to answer."""
    turns = read_table(spark, d, "conversations").where(F.col("role") == "system")
    return turns.select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), "text")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """(chunk_id, embedding, label)."""
    rows = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding", "label")
    return spread(rows, "chunk_id")


def scaled_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The same vectors with lengths 1 to 5, where length must matter."""
    factor = (1 + F.col("chunk_id") % 5).cast("double")
    return vectors(spark, d).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") * factor))


def as_queries(items: DataFrame) -> DataFrame:
    return items.select(F.col("chunk_id").alias("query_id"), "embedding")


def row_events(spark: SparkSession, d: str) -> DataFrame:
    """The event table as a change feed (value JSON, seq)."""
    events = read_table(spark, d, "events")
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    row = F.struct(
        F.col("user_id").alias("id"),
        F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("tenant_id"),
        F.col("event_type").alias("title"),
        F.col("props").alias("body"),
        F.col("ts").alias("updated_at"),
    )
    envelope = F.struct(
        op.alias("op"), F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after")
    )
    return events.select(F.to_json(envelope).alias("value"), F.col("event_id").alias("seq"))
