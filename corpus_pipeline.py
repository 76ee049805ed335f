"""From raw documents to packed training sequences: five stages, each stored before the next reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm import near_dedup, packing, pii, quality_classifier, quality_rules
from ravelin.llm.common import table, temp
from ravelin.session import shared_dir


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    names = (temp("held_out"), temp("score"), temp("predicted"))
    judged = quality_classifier.classify(docs, table(spark, sf_dir, "labels"), names=names)
    return judged.where(f"{names[2]} = 1").select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced, and n_chars as it is then."""
    replaced = pii.replace_pii(docs, pii.surrogate_key(spark), count=temp("n_entities"))
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack(docs)


STAGES = [("quality classifier", classify), ("quality rules", rules), ("near-dedup", dedup), ("pii", private), ("packing", pack)]

#: Neither a trained score nor surrogates nor token ids can be stated in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage's rows are written to the shared folder and read again.

    Null and empty texts count as bad documents, an empty table gives no pieces, long texts are read whole, of repeated
    rows one stays, and further columns, whatever their names, pass all stages but the last.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/ravelin-pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
