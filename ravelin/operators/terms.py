"""Stored term counts of a corpus, so that a reranker never reads the texts again.

`<path>/rows-<segment>` holds (chunk_id, length, terms: each distinct word with its count), `<path>/df-<segment>` the
number of chunks that hold each word, and `<path>/totals/segment=<segment>` one row, written last, that names the segment.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.functions.text import spaced_where_needed
from ravelin.functions.word_counts import byte_slices, counted_words
from ravelin.operators.membership import sifted
from ravelin.session import broadcast_if_small
from ravelin.sources.files import is_missing

# Task functions travel by value, so executors need numpy and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class TermIndex:
    rows: DataFrame  # chunk_id, length, terms array<struct<term, tf>>
    frequencies: DataFrame  # term, df
    docs: int
    mean_length: float


def term_counts(text: Column) -> Column:
    """(length, terms) of a text: its words, in their order as bytes, each with its count. A null text has neither."""

    @F.arrow_udf("struct<length: int, terms: array<struct<term: string, tf: int>>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [counted_words(texts.slice(at, end - at)) for at, end in byte_slices(texts)]
            yield pa.concat_arrays(parts or [counted_words(texts)])

    return counted(spaced_where_needed(text))


def add_terms(corpus: DataFrame, path: str) -> TermIndex:
    """Add the chunks of `corpus` (chunk_id, text) as one segment and return the whole index.

    Only the new chunks are read and written; the statistics of all segments add up. Chunk ids must be new: one that is
    stored already is an error. A null text counts as a chunk of unknown length without words.
    """
    spark, name = corpus.sparkSession, uuid.uuid4().hex
    known = segments(spark, path)
    if known:
        stored = _read(spark, path, "rows", known).select("chunk_id")
        if not corpus.select("chunk_id").join(stored, "chunk_id", "left_semi").isEmpty():
            raise ValueError(f"{path} holds chunks of the given ids already")
    corpus.select("chunk_id", term_counts(F.col("text")).alias("_c")).select("chunk_id", "_c.length", "_c.terms").write.option("compression", "zstd").parquet(f"{path}/rows-{name}")
    rows = _read(spark, path, "rows", [name])
    words = rows.select(F.explode("terms.term").alias("term"))
    words.groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{path}/df-{name}")
    totals = rows.agg(F.count("*").alias("docs"), F.count("length").alias("sized"), F.sum("length").alias("words"))
    totals.write.parquet(f"{path}/totals/segment={name}")
    return read_terms(spark, path)


def segments(spark: SparkSession, path: str) -> list[str]:
    try:
        found = spark.read.schema("docs bigint, sized bigint, words bigint, segment string").parquet(f"{path}/totals")
        return sorted(r["segment"] for r in found.select("segment").collect())  # one row a segment
    except AnalysisException as error:
        if is_missing(error):
            return []
        raise


def _read(spark: SparkSession, path: str, part: str, names: list[str]) -> DataFrame:
    return spark.read.parquet(*(f"{path}/{part}-{name}" for name in names))


def read_terms(spark: SparkSession, path: str) -> TermIndex:
    names = segments(spark, path)
    if not names:
        raise ValueError(f"no term index at {path}")
    totals = spark.read.parquet(f"{path}/totals").agg(F.sum("docs").alias("docs"), F.sum("sized").alias("sized"), F.sum("words").alias("words")).first()
    frequencies = _read(spark, path, "df", names)
    if len(names) > 1:
        frequencies = frequencies.groupBy("term").agg(F.sum("df").alias("df"))
    mean = totals["words"] / totals["sized"] if totals["words"] else 1.0
    return TermIndex(_read(spark, path, "rows", names), frequencies, totals["docs"], mean)


def counts_of(index: TermIndex, chunks: DataFrame) -> DataFrame:
    """(chunk_id, length, term, tf) of the given chunks; where those are too many to be broadcast, of a few others too.

    An exact join must follow, and only its rows are shuffled.
    """
    ids = broadcast_if_small(chunks.select("chunk_id").distinct())
    wanted = sifted(index.rows, ids, "chunk_id")
    if wanted is index.rows:
        wanted = wanted.join(ids, "chunk_id", "left_semi")
    return wanted.select("chunk_id", "length", F.inline("terms"))
