"""Media files to text by a user-supplied producer, remembered in a cache table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.session import broadcast_if_small, checkpointed
from ravelin.sources.files import any_case, is_missing

# The extensions each kind of media accepts.
EXTENSIONS = {
    "audio": (".mp3", ".wav", ".m4a", ".flac"),
    "video": (".mp4", ".mov", ".mkv"),
    "image": (".png", ".jpg", ".jpeg", ".webp", ".bmp"),
    "pdf": (".pdf",),
}
CACHE_KINDS = {"audio": "transcript", "video": "transcript", "image": "caption", "pdf": "pdf"}
CACHE_SCHEMA = "key string, text string"
PAGE_CACHE_SCHEMA = "key string, texts array<string>"
FILE_SCHEMA = "path string, name string, size bigint, mtime_us bigint, content binary"

Producer = Callable[[str, bytes], str | None]
PageProducer = Callable[[str, bytes], list[str | None] | None]


def media_files(spark: SparkSession, directory: str, kind: str) -> DataFrame:
    pattern = "*{" + ",".join(any_case(e) for e in EXTENSIONS[kind]) + "}"
    try:
        raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], FILE_SCHEMA)
        raise
    return raw.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("mtime_us"),
        "content",
    )


def with_cache_key(files: DataFrame, cache_kind: str) -> DataFrame:
    """Key of a file version: any change of name, size or time gives a new one."""
    parts = F.concat_ws("|", F.lit(cache_kind), "name", F.col("size").cast("string"), F.col("mtime_us").cast("string"))
    return files.withColumn("key", F.substring(F.sha2(parts, 256), 1, 24))


def cache_split(files: DataFrame, cache: DataFrame, cache_kind: str) -> DataFrame:
    """Every file with its key and whether its text is known."""
    known = cache.select("key").distinct().withColumn("hit", F.lit(True))
    keyed = with_cache_key(files, cache_kind)
    return keyed.join(known, "key", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def _through_cache(files: DataFrame, producer: Callable, kind: str, cache: DataFrame, column: str, kept_as: str) -> DataFrame:
    """One row a file with what the cache or the producer has for it in `column`; files without anything give no row."""
    keyed = with_cache_key(files, CACHE_KINDS[kind])
    found = keyed.drop("content").join(cache.select("key", column).dropDuplicates(["key"]), "key")

    def produce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    made.append(producer(path, content) or None)
                except Exception as error:  # any failure means: skip this file
                    logging.getLogger("ravelin").warning("%s failed: %s", path, str(error)[:200])
                    made.append(None)
            out = batch.drop(columns=["content"])
            out[column] = pd.Series(made, index=out.index, dtype=object)
            yield out[out[column].notna()]

    # The unknown keys are found without the contents, which are then read for those files only.
    unknown = broadcast_if_small(keyed.select("key").join(cache.select("key"), "key", "left_anti"))
    missing = keyed.join(unknown, "key", "left_semi").select("key", "path", "name", "size", "mtime_us", "content")
    made = missing.mapInPandas(produce, f"key string, path string, name string, size bigint, mtime_us bigint, {column} {kept_as}")
    return found.withColumn("cached", F.lit(True)).unionByName(made.withColumn("cached", F.lit(False)))


def _as_documents(rows: DataFrame, kind: str) -> DataFrame:
    names = F.lit(kind).alias("modality"), F.col("name").alias("file_name"), F.col("path").alias("file_path")
    return rows.select("key", F.col("path").alias("doc_id"), "text", *names, "cached")


def _as_pages(rows: DataFrame, kind: str) -> DataFrame:
    pages = rows.select("key", "path", "name", "cached", F.posexplode("texts").alias("page", "text")).where(F.col("text") != "")
    names = F.lit(kind).alias("modality"), F.col("name").alias("file_name"), F.col("path").alias("file_path")
    return pages.select("key", F.concat_ws("#", "path", F.col("page").cast("string")).alias("doc_id"), "text", *names, "cached", "page")


def extract_text(files: DataFrame, producer: Producer, kind: str, cache: DataFrame) -> DataFrame:
    """Texts of the files: known ones from the cache (key, text), the rest from the producer.

    A producer that fails or finds nothing gives no row. Column `cached` tells the two apart.
    """
    return _as_documents(_through_cache(files, producer, kind, cache, "text", "string"), kind)


def extract_pages(files: DataFrame, producer: PageProducer, kind: str, cache: DataFrame) -> DataFrame:
    """Many documents a file: `producer` returns the texts of its pages, and each one becomes a row `<path>#<page>`.

    Pages count from 0; null and empty ones give no row and keep their number. The cache (key, texts) holds whole files.
    """
    return _as_pages(_through_cache(files, producer, kind, cache, "texts", "array<string>"), kind)


def extract_and_remember(
    spark: SparkSession, files: DataFrame, producer: Producer | PageProducer, kind: str, cache_path: str, pages: bool = False
) -> DataFrame:
    """`extract_text`, or `extract_pages`, against a stored cache; fresh texts are appended to it, each produced once."""
    schema, column, kept_as = (PAGE_CACHE_SCHEMA, "texts", "array<string>") if pages else (CACHE_SCHEMA, "text", "string")
    try:
        cache = spark.read.schema(schema).parquet(cache_path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        cache = spark.createDataFrame([], schema)
    rows = checkpointed(_through_cache(files, producer, kind, cache, column, kept_as))
    rows.where(~F.col("cached")).select("key", column).write.mode("append").parquet(cache_path)
    return (_as_pages if pages else _as_documents)(rows, kind)
