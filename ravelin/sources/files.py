"""Text, JSON and CSV files as documents: (doc_id, text, modality, file_name, file_path, metadata)."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ravelin.session import broadcast_if_small

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
DOCUMENT_COLUMNS = DOCUMENT_SCHEMA.fieldNames()


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENT_SCHEMA)


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def decoded_path() -> Column:
    """File metadata carries an encoded URI; give the plain path (a literal plus stays a plus)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def any_case(ext: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def _documents(df: DataFrame, modality: str) -> DataFrame:
    tags = F.create_map(F.lit("modality"), F.lit(modality), F.lit("file_name"), F.col("file_name"))
    return df.withColumns({"modality": F.lit(modality), "metadata": tags}).select(*DOCUMENT_COLUMNS)


def load_text(spark: SparkSession, directory: str, exts: Sequence[str] = (".txt", ".md"), recursive: bool = False) -> DataFrame:
    """One document per file; a missing or empty directory gives no rows."""
    try:
        raw = (
            spark.read.option("pathGlobFilter", "*{" + ",".join(exts) + "}")
            .option("recursiveFileLookup", str(recursive).lower())
            .text(directory, wholetext=True)
        )
    except AnalysisException as error:
        if is_missing(error):
            return no_documents(spark)
        raise
    path = decoded_path()
    rows = raw.select(
        path.alias("doc_id"), F.col("value").alias("text"), F.col("_metadata.file_name").alias("file_name"), path.alias("file_path")
    )
    return _documents(rows, "text")


def _with_row_ids(rows: DataFrame) -> DataFrame:
    """`doc_id` = file path and the row's place in its file.

    Multi-line files are read whole by one task in order, so a row's running id minus the smallest
    of its file is its place; the smallest comes from a map-side aggregate, not from sorting a file.
    """
    marked = rows.withColumn("_at", F.monotonically_increasing_id())
    first = marked.groupBy("file_path").agg(F.min("_at").alias("_first"))
    placed = marked.join(broadcast_if_small(first), "file_path")
    return placed.withColumn("doc_id", F.concat_ws("#", F.col("file_path"), (F.col("_at") - F.col("_first")).cast("string")))


def _as_text(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
        return F.array_join(value.cast("array<string>"), ", ")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast("string")


def rejected_json(spark: SparkSession, directory: str, recursive: bool = False, lines: bool = False) -> DataFrame:
    """(file_path, raw): what `load_json` could not read as an object."""
    try:
        raw = _json_reader(spark, recursive, lines).schema("_corrupt_record string, _ string").json(directory)
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], "file_path string, raw string")
        raise
    return raw.select(decoded_path().alias("file_path"), F.coalesce("_corrupt_record", "_").alias("raw")).where("raw is not null")


def _json_reader(spark: SparkSession, recursive: bool, lines: bool):
    return (
        spark.read.option("multiLine", str(not lines).lower())
        .option("pathGlobFilter", "*.jsonl" if lines else "*.json")
        .option("recursiveFileLookup", str(recursive).lower())
    )


def load_json(spark: SparkSession, directory: str, schema: T.StructType | None = None, recursive: bool = False, lines: bool = False) -> DataFrame:
    """One document per top-level array element (or per file holding one object): `key: value` lines.

    With `lines` the folder's .jsonl files are read, an object a line, split among tasks. What is no object gives no
    document; `rejected_json` has it.
    """
    bad = "_corrupt_record"
    try:
        found = schema or _json_reader(spark, recursive, lines).json(directory).schema
        fields = [f for f in found.fields if f.name != bad]
        if not fields:
            return no_documents(spark)
        asked = T.StructType([*fields, T.StructField(bad, T.StringType())])
        raw = _json_reader(spark, recursive, lines).schema(asked).json(directory)
    except AnalysisException as error:
        if is_missing(error):
            return no_documents(spark)
        raise
    # An object is there if it was read without a fault, or with a field at least.
    raw = raw.where(reduce(or_, (F.col(f"`{f.name}`").isNotNull() for f in fields), F.col(bad).isNull()))
    lines = [
        F.when(F.col(f"`{f.name}`").isNotNull(), F.concat(F.lit(f"{f.name}: "), _as_text(f.name, f.dataType))) for f in fields
    ]
    rows = raw.select(
        F.concat_ws("\n", *lines).alias("text"), F.col("_metadata.file_name").alias("file_name"), decoded_path().alias("file_path")
    )
    return _documents(_with_row_ids(rows), "json")


def _record_widths(lines: DataFrame) -> DataFrame:
    """(file_path, _record, _width) of each record: a line goes on in the next while a quote is open. Blank lines are none."""
    order = Window.partitionBy("file_path").orderBy("_block", "_at")
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    lines = lines.withColumn("_open", (F.sum(quotes).over(order) - quotes) % 2 == 1).withColumn("_shut", (F.sum(quotes).over(order)) % 2 == 0)
    whole = F.concat(F.when(F.col("_open"), F.lit('"')).otherwise(F.lit("")), F.col("value"), F.when(F.col("_shut"), F.lit("")).otherwise(F.lit('"')))
    commas = F.length(F.regexp_replace(F.regexp_replace(whole, '"[^"]*"', ""), "[^,]", ""))
    first = (~F.col("_open") & (F.col("value") != "")).cast("long")
    numbered = lines.select("file_path", F.sum(first).over(order).alias("_record"), commas.alias("_commas"), "_open", "value").where("_open or value != ''")
    return numbered.groupBy("file_path", "_record").agg((F.sum("_commas") + 1).cast("int").alias("_width"))


def load_csv(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """One document per data row: its values joined by a comma and a blank, the header left out.

    Every file has a header of its own. All are read as wide as the widest record of any file; each row has its file's
    width, or more where it holds further values, so what a row gives does not hang on the files beside it.
    """
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", str(recursive).lower())
    try:
        lines = reader.text(directory).select("value", decoded_path().alias("file_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
        widths = broadcast_if_small(_record_widths(lines).groupBy("file_path").agg(F.min_by("_width", "_record").alias("_width"), F.max("_width").alias("_most")))
    except AnalysisException as error:
        if is_missing(error):
            return no_documents(spark)
        raise
    widest = widths.agg(F.max("_most")).first()[0]
    if widest is None:
        return no_documents(spark)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(widest)])
    raw = reader.schema(schema).option("header", "true").option("multiLine", "true").option("escape", '"').csv(directory)
    rows = raw.select(F.array(*raw.columns).alias("_values"), F.col("_metadata.file_name").alias("file_name"), decoded_path().alias("file_path"))
    rows = rows.join(widths.drop("_most"), "file_path")
    filled = F.array_max(F.transform("_values", lambda v, i: F.when(v.isNotNull(), i + 1).otherwise(0)))
    values = F.transform(F.slice("_values", F.lit(1), F.greatest(F.col("_width"), filled)), lambda v: F.coalesce(v, F.lit("")))
    return _documents(_with_row_ids(rows.select(F.array_join(values, ", ").alias("text"), "file_name", "file_path")), "csv")


def load_tenant_tree(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Files below `<root>/<tenant>/` tagged with their tenant; `recursive=False` reads only the files directly in it."""
    base = (root if "://" in root else os.path.abspath(root)).rstrip("/") + "/"
    base = base.split("://", 1)[-1]
    try:
        raw = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    except AnalysisException as error:
        if is_missing(error):
            return spark.createDataFrame([], "doc_id string, tenant_id string, text string, file_name string")
        raise
    inner = raw.withColumn("_path", decoded_path()).withColumn(
        "doc_id", F.substr(F.col("_path"), F.instr("_path", base) + len(base))
    )
    depth = F.size(F.split("doc_id", "/"))
    kept = inner.where(depth >= 2 if recursive else depth == 2)
    return kept.select(
        "doc_id",
        F.split_part("doc_id", F.lit("/"), F.lit(1)).alias("tenant_id"),
        F.col("value").alias("text"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def load_corpus(
    spark: SparkSession, text: str | None = None, json: str | None = None, csv: str | None = None, media: Sequence[DataFrame] = (), **options
) -> DataFrame:
    """All documents of the given directories, then the extracted media documents."""
    loaders = ((load_text, text), (load_json, json), (load_csv, csv))
    parts = [load(spark, path, **options) for load, path in loaders if path] + list(media)
    out = no_documents(spark)
    for part in parts:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
