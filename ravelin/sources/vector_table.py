"""Stored vector tables: segments `<path>/data-<name>` of rows and `<path>/dead-<name>` of deleted ids, in parquet; the
one-row `<path>/meta`, written last, names the segments in their order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.functions import vectors
from ravelin.session import broadcast_if_small
from ravelin.sources.files import is_missing

UNIT_TOLERANCE = 1e-3


def read_meta(spark: SparkSession, path: str):
    """The table's (dim, metric, embedder, tenants apart, rows), or None where there is no table."""
    try:
        return spark.read.parquet(f"{path}/meta").first()
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def _checked(df: DataFrame, dim: int, normalized: bool) -> DataFrame:
    """Fail the write on a vector of another dimension, or on one that is not of unit length if promised so."""
    wrong_dim = F.concat(F.lit(f"expected {dim} dimensions, found "), F.size("embedding").cast("string"))
    checked = F.when(F.size("embedding") == dim, F.col("embedding")).otherwise(F.raise_error(wrong_dim))
    df = df.withColumn("embedding", checked)
    if normalized:
        length = vectors.norm(F.col("embedding"))
        unit = (length == 0) | (F.abs(length - 1) <= UNIT_TOLERANCE)
        off = F.raise_error(F.concat(F.lit("not a unit vector: length "), length.cast("string")))
        df = df.withColumn("embedding", F.when(unit, F.col("embedding")).otherwise(off))
    return df


def write_vectors(
    df: DataFrame,
    path: str,
    dim: int,
    *,
    normalized: bool = False,
    multitenant: bool = False,
    recreate: bool = True,
    embedder: str = "",
    id_column: str = "chunk_id",
) -> DataFrame:
    """Store vectors and return the whole table as read back.

    With `recreate` the given rows become the table. Without it they are added as a segment of their own, and nothing
    stored is written again: where both have an `id_column` the given rows replace those of the same id as the table is
    read. Of given rows that share an id one is kept then. Another dimension is an error.
    """
    spark = df.sparkSession
    meta = read_meta(spark, path)
    if meta is None or recreate:
        segment = _write_segment(_checked(df, dim, normalized), path, "data", multitenant)
        description = (dim, "dot_product" if normalized else "cosine", embedder, multitenant)
        return _describe(spark, path, description, [segment], id_column)
    if meta["dim"] != dim:
        raise ValueError(f"{path} has {meta['dim']} dimensions, the given rows {dim}")
    rows = _checked(df, dim, meta["metric"] == "dot_product")
    rows = rows.dropDuplicates([id_column]) if id_column in df.columns else rows
    segment = _write_segment(rows, path, "data", meta["multitenant"])
    description = (dim, meta["metric"], embedder or meta["embedder"], meta["multitenant"])
    return _describe(spark, path, description, [*meta["data"].split(","), segment], id_column)


def delete_vectors(ids: DataFrame, path: str, id_column: str = "chunk_id") -> DataFrame:
    """Mark the rows with the given ids as deleted: only the ids are written."""
    spark = ids.sparkSession
    meta = read_meta(spark, path)
    segment = _write_segment(ids.select(id_column).distinct(), path, "dead", False)
    description = tuple(meta[c] for c in ("dim", "metric", "embedder", "multitenant"))
    return _describe(spark, path, description, [*meta["data"].split(","), segment], id_column)


def compact_vectors(spark: SparkSession, path: str, id_column: str = "chunk_id") -> DataFrame:
    """Write the live rows as one segment; `remove_old` then frees the others."""
    meta = read_meta(spark, path)
    segment = _write_segment(read_vectors(spark, path, id_column), path, "data", meta["multitenant"])
    return _describe(spark, path, tuple(meta[c] for c in ("dim", "metric", "embedder", "multitenant")), [segment], id_column)


def remove_old(spark: SparkSession, path: str) -> list[str]:
    """Delete the segments that the table no longer names, and return their names. Readers of an older state lose them."""
    named = set(read_meta(spark, path)["data"].split(","))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(f.getPath().getName()) for f in files.listStatus(folder)]
    old = sorted(n for n in names if n.startswith(("data-", "dead-")) and n not in named)
    for name in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return old


def _write_segment(rows: DataFrame, path: str, kind: str, multitenant: bool) -> str:
    name = f"{kind}-{uuid.uuid4().hex}"
    if multitenant:
        # REBALANCE gathers each tenant's rows and splits a tenant too large for one partition.
        writer = rows.hint("rebalance", "tenant_id").write.partitionBy("tenant_id")
    else:
        writer = rows.write
    writer.parquet(f"{path}/{name}")
    return name


def _describe(spark: SparkSession, path: str, description: tuple, segments: list[str], id_column: str) -> DataFrame:
    """Name the table's segments, the change that readers see; then give the table."""
    rows = _live(spark, path, description[3], segments, id_column)
    row = (*description, rows.count(), ",".join(segments))
    spark.createDataFrame([row], "dim int, metric string, embedder string, multitenant boolean, rows bigint, data string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return rows


def _live(spark: SparkSession, path: str, multitenant: bool, segments: list[str], id_column: str) -> DataFrame:
    """The rows of all segments that no later one replaces or deletes.

    Later ids meet the rows by an anti join, broadcast while they are few; a table of one segment is read as it is.
    """

    def read(name: str) -> DataFrame:
        reader = spark.read
        if multitenant and name.startswith("data-"):
            inferred = reader.parquet(f"{path}/{name}").schema
            fields = [f"`{f.name}` {'string' if f.name == 'tenant_id' else f.dataType.simpleString()}" for f in inferred.fields]
            reader = reader.schema(", ".join(fields))
        return reader.parquet(f"{path}/{name}")

    frames = [read(name) for name in segments]
    if len(frames) == 1:
        return frames[0]
    at, of, out = "__segment", "__later", None
    for place, (name, frame) in enumerate(zip(segments, frames, strict=True)):
        if name.startswith("data-"):
            part = frame.withColumn(at, F.lit(place))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    marks = None
    for place, frame in enumerate(frames):
        if place and id_column in frame.columns:
            part = frame.select(F.col(id_column).alias(of), F.lit(place).alias(f"{of}_at"))
            marks = part if marks is None else marks.unionByName(part)
    if marks is None or id_column not in out.columns:
        return out.drop(at)
    last = broadcast_if_small(marks.groupBy(of).agg(F.max(f"{of}_at").alias(f"{of}_at")))
    return out.join(last, (F.col(id_column) == F.col(of)) & (F.col(f"{of}_at") > F.col(at)), "left_anti").drop(at)


def read_vectors(spark: SparkSession, path: str, id_column: str = "chunk_id") -> DataFrame:
    """The live rows; tenant values stay strings whatever they look like."""
    meta = read_meta(spark, path)
    return _live(spark, path, meta["multitenant"], meta["data"].split(","), id_column)


def open_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], dim: int, **options) -> DataFrame:
    """The existing table when its dimension fits and it has rows; otherwise build and store it."""
    meta = read_meta(spark, path)
    if meta is not None and meta["dim"] == dim and meta["rows"] > 0:
        return read_vectors(spark, path)
    return write_vectors(build(), path, dim, **options)
