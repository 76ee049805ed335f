"""Reading, storing and Arrow helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.session import shared_dir

#: Rows that Python works on at a time, so that one Arrow batch of long texts is never unpacked as a whole.
SLICE_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write `df` once to the shared folder and go on from the files: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/ravelin-llm-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, jobs hand `rows` rows at a time to Python: bounds the Arrow buffers of wide rows on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null text counts as an empty one."""
    return [t or "" for t in batch.column(name).to_pylist()]


def arrow_batches(columns: dict[str, Sequence], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, Sequence]], spark_schema: str, arrow_schema: pa.Schema) -> DataFrame:
    """Row-wise work in Arrow: `work` maps a small batch to columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield arrow_batches(work(part), arrow_schema)

    return df.mapInArrow(run, spark_schema)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def temp(name: str) -> str:
    """A column name that no input table is expected to carry."""
    return f"__ravelin_{name}"
