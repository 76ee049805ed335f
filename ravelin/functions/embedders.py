"""Embedders: anything with `name`, `dim` and `column(text)`. The default needs no model and no network."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions import vectors
from ravelin.functions.text import spaced_where_needed
from ravelin.functions.word_counts import byte_slices, word_table

# Task functions travel by value, so executors need numpy and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Embedder(Protocol):
    name: str
    dim: int

    def apply(self, df: DataFrame, text: str, out: str) -> DataFrame: ...


def hashed_counts(texts: pa.Array, dim: int) -> np.ndarray:
    """Words of every bucket, one row for each text."""
    words, row, place = word_table(texts)
    hashed = np.frombuffer(b"".join([hashlib.md5(word).digest()[:4] for word in words.to_numpy(zero_copy_only=False)]), ">u4").astype(np.int64)
    return np.bincount(row * dim + (hashed % dim)[place], minlength=len(texts) * dim).reshape(len(texts), dim)


@dataclass(frozen=True)
class HashEmbedder:
    """Feature hashing (Weinberger et al., 2009), L2-normalized. Words are counted a few megabytes of texts at a time."""

    dim: int = 64

    @property
    def name(self) -> str:
        return f"hash-{self.dim}"

    def apply(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        dim = self.dim

        @F.arrow_udf("array<float>")
        def embedded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                out = np.empty((len(texts), dim), np.float32)
                for at, end in byte_slices(texts):
                    counts = hashed_counts(texts.slice(at, end - at), dim)
                    length = np.sqrt((counts * counts).sum(axis=1, dtype=np.float64))
                    out[at:end] = counts / np.where(length > 0, length, 1.0)[:, None]
                offsets = np.arange(0, out.size + 1, dim, dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.reshape(-1)))

        return df.withColumn(out, embedded(spaced_where_needed(F.coalesce(F.col(text), F.lit("")))))


@dataclass(frozen=True)
class ModelEmbedder:
    """A user model: `load()` runs once per worker task and returns texts -> list of vectors.

    The model is given at most `batch` texts at a time.
    """

    name: str
    dim: int
    load: Callable[[], Callable[[list[str]], list]]
    batch: int = 128

    def apply(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        load, size = self.load, self.batch
        if size < 1:
            raise ValueError(f"a batch of {size} texts")

        @F.pandas_udf("array<float>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                texts = batch.fillna("").tolist()
                found = [vector for at in range(0, len(texts), size) for vector in model(texts[at : at + size])]
                yield pd.Series(found, index=batch.index, dtype=object)

        return df.withColumn(out, encode(F.col(text)))


@dataclass(frozen=True)
class Normalized:
    """Any embedder with its output rescaled to unit length."""

    inner: Embedder

    @property
    def name(self) -> str:
        return f"l2({self.inner.name})"

    @property
    def dim(self) -> int:
        return self.inner.dim

    def apply(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        raw = self.inner.apply(df, text, "_raw_vector")
        return raw.withColumn(out, vectors.normalized(F.col("_raw_vector")).cast("array<float>")).drop("_raw_vector")


def embed(df: DataFrame, text: str = "text", embedder: Embedder | None = None, out: str = "embedding") -> DataFrame:
    return (embedder or HashEmbedder()).apply(df, text, out)
