"""Vector compression (int8, sign bits, product codes) and search over the codes."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions import vectors
from ravelin.operators.nearest import ranked, search, to_matrix
from ravelin.operators.ordering import exact_quantiles
from ravelin.session import broadcast_if_small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("none", "scalar", "binary", "product")


def scalar_bounds(df: DataFrame, quantile: float = 0.99, vec: str = "embedding") -> tuple[float, float]:
    """The two component values that hold the central `quantile` of all components."""
    parts = df.select(F.explode(vectors.as_double(F.col(vec))).alias("x"))
    tail = round((1 - quantile) / 2, 12)
    row = exact_quantiles(parts, [], "x", [tail, 1 - tail]).first()
    return row["q0"], row["q1"]


def scalar_quantize(df: DataFrame, bounds: tuple[float, float], vec: str = "embedding", out: str = "code") -> DataFrame:
    """float32 -> int8, clipped at the bounds (4x smaller)."""
    return df.withColumn(out, vectors.int8_codes(F.col(vec), *bounds)).drop(vec)


def binary_quantize(df: DataFrame, vec: str = "embedding", out: str = "code") -> DataFrame:
    """One bit per dimension, packed in bigints (32x smaller)."""
    return df.withColumn(out, vectors.sign_words(F.col(vec))).drop(vec)


def scalar_decoder(low: float, high: float):
    def decode(codes: np.ndarray) -> np.ndarray:
        return low + (codes.astype(np.float64) + 128) / 255 * (high - low)

    return decode


def binary_decoder(dim: int):
    def decode(words: np.ndarray) -> np.ndarray:
        octets = np.ascontiguousarray(words.astype("<i8")).view(np.uint8)
        return np.unpackbits(octets, axis=1, bitorder="little")[:, :dim].astype(np.float64)

    decode.packed = True  # the words have no bits beyond `dim`, so distances may be counted in them
    return decode


def product_decoder(books: np.ndarray):
    """`books` is (subspaces, centroids, dims): each code byte stands for one centroid."""
    m, _, width = books.shape

    def decode(codes: np.ndarray) -> np.ndarray:
        picked = books[np.arange(m)[None, :], codes.astype(np.int64) & 255]
        return picked.reshape(len(codes), m * width)

    return decode


def train_codebooks(
    df: DataFrame, m: int | None = None, ks: int = 256, iterations: int = 8, *, item_id: str = "chunk_id", vec: str = "embedding"
) -> np.ndarray:
    """One codebook per subspace by Lloyd iterations over the whole table (Jégou et al., 2011).

    Every pass reduces each partition to (subspace, centroid) sums, which are merged by key; only
    the codebooks, m x ks x (dim/m) numbers, reach the driver. The start is a fixed choice: the rows
    with the smallest hashed ids.
    """
    dim = df.select(F.size(vec)).first()[0]
    m = m or dim // 4
    if dim % m:
        raise ValueError(f"{dim} dimensions do not split into {m} subspaces")
    if ks > 256:
        raise ValueError("a code is one byte: at most 256 centroids")
    start = df.select(F.xxhash64(item_id).alias("h"), vec).orderBy("h").limit(ks).toArrow()
    seeds = to_matrix(start.column(vec), None)
    width = dim // m
    books = np.stack([seeds[:, s * width : (s + 1) * width] for s in range(m)])
    for _ in range(iterations):
        shared = df.sparkSession.sparkContext.broadcast(books)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = shared.value
            m, ks, width = books.shape
            total, count = np.zeros_like(books), np.zeros((m, ks), np.int64)
            for batch in batches:
                matrix = to_matrix(batch.column(0), None)
                for s in range(m):
                    part = matrix[:, s * width : (s + 1) * width]
                    at = nearest_centroid(part, books[s])
                    count[s] += np.bincount(at, minlength=ks)
                    np.add.at(total[s], at, part)
            s, c = np.nonzero(count)
            yield pa.RecordBatch.from_pandas(
                pd.DataFrame({"s": s, "c": c, "n": count[s, c], "v": list(total[s, c])}), preserve_index=False
            )

        merged = df.select(vec).mapInArrow(sums, "s bigint, c bigint, n bigint, v array<double>")
        means = merged.select("s", "c", "n", F.posexplode("v").alias("d", "x")).groupBy("s", "c", "d").agg(
            F.sum("n").alias("n"), F.sum("x").alias("x")
        )
        rows = means.toPandas()
        moved = books.copy()
        moved[rows["s"], rows["c"], rows["d"]] = rows["x"] / rows["n"]
        shift, books = float(np.abs(moved - books).max()), moved
        shared.unpersist()
        if shift < 1e-6:
            break
    return books


def nearest_centroid(part: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(axis=1)[None, :] - 2 * part @ book.T, axis=1)


def product_quantize(df: DataFrame, books: np.ndarray, *, vec: str = "embedding", out: str = "code") -> DataFrame:
    """dim/m floats -> 1 byte (16x smaller at four dims to a byte)."""
    shared = df.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("array<smallint>")
    def encode(column: pd.Series) -> pd.Series:
        books = shared.value
        m, _, width = books.shape
        matrix = np.stack(column.to_numpy()).astype(np.float64)
        codes = np.stack([nearest_centroid(matrix[:, s * width : (s + 1) * width], books[s]) for s in range(m)], axis=1)
        return pd.Series(list(codes.astype(np.int16)))

    return df.withColumn(out, encode(F.col(vec))).drop(vec)


def compression_report(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """Bytes per vector and ratio to float32 of each scheme."""
    dims = df.agg(F.max(F.size(vec)).alias("dim"))
    raw = F.col("dim") * 4
    sizes = {
        "none": raw,
        "scalar": F.col("dim"),
        "binary": F.ceil(F.col("dim") / 8),
        "product": F.ceil(F.col("dim") / 4),
    }
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), b.cast("bigint").alias("bytes"), F.round(raw / b, 2).alias("ratio"))
            for k, b in sizes.items()
        ]
    )
    return dims.select(F.inline(rows))


class Codes:
    """A coded table with what it takes to score it: built once, searched many times.

    Columns named in `carry` stay beside the codes, such as the cell a search is keyed by.
    """

    def __init__(
        self, kind: str, items: DataFrame, *, item_id: str = "chunk_id", vec: str = "embedding", carry: Sequence[str] = (), **training
    ):
        if kind not in KINDS:
            raise ValueError(f"no code called {kind!r}: {KINDS}")
        self.kind, self.item_id, self.vec = kind, item_id, vec
        keep = items.select(item_id, vec, *carry)
        if kind == "scalar":
            self.bounds = training.get("bounds") or scalar_bounds(items, training.get("quantile", 0.99), vec)
            self.table = scalar_quantize(keep, self.bounds, vec)
        elif kind == "binary":
            self.dim = items.select(F.size(vec)).first()[0]
            self.table = binary_quantize(keep, vec)
        elif kind == "product":
            self.books = train_codebooks(items, item_id=item_id, vec=vec, **training)
            self.table = product_quantize(keep, self.books, vec=vec)
        else:
            self.table = keep.withColumnRenamed(vec, "code")

    def topk(self, queries: DataFrame, k: int, key: str | None = None, **layout) -> DataFrame:
        """Rank by the codes alone, within equal `key` where given; product codes keep the query in floats."""
        queries = queries.select("query_id", *([key] if key else []), self.vec)
        options = {"item_id": self.item_id, "vec": "code", "key": key, **layout}
        if self.kind == "scalar":
            coded = scalar_quantize(queries, self.bounds, self.vec)
            decode = scalar_decoder(*self.bounds)
            return search(coded, self.table, k, "dot_product", decode=decode, probe_decode=decode, **options)
        if self.kind == "binary":
            coded = binary_quantize(queries, self.vec)
            decode = binary_decoder(self.dim)
            return search(coded, self.table, k, "hamming", decode=decode, probe_decode=decode, **options)
        decode = product_decoder(self.books) if self.kind == "product" else None
        return search(queries.withColumnRenamed(self.vec, "code"), self.table, k, "dot_product", decode=decode, **options)


def quantized_topk(
    queries: DataFrame,
    items: DataFrame,
    codes: Codes,
    k: int = 10,
    oversampling: float = 3.0,
    rescore: bool = True,
    metric: str = "dot_product",
    **layout,
) -> DataFrame:
    """Top-k by codes; with `rescore`, the best ceil(k * oversampling) are re-scored on the stored floats."""
    if not rescore:
        return codes.topk(queries, k, **layout)
    wide = codes.topk(queries, math.ceil(k * oversampling), **layout)
    return rescored(wide, queries, items, k, metric, codes.item_id, codes.vec)


def rescored(
    wide: DataFrame, queries: DataFrame, items: DataFrame, k: int, metric: str, item_id: str = "chunk_id", vec: str = "embedding"
) -> DataFrame:
    return ranked(pair_scores(wide, queries, items, metric, item_id, vec), k, ["query_id"], item_id)


def pair_scores(
    wide: DataFrame, queries: DataFrame, items: DataFrame, metric: str, item_id: str = "chunk_id", vec: str = "embedding", carry: Sequence[str] = ()
) -> DataFrame:
    """The found pairs with their score on the stored floats, and the columns named in `carry`."""
    asked = queries.select("query_id", F.col(vec).alias("_q"))
    floats = items.select(item_id, F.col(vec).alias("_v"))
    pairs = broadcast_if_small(wide.select("query_id", item_id, *carry)).join(floats, item_id).join(asked, "query_id")
    return pairs.withColumn("score", vectors.score(metric, F.col("_q"), F.col("_v"))).drop("_q", "_v")
