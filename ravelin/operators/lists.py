"""Approximate top-k over many small lists: a two-level quantizer, and probing that stops by a bound on the distance."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.operators.nearest import CELL_ITEMS, CELL_PAIRS, CELL_PROBES, Vectors, best_pairs, cell_parts, k_first, places_of, ranked, search, to_matrix
from ravelin.session import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lists for each root of the number of items, and the bytes that all centres may take (they are broadcast): beyond that
#: lists get longer, never the centres more.
LISTS_PER_ROOT, CENTRE_BYTES = 8, 64 << 20
#: The quantizer is fitted on so many items for each list, and not more than this in all, chosen by a hash of the id.
SAMPLE_PER_LIST, SAMPLE_ROWS = 32, 400_000
#: A list with more than this many times the intended mean (or LEAST_LIST items) is cut into parts that share its centre.
FULL, LEAST_LIST = 4, 64
#: Coarse cells whose centres an item is compared with.
NEAR_COARSE = 3
#: Standard deviations that an item's squared distance is expected to lie below its list's mean at most.
REACH = 2.45
#: A search opens with the nearest lists that hold this many times k items, so that the k-th score is a tight bound.
OPENING = 16
ROUNDS = 12
#: Queries whose distances to all centres, and to the centres of a cell's lists, are held at once.
PROBE_ROWS, CELL_ROWS = 256, 4096


@dataclass(frozen=True)
class ListIndex:
    """Items with their list (`list`, unit vectors for cosine), and of each list the centre, radius, mean square and size."""

    items: DataFrame
    lists: DataFrame
    metric: str


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix**2).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _nearest(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(matrix @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)


def _fine(per_row: float):
    """The centres of one coarse cell's sample; the sample as a whole is bounded by SAMPLE_ROWS."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(frame["unit"].tolist(), dtype=np.float64)
        wanted = max(1, min(len(rows), round(len(rows) * per_row)))
        order = np.argsort(frame["at"].to_numpy(), kind="stable")
        centres = np.unique(rows[order[:wanted]], axis=0)
        for _ in range(ROUNDS):
            near = _nearest(rows, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, rows)
            counts = np.bincount(near, minlength=len(centres))[:, None]
            centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
        return pd.DataFrame({"coarse": [int(frame["coarse"].iloc[0])] * len(centres), "centre": centres.tolist()})

    return run


def _assign(shared, vec: str, cosine: bool, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coarse, members = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = to_matrix(batch.column(vec), None)
            rows = _unit(rows) if cosine else rows
            order = np.argsort(-(rows @ coarse.T - 0.5 * (coarse**2).sum(axis=1)), axis=1)[:, :NEAR_COARSE]
            best, at = np.full(len(rows), np.inf), np.zeros(len(rows), dtype=np.int64)
            for cell in np.unique(order).tolist():
                own = np.flatnonzero((order == cell).any(axis=1))
                first, centres = members[cell]
                if not len(centres):
                    continue
                near = _nearest(rows[own], centres)
                far = ((rows[own] - centres[near]) ** 2).sum(axis=1)
                closer = far < best[own]
                best[own[closer]], at[own[closer]] = far[closer], first + near[closer]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(at), pa.array(best)], names=[*kept, "cell", "far"])

    return run


def build_lists(items: DataFrame, metric: str = "cosine", *, item_id: str = "chunk_id", vec: str = "embedding", lists: int | None = None, seed: int = 7) -> ListIndex:
    """Deal all items into about LISTS_PER_ROOT x sqrt(n) lists.

    A coarse quantizer has the root of that number of cells; each is quantized again on its own part of a bounded sample.
    Every item goes to the nearest centre among its NEAR_COARSE coarse cells. Lists that are too full are cut by a hash of
    the id, so no list grows with a crowd of equal vectors. Rows without a vector are left out.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"lists serve cosine and euclidean, not {metric!r}")
    spark, cosine = items.sparkSession, metric == "cosine"
    items = items.where(F.col(vec).isNotNull())
    facts = items.agg(F.count("*").alias("n"), F.max(F.size(vec)).alias("dim")).first()
    n, dim = facts["n"], max(1, facts["dim"] or 1)
    wanted = max(1, min(lists or round(LISTS_PER_ROOT * n**0.5), CENTRE_BYTES // (8 * dim), max(1, n)))
    sample_rows = min(n, SAMPLE_PER_LIST * wanted, SAMPLE_ROWS)
    vector = F.col(vec).cast("array<double>")
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    unit = F.when(length > 0, F.transform(vector, lambda x: x / length)).otherwise(vector) if cosine else vector
    at = F.xxhash64(item_id)
    share = F.pmod(at, F.lit(1 << 20)) < F.lit(int(1.02 * (1 << 20) * sample_rows / max(1, n)) + 1)
    sample = checkpointed(items.where(share).select(at.alias("at"), unit.alias("unit")))
    drawn = sample.count()
    if not drawn:
        sample, drawn = items.select(at.alias("at"), unit.alias("unit")).limit(1), 1
    features = sample.withColumn("features", array_to_vector("unit"))
    if not n:
        empty = items.select(item_id, vec, F.lit(0).cast("long").alias("list"))
        return ListIndex(empty, spark.createDataFrame([], f"list long, {vec} array<double>, radius double, spread double, n long"), metric)
    model = KMeans(k=max(2, round(wanted**0.5)), seed=seed, maxIter=ROUNDS, featuresCol="features", predictionCol="coarse").fit(features)
    coarse = np.array(model.clusterCenters(), dtype=np.float64)
    placed = model.transform(features).select("at", "unit", "coarse")
    found = placed.groupBy("coarse").applyInPandas(_fine(wanted / drawn), "coarse int, centre array<double>").toPandas()  # CENTRE_BYTES at most
    members, centres = {}, []
    for cell in range(len(coarse)):
        own = found.loc[found["coarse"] == cell, "centre"].tolist()
        members[cell] = (len(centres), np.array(own, dtype=np.float64).reshape(-1, dim))
        centres += own
    shared = spark.sparkContext.broadcast((coarse, members))
    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(item_id, vec)
    dealt = rows.mapInArrow(_assign(shared, vec, cosine, [item_id, vec]), f"`{item_id}` {kind}, `{vec}` {items.schema[vec].dataType.simpleString()}, cell long, far double")
    dealt = checkpointed(dealt)
    full = max(LEAST_LIST, FULL * -(-n // wanted))
    sizes = dealt.groupBy("cell").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / F.lit(full))
    listed = dealt.join(F.broadcast(sizes), "cell")  # a row for each centre at most
    listed = listed.withColumn("list", F.col("cell") + F.lit(len(centres)) * F.pmod(F.xxhash64(item_id), parts))
    table = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], f"cell long, {vec} array<double>")
    summed = listed.groupBy("list", "cell").agg(F.sqrt(F.max("far")).alias("radius"), F.avg("far").alias("spread"), F.count("*").alias("n"))
    return ListIndex(listed.select(item_id, vec, "list"), checkpointed(summed.join(table, "cell").select("list", vec, "radius", "spread", "n")), metric)


def save_lists(index: ListIndex, path: str) -> ListIndex:
    """Store the lists sorted by list, so that a search skips the row groups of lists it does not probe."""
    spark = index.items.sparkSession
    index.items.repartitionByRange("list").sortWithinPartitions("list").write.mode("overwrite").parquet(f"{path}/lists")
    index.lists.write.mode("overwrite").parquet(f"{path}/centres")
    return replace(index, items=spark.read.parquet(f"{path}/lists"), lists=spark.read.parquet(f"{path}/centres"))


def _far2(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1), 0.0)


def _within(far2: np.ndarray, worst: np.ndarray, radius: np.ndarray, spread: np.ndarray, dim: int, reach: float | None, cosine: bool) -> np.ndarray:
    """Lists that may hold an item better than the k-th score `worst` (nan: none known)."""
    limit = np.where(np.isnan(worst), np.inf, 2 - 2 * worst if cosine else worst**2)[:, None] + 1e-9
    far = np.sqrt(far2)
    if reach is None:
        nearest = np.maximum(far - radius, 0.0) ** 2
    else:
        nearest = far2 + spread - reach * 2 * far * np.sqrt(spread / dim)
    return nearest <= limit


def _probe(shared, k: int, first: int, reach: float | None, cosine: bool, vec: str):
    """Lists to read for each query: at first the nearest ones (`edge`: the last one's distance), later those that may hold an item better than the k-th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, centres, radius, spread, sizes = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, PROBE_ROWS):
                batch = whole.slice(start, PROBE_ROWS)
                rows = to_matrix(batch.column(vec), None)
                rows = _unit(rows) if cosine else rows
                far2 = _far2(rows, centres)
                order = np.argsort(far2, axis=1, kind="stable")
                enough = np.cumsum(sizes[order], axis=1)
                opening = np.maximum(first, 1 + (enough < OPENING * k).sum(axis=1))
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.broadcast_to(np.arange(len(lists)), order.shape), axis=1)
                opened = place < opening[:, None]
                edge = np.where(opened, far2, 0.0).max(axis=1)
                if "worst" in batch.schema.names:
                    worst = batch.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)
                    opened = ~opened & _within(far2, worst, radius, spread, centres.shape[1], reach, cosine)
                which, at = np.nonzero(opened)
                ids = batch.column("query_id").take(pa.array(which))
                yield pa.RecordBatch.from_arrays([ids, pa.array(lists[at]), pa.array(edge[which])], names=["query_id", "list", "edge"])

    return run


def _read_lists(shared, k: int, reach: float | None, metric: str, item_id: str, vec: str):
    """The k best of a cell's items for each of its queries, over the lists that the query must read."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lists, centres, radius, spread, _ = shared.value
        ids = right.column(item_id).combine_chunks()
        order = pc.sort_indices(ids)
        right, ids = right.take(order), ids.take(order)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if left.num_rows and right.num_rows:
            queries, items, own = Vectors(left.column(vec), None), Vectors(right.column(vec), None), places_of(right.column("list"))
            at = np.searchsorted(lists, np.array(list(own)))
            worst, edge = (left.column(c).to_numpy().astype(np.float64) for c in ("worst", "edge"))
            floor = np.where(np.isnan(worst), -np.inf, worst)
            for start in range(0, left.num_rows, CELL_ROWS):
                rows = queries.rows[start : start + CELL_ROWS].astype(np.float64)
                span = slice(start, start + len(rows))
                far2 = _far2(_unit(rows) if metric == "cosine" else rows, centres[at])
                opened = far2 <= edge[span, None] * (1 + 1e-9) + 1e-12
                opened |= _within(far2, worst[span], radius[at], spread[at], centres.shape[1], reach, metric == "cosine")
                parts, waiting = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))], 0
                for n, members in enumerate(own.values()):
                    which = start + np.flatnonzero(opened[:, n])
                    if len(which):
                        parts.append(best_pairs(queries, items, k, metric, which, members, floor[which]))
                        waiting += len(parts[-1][0])
                    if waiting > 4 * k * CELL_ROWS:
                        parts, waiting = [_best(parts, k)], 0
                found.append(_best(parts, k))
        r, c, s = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": left.column("query_id").take(pa.array(r)), item_id: ids.take(pa.array(c)), "score": pa.array(s)})

    return run


def _best(parts: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r, c, s = (np.concatenate(x) for x in zip(*parts))
    kept = k_first(r, s, c, k)
    return r[kept], c[kept], s[kept]


def lists_topk(queries: DataFrame, index: ListIndex, k: int = 10, *, first: int = 2, reach: float | None = REACH, item_id: str = "chunk_id", vec: str = "embedding", **layout) -> DataFrame:
    """The k best items of each query among the lists it probes: (query_id, item, score, rank).

    The nearest lists that hold OPENING x k items (`first` at least) are read first. The k-th score found there bounds the rest: a
    list is read if an item of it may beat that score. With `reach` None the bound is the triangle inequality on the
    list's radius, and the result is exact; else an item's squared distance is taken to lie at most `reach` standard
    deviations below what its list's mean square and the distance to its centre lead to expect.

    The rest is read in cells of whole lists and a part of the queries: a cell itself tells which of its lists a query
    reads, so that no row stands for a query and a list.
    """
    spark = queries.sparkSession
    shared = _shared(index, vec)
    if shared is None:
        asked = queries.select("query_id", vec, F.lit(0).cast("long").alias("list"))
        return search(asked, index.items, k, index.metric, key="list", item_id=item_id, vec=vec, **layout)
    asked, opening, worst = _opened(queries, index, shared, k, first, item_id, vec, **layout)
    edges = opening.groupBy("query_id").agg(F.max("edge").alias("edge"))
    probes = checkpointed(asked.join(edges, "query_id").join(worst, "query_id", "left").join(queries.select("query_id"), "query_id"))
    size = int(shared.value[4].sum())
    salts, shards = cell_parts(spark, size, probes.count(), k, layout.get("cell_items", CELL_ITEMS), layout.get("cell_probes", CELL_PROBES), CELL_PAIRS // 16)
    probes = probes.select(
        "query_id",
        *(F.col(c).alias(c) for c in (vec, "worst", "edge")),
        F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int").alias("_shard"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
    )
    items = index.items.select(
        *(F.col(c).alias(c) for c in (item_id, vec, "list")),
        F.pmod(F.xxhash64("list"), F.lit(salts)).cast("int").alias("_salt"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"),
    )
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, `{item_id}` {index.items.schema[item_id].dataType.simpleString()}, score double"
    read = _read_lists(shared, k, reach, index.metric, item_id, vec)
    found = probes.groupBy("_shard", "_salt").cogroup(items.groupBy("_shard", "_salt")).applyInArrow(read, schema)
    return ranked(found, k, ["query_id"], item_id)


def _shared(index: ListIndex, vec: str):
    """(list, centre, radius, spread, size) of all lists, in the order of their numbers; None if there are none."""
    table = index.lists.orderBy("list").toPandas()  # CENTRE_BYTES of centres, and parts of full lists
    if not len(table):
        return None
    centres = np.array(table[vec].tolist(), dtype=np.float64)
    facts = (table["list"].to_numpy(), centres, table["radius"].to_numpy(), table["spread"].to_numpy(), table["n"].to_numpy())
    return index.lists.sparkSession.sparkContext.broadcast(facts)


def _lists_of(rows: DataFrame, shared, k: int, first: int, reach: float | None, cosine: bool, vec: str) -> DataFrame:
    kind = rows.schema["query_id"].dataType.simpleString()
    return checkpointed(rows.mapInArrow(_probe(shared, k, first, reach, cosine, vec), f"query_id {kind}, list long, edge double"))


def _opened(queries: DataFrame, index: ListIndex, shared, k: int, first: int, item_id: str, vec: str, **layout) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The queries with a vector, the lists that they open with, and the k-th score found in those."""
    asked = queries.select("query_id", vec).where(F.col(vec).isNotNull())
    opening = _lists_of(asked, shared, k, first, None, index.metric == "cosine", vec)
    hits = search(opening.join(asked, "query_id"), index.items, k, index.metric, key="list", item_id=item_id, vec=vec, **layout)
    return asked, opening, hits.where(F.col("rank") == k).select("query_id", F.col("score").alias("worst"))


def probed_lists(queries: DataFrame, index: ListIndex, k: int = 10, *, first: int = 2, reach: float | None = REACH, item_id: str = "chunk_id", vec: str = "embedding", **layout) -> tuple[DataFrame, DataFrame]:
    """(query_id, list) that a search opens with, and those that it reads afterwards."""
    shared = _shared(index, vec)
    if shared is None:
        none = queries.sparkSession.createDataFrame([], f"query_id {queries.schema['query_id'].dataType.simpleString()}, list long")
        return none, none
    asked, opening, worst = _opened(queries, index, shared, k, first, item_id, vec, **layout)
    rest = asked.join(worst, "query_id", "left").select("query_id", vec, "worst")
    return opening.drop("edge"), _lists_of(rest, shared, k, first, reach, index.metric == "cosine", vec).drop("edge")
