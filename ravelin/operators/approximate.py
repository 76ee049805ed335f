"""Approximate top-k by cell probing (inverted lists)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.operators.nearest import search
from ravelin.operators.retrieval import tenant_topk
from ravelin.operators.transforms import keyed_items
from ravelin.session import checkpointed


@dataclass(frozen=True)
class CellIndex:
    """Items with their cell, and the cell centres."""

    items: DataFrame  # item id, embedding, cell (and tenant_id where lists are per tenant)
    centres: DataFrame  # cell, embedding
    cells: int
    by_tenant: bool


def build_cells(
    items: DataFrame,
    cells: int = 16,
    *,
    item_id: str = "chunk_id",
    vec: str = "embedding",
    by_tenant: bool = False,
    seed: int = 7,
    iterations: int = 20,
) -> CellIndex:
    """k-means cells over the whole table. With `by_tenant` every tenant has its own lists and no list is shared."""
    features = items.withColumn("_features", array_to_vector(F.col(vec).cast("array<double>")))
    model = KMeans(k=cells, seed=seed, maxIter=iterations, featuresCol="_features", predictionCol="cell").fit(features)
    assigned = model.transform(features).drop("_features")
    centres = items.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], f"cell int, {vec} array<double>"
    )
    keep = [item_id, vec, "cell"] + (["tenant_id"] if by_tenant else [])
    return CellIndex(assigned.select(*keep), centres, cells, by_tenant)


def _list_key(*columns: str):
    return F.to_json(F.struct(*columns))


def ann_topk(
    queries: DataFrame,
    index: CellIndex,
    k: int = 10,
    nprobe: int = 4,
    metric: str = "cosine",
    *,
    exact: bool = False,
    item_id: str = "chunk_id",
    vec: str = "embedding",
    **layout,
) -> DataFrame:
    """Search the `nprobe` cells nearest each query; with `exact` search every item.

    A per-tenant index takes queries with a `tenants` array and reads only those tenants' lists.
    """
    options = {"item_id": item_id, "vec": vec, **layout}
    items = index.items
    if exact:
        return (tenant_topk if index.by_tenant else search)(queries, items, k, metric, **options)
    probes = probe_cells(queries, index, nprobe, vec=vec, **layout)
    if index.by_tenant:
        probes = probes.withColumn("tenant_id", F.explode(F.array_distinct("tenants")))
        probes = probes.withColumn("_list", _list_key("tenant_id", "cell"))
        items = keyed_items(items, probes, "tenant_id").withColumn("_list", _list_key("tenant_id", "cell"))
        return search(probes, items, k, metric, key="_list", **options)
    return search(probes, keyed_items(items, probes, "cell"), k, metric, key="cell", **options)


def probe_cells(queries: DataFrame, index: CellIndex, nprobe: int, *, vec: str = "embedding", **layout) -> DataFrame:
    """Every query once per cell among its `nprobe` nearest (column `cell`)."""
    near = search(queries, index.centres, min(nprobe, index.cells), "euclidean", item_id="cell", vec=vec, **layout)
    return checkpointed(near.select("query_id", "cell")).join(queries, "query_id")


def save_cells(index: CellIndex, path: str) -> CellIndex:
    """Store the lists one directory per cell, so that a search reads only the cells it probes."""
    spark = index.items.sparkSession
    index.items.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/lists")
    index.centres.write.mode("overwrite").parquet(f"{path}/centres")
    return replace(index, items=spark.read.parquet(f"{path}/lists"), centres=spark.read.parquet(f"{path}/centres"))
