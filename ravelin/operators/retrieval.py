"""Top-k retrieval over whole query tables, rank fusion, recursion, fan-out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.functions import vectors
from ravelin.functions.embedders import Embedder, embed
from ravelin.operators.nearest import ranked, search
from ravelin.operators.transforms import best_per, doc_summary, keyed_items, with_text
from ravelin.session import checkpointed

METRIC_LABELS = ("cosine", "dot_product", "euclidean")
RRF_OFFSET = 60  # fixed value: Cormack et al., 2009


def topk(
    queries: DataFrame,
    items: DataFrame,
    k: int = 3,
    metric: str | Sequence[str] = "cosine",
    *,
    exclude_self: bool = False,
    normalized: bool = False,
    item_id: str = "chunk_id",
    **layout,
) -> DataFrame:
    """The `k` best items of every query. `normalized` lets the caller vouch for unit vectors (dot for cosine)."""
    metric = "dot_product" if normalized and metric == "cosine" else metric
    hits = search(queries, items, k + exclude_self, metric, item_id=item_id, **layout)
    if not exclude_self:
        return hits
    # The best k+1 hold the best k others, so dropping the query itself loses nothing.
    others = hits.where(F.col("query_id") != F.col(item_id)).drop("rank")
    return ranked(others, k, ["query_id"] if isinstance(metric, str) else ["metric", "query_id"], item_id)


def compare_metrics(queries: DataFrame, items: DataFrame, k: int = 3, **options) -> DataFrame:
    """The same questions under every metric, labelled, in one pass over the items."""
    return topk(queries, items, k, METRIC_LABELS, **options)


def rank_agreement(hits: DataFrame, baseline: str = "cosine", item_id: str = "chunk_id") -> DataFrame:
    """Per metric: queries whose ordered hits equal the baseline's, of all queries, as `a/n`."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", item_id))), lambda h: h[item_id])
    lists = hits.groupBy("query_id", "metric").agg(ids.alias("ids"))
    base = F.max(F.when(F.col("metric") == baseline, F.col("ids")))
    by_query = lists.groupBy("query_id").agg(base.alias("base"), F.collect_list(F.struct("metric", "ids")).alias("all"))
    rows = by_query.select("base", F.inline("all"))
    counted = rows.groupBy("metric").agg(F.count_if(F.col("ids") == F.col("base")).alias("a"), F.count("*").alias("n"))
    return counted.where(F.col("metric") != baseline).select(
        "metric", F.concat_ws("/", F.col("a").cast("string"), F.col("n").cast("string")).alias("agreement")
    )


def tenant_topk(queries: DataFrame, items: DataFrame, k: int = 3, metric: str = "cosine", **layout) -> DataFrame:
    """Top-k among the items of the query's own tenants (`tenants` array); no other row is ever scored."""
    probes = queries.select("query_id", "embedding", F.explode(F.array_distinct("tenants")).alias("tenant_id"))
    return search(probes, keyed_items(items, probes, "tenant_id"), k, metric, key="tenant_id", **layout)


def expand_queries(queries: DataFrame, variants: DataFrame, n: int = 4) -> DataFrame:
    """The original as variant 0 and the first n-1 reformulations of each query."""
    original = queries.select("query_id", F.lit(0).alias("variant"), "text")
    kept = best_per(variants, ["query_id"], [F.asc("ord")], n - 1, "variant")
    known = kept.join(queries.select("query_id"), "query_id", "left_semi")
    return original.unionByName(known.select("query_id", "variant", "text"))


def fuse_rrf(hits: DataFrame, k: int = 3) -> DataFrame:
    """Reciprocal rank fusion of the variants' lists: each item once, best `k` per query."""
    fused = hits.groupBy("query_id", "chunk_id").agg(
        F.round(F.sum(1.0 / (RRF_OFFSET + F.col("rank"))), vectors.SCORE_DIGITS).alias("score")
    )
    return ranked(fused, k, ["query_id"])


def expanded_topk(
    queries: DataFrame, variants: DataFrame, items: DataFrame, k: int = 3, n: int = 4, embedder: Embedder | None = None
) -> DataFrame:
    """Search every variant on its own, then fuse."""
    asked = embed(expand_queries(queries, variants, n), embedder=embedder)
    return fuse_rrf(search(asked, items, k, group=["query_id", "variant"]), k)


def recursive_topk(
    queries: DataFrame, summaries: DataFrame, chunks: DataFrame, k_doc: int = 2, k_chunk: int = 3, **layout
) -> DataFrame:
    """Nearest document summaries first, then the nearest chunks inside each chosen document."""
    level1 = search(queries, summaries, k_doc, item_id="doc_id", **layout)
    chosen = checkpointed(level1.select("query_id", "doc_id"))
    probes = chosen.join(queries.select("query_id", "embedding"), "query_id")
    inside = keyed_items(chunks, chosen, "doc_id")
    return search(probes, inside, k_chunk, group=["query_id", "doc_id"], key="doc_id", **layout)


def summary_index(docs: DataFrame, chars: int = 300, embedder: Embedder | None = None) -> DataFrame:
    return embed(doc_summary(docs, chars), embedder=embedder)


def nearest_routes(queries: DataFrame, descriptions: DataFrame, m: int = 2, embedder: Embedder | None = None) -> DataFrame:
    """Offline routing: each sub-question goes to the `m` indexes whose descriptions are nearest."""
    asked = embed(queries, embedder=embedder)
    names = embed(descriptions, embedder=embedder)
    found = search(asked, names, m, group=["query_id", "sub_id"], item_id="index_name")
    return found.select("query_id", "sub_id", "index_name").join(queries, ["query_id", "sub_id"])


def fan_out(routes: DataFrame, corpus: DataFrame, k: int = 3, embedder: Embedder | None = None, **layout) -> DataFrame:
    """Search every (sub-question, index) route on its own index; hits carry the index name."""
    asked = embed(routes, embedder=embedder)
    return search(asked, corpus, k, group=["query_id", "sub_id", "index_name"], key="index_name", **layout)


def retrieve(queries: DataFrame, items: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], k: int = 10) -> DataFrame:
    """Top-k, texts attached, then the post-processing steps from left to right."""
    from ravelin.operators.postprocess import apply_chain

    return apply_chain(with_text(topk(queries, items, k), items), steps)
