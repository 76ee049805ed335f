"""Vector plans: exact search, normalization, quantization, stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ravelin.functions import vectors as vx
from ravelin.operators import approximate, lists, quantization, retrieval, transforms
from ravelin.plans import inputs, plan
from ravelin.plans.sql import SCALED, VECTORS, exact
from ravelin.sources import vector_table

K = 10
METRIC_SQL = {
    "cosine": "case when q.n * i.n > 0 then list_dot_product(q.e, i.e) / (q.n * i.n) else 0 end",
    "dot_product": "list_dot_product(q.e, i.e)",
    "euclidean": "-list_distance(q.e, i.e)",
}


def best_pairs(table: str, score: str, k: int) -> str:
    return f"""select query_id, chunk_id, score, row_number() over (partition by query_id order by score desc, chunk_id) as rank
  from (select q.k as query_id, i.k as chunk_id, round({score}, 10) as score from {table} q join {table} i on q.k <> i.k)
  qualify row_number() over (partition by query_id order by score desc, chunk_id) <= {k}"""


SHOWN = "select query_id, chunk_id, round(score, 6) as score, rank from"


def shown(hits):
    return hits.select("query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def register_metric(name: str, metric: str, table: str) -> None:
    @plan(name, f"with {VECTORS}, {SCALED} {SHOWN} ({best_pairs(table, METRIC_SQL[metric], K)})")
    def run(spark, d):
        items = inputs.vectors(spark, d) if table == "v" else inputs.scaled_vectors(spark, d)
        return shown(retrieval.topk(inputs.as_queries(items), items, K, metric, exclude_self=True))


register_metric("topk_cosine", "cosine", "v")
register_metric("topk_dot_product", "dot_product", "sv")
register_metric("topk_euclidean", "euclidean", "sv")

ALL_METRICS = " union all ".join(f"select '{m}' as metric, * from ({best_pairs('sv', s, 3)})" for m, s in METRIC_SQL.items())


@plan("compare_metrics", f"with {VECTORS}, {SCALED} select metric, query_id, chunk_id, round(score, 6) as score, rank from ({ALL_METRICS})")
def compare_metrics(spark, d):
    items = inputs.scaled_vectors(spark, d)
    hits = retrieval.compare_metrics(inputs.as_queries(items), items, 3, exclude_self=True)
    return hits.select("metric", "query_id", "chunk_id", F.round("score", 6).alias("score"), "rank")


def agreement_sql(table: str, label: str) -> str:
    parts = " union all ".join(f"select '{m}' as metric, * from ({best_pairs(table, s, 3)})" for m, s in METRIC_SQL.items())
    return f"""select '{label}' as vectors, metric, count_if(ids = base) || '/' || count(*) as agreement from (
  select l.metric, l.ids, b.ids as base from (select metric, query_id, list(chunk_id order by rank) as ids from ({parts}) group by all) l
  join (select query_id, list(chunk_id order by rank) as ids from ({best_pairs(table, METRIC_SQL['cosine'], 3)}) group by all) b using (query_id))
  where metric <> 'cosine' group by metric"""


@plan("rank_agreement", f"with {VECTORS}, {SCALED} {agreement_sql('sv', 'raw')} union all {agreement_sql('v', 'l2_normalized')}")
def rank_agreement(spark, d):
    raw = inputs.scaled_vectors(spark, d)
    out = None
    for label, items in (("raw", raw), ("l2_normalized", transforms.l2_normalize(raw))):
        hits = retrieval.compare_metrics(inputs.as_queries(items), items, 3, exclude_self=True)
        rows = retrieval.rank_agreement(hits).select(F.lit(label).alias("vectors"), "metric", "agreement")
        out = rows if out is None else out.unionByName(rows)
    return out


@plan(
    "l2_normalize",
    f"with {VECTORS}, {SCALED} select k as chunk_id, pos, round(e[pos + 1] / n, 6) as x from (select *, unnest(range(64)) as pos from "
    "(select k, e, sqrt(list_dot_product(e, e)) as n from sv))",
)
def l2_normalize(spark, d):
    unit = transforms.l2_normalize(inputs.scaled_vectors(spark, d))
    return unit.select("chunk_id", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.round("x", 6))


@plan(
    "norm_report",
    f"with {VECTORS}, {SCALED} select 'raw' as label, round(min(n), 6) as norm_min, round(max(n), 6) as norm_max from sv "
    "union all select 'l2_normalized', 1.0, 1.0",
)
def norm_report(spark, d):
    report = transforms.norm_report(inputs.scaled_vectors(spark, d))
    return report.select("label", F.round("norm_min", 6).alias("norm_min"), F.round("norm_max", 6).alias("norm_max"))


BOUNDS = """parts as (select k, unnest(range(64)) as pos, unnest(e) as x from v),
bounds as (select quantile_cont(x, 0.005) as lo, quantile_cont(x, 0.995) as hi from parts),
codes as (select k, pos, (round((least(greatest(x, lo), hi) - lo) / (hi - lo) * 255) - 128)::int as code from parts, bounds),
sq as (select k, list(lo + (code + 128) / 255.0 * (hi - lo) order by pos) as e from codes, bounds group by k)"""
BITS = "bq as (select k, list_transform(e, lambda x: case when x > 0 then 1 else 0 end) as e from v)"
HAMMING = "-list_sum(list_transform(list_zip(q.e, i.e), lambda p: abs(p[1] - p[2])))::double"


@plan("scalar_quantize", f"with {VECTORS}, {BOUNDS} select k as chunk_id, pos, code from codes")
def scalar_quantize(spark, d):
    items = inputs.vectors(spark, d)
    coded = quantization.scalar_quantize(items, quantization.scalar_bounds(items))
    return coded.select("chunk_id", F.posexplode("code").alias("pos", "code")).withColumn("code", F.col("code").cast("int"))


@plan(
    "binary_quantize",
    f"with {VECTORS}, {BITS}, packed as (select k, list_sum(list_transform(range(64), lambda b: e[b + 1]::hugeint * (1::hugeint << b::int))) as w from bq) "
    "select k as chunk_id, (case when w >= 9223372036854775808 then w - 18446744073709551616 else w end)::bigint as word from packed",
)
def binary_quantize(spark, d):
    return quantization.binary_quantize(inputs.vectors(spark, d)).select("chunk_id", F.col("code")[0].alias("word"))


@plan("product_quantize")
def product_quantize(spark, d):
    items = inputs.vectors(spark, d)
    return quantization.Codes("product", items).table.select("chunk_id", F.posexplode("code").alias("subspace", "code"))


@plan(
    "compression_report",
    "with d as (select max(len(embedding)) as dim from embeddings) select 'none' as kind, dim * 4 as bytes, 1.0 as ratio from d "
    "union all select 'scalar', dim, 4.0 from d union all select 'binary', (dim / 8)::bigint, 32.0 from d union all select 'product', (dim / 4)::bigint, 16.0 from d",
)
def compression_report(spark, d):
    return quantization.compression_report(inputs.vectors(spark, d))


@plan("quantized_topk_scalar", f"with {VECTORS}, {BOUNDS} {SHOWN} ({best_pairs('sq', METRIC_SQL['dot_product'], K)})")
def quantized_topk_scalar(spark, d):
    items = inputs.vectors(spark, d)
    hits = quantization.Codes("scalar", items).topk(inputs.as_queries(items), K + 1)
    return shown(retrieval.ranked(hits.where("query_id <> chunk_id").drop("rank"), K, ["query_id"]))


@plan("quantized_topk_binary", f"with {VECTORS}, {BITS} {SHOWN} ({best_pairs('bq', HAMMING, K)})")
def quantized_topk_binary(spark, d):
    items = inputs.vectors(spark, d)
    hits = quantization.Codes("binary", items).topk(inputs.as_queries(items), K + 1)
    return shown(retrieval.ranked(hits.where("query_id <> chunk_id").drop("rank"), K, ["query_id"]))


@plan("quantized_topk_product")
def quantized_topk_product(spark, d):
    items = inputs.vectors(spark, d)
    return shown(quantization.Codes("product", items).topk(inputs.as_queries(items), K))


def rescored_sql(table: str, score: str) -> str:
    """The 30 best by codes, the query itself among the candidates, re-scored on the floats."""
    wide = f"""select q.k as query_id, i.k as chunk_id, round({score}, 10) as score from {table} q join {table} i on true
  qualify row_number() over (partition by q.k order by round({score}, 10) desc, i.k) <= 30"""
    return f"""{SHOWN} (select query_id, chunk_id, score, row_number() over (partition by query_id order by score desc, chunk_id) as rank
  from (select query_id, chunk_id, round(list_dot_product(q.e, i.e), 10) as score from ({wide}) w join v q on q.k = query_id join v i on i.k = chunk_id)
  qualify row_number() over (partition by query_id order by score desc, chunk_id) <= {K})"""


@plan("rescored_topk_scalar", f"with {VECTORS}, {BOUNDS} {rescored_sql('sq', METRIC_SQL['dot_product'])}")
def rescored_topk_scalar(spark, d):
    items = inputs.vectors(spark, d)
    return shown(quantization.quantized_topk(inputs.as_queries(items), items, quantization.Codes("scalar", items), K))


@plan("rescored_topk_binary", f"with {VECTORS}, {BITS} {rescored_sql('bq', HAMMING)}")
def rescored_topk_binary(spark, d):
    items = inputs.vectors(spark, d)
    return shown(quantization.quantized_topk(inputs.as_queries(items), items, quantization.Codes("binary", items), K))


@plan("rescored_topk_product")
def rescored_topk_product(spark, d):
    items = inputs.vectors(spark, d)
    return shown(quantization.quantized_topk(inputs.as_queries(items), items, quantization.Codes("product", items), K))


@plan("ann_topk")
def ann_topk(spark, d):
    items = inputs.vectors(spark, d)
    index = approximate.save_cells(approximate.build_cells(items, 16), inputs.scratch(spark, "cells"))
    return shown(approximate.ann_topk(inputs.as_queries(items), index, K, nprobe=4))


@plan(
    "ann_topk_all_cells",
    f"with {VECTORS} {SHOWN} ({best_pairs('v', METRIC_SQL['cosine'], K).replace('on q.k <> i.k', 'on true')})",
)
def ann_topk_all_cells(spark, d):
    """Below the size threshold the cell index answers like the exact search."""
    items = inputs.vectors(spark, d)
    index = approximate.build_cells(items, 16)
    return shown(approximate.ann_topk(inputs.as_queries(items), index, K, nprobe=16))


@plan("ann_topk_lists")
def ann_topk_lists(spark, d):
    """Many small lists, read as far as an item of theirs may be expected to beat the k-th score found."""
    items = inputs.vectors(spark, d)
    index = lists.save_lists(lists.build_lists(items), inputs.scratch(spark, "lists"))
    return shown(lists.lists_topk(inputs.as_queries(items), index, K))


@plan(
    "ann_lists_exact",
    f"with {VECTORS} {SHOWN} ({best_pairs('v', METRIC_SQL['cosine'], K).replace('on q.k <> i.k', 'on true')})",
)
def ann_lists_exact(spark, d):
    """The same lists, left out only where the triangle inequality rules their items out: equal to the exact search."""
    items = inputs.vectors(spark, d)
    return shown(lists.lists_topk(inputs.as_queries(items), lists.build_lists(items), K, reach=None))


TENANT_PAIRS = f"""select query_id, chunk_id, score, row_number() over (partition by query_id order by score desc, chunk_id) as rank
  from (select q.k as query_id, i.k as chunk_id, round({METRIC_SQL['cosine']}, 10) as score
    from v q join v i on i.label = q.k % 10 or i.label = q.k % 7)
  qualify row_number() over (partition by query_id order by score desc, chunk_id) <= {K}"""


@plan("ann_topk_tenants", f"with {VECTORS} {SHOWN} ({TENANT_PAIRS})")
def ann_topk_tenants(spark, d):
    """Each vector asks within two tenants, whose lists alone are read."""
    items = with_tenant(inputs.vectors(spark, d))
    index = approximate.build_cells(items, 16, by_tenant=True)
    tenant = lambda m: F.concat(F.lit("t"), (F.col("query_id") % m).cast("string"))
    queries = inputs.as_queries(items).withColumn("tenants", F.array(tenant(10), tenant(7)))
    return shown(approximate.ann_topk(queries, index, K, nprobe=16))


STORED = "select vec_id as chunk_id, 't' || label as tenant_id, " + exact("list_sum(embedding::double[])", 6) + " as total from embeddings"


def stored_rows(df):
    return df.select("chunk_id", "tenant_id", F.round(vx.total(vx.as_double(F.col("embedding"))), 6).alias("total"))


def with_tenant(items):
    return items.select("chunk_id", "embedding", F.concat(F.lit("t"), F.col("label").cast("string")).alias("tenant_id"))


@plan("write_vectors", STORED)
def write_vectors(spark, d):
    rows = with_tenant(inputs.vectors(spark, d))
    return stored_rows(vector_table.write_vectors(rows, inputs.scratch(spark, "vectors"), 64, normalized=True, multitenant=True))


@plan("append_vectors", STORED)
def append_vectors(spark, d):
    """The table in three writes that overlap, some rows deleted and added again: each write stores its own rows only."""
    rows, path = with_tenant(inputs.vectors(spark, d)), inputs.scratch(spark, "vectors")
    off = rows.withColumn("embedding", F.transform("embedding", lambda x: -x))
    part = F.pmod("chunk_id", F.lit(3))
    vector_table.write_vectors(off.where(part != 2), path, 64, multitenant=True)
    vector_table.write_vectors(rows.where(part >= 1), path, 64, recreate=False)
    vector_table.delete_vectors(rows.where(part <= 1).select("chunk_id"), path)
    return stored_rows(vector_table.write_vectors(rows.where(part <= 1), path, 64, recreate=False))


@plan("open_or_build", STORED)
def open_or_build(spark, d):
    path = inputs.scratch(spark, "vectors")
    build = lambda: with_tenant(inputs.vectors(spark, d))
    vector_table.open_or_build(spark, path, build, 64, multitenant=True)
    return stored_rows(vector_table.open_or_build(spark, path, build, 64, multitenant=True))


@plan("reconcile", "select count(*) as produced, count(*) as stored, 0 as missing, 0 as unexpected from embeddings")
def reconcile(spark, d):
    rows = with_tenant(inputs.vectors(spark, d))
    stored = vector_table.write_vectors(rows, inputs.scratch(spark, "vectors"), 64)
    return transforms.reconcile(rows, stored, "chunk_id")


@plan(
    "point_counts",
    "select 't' || label as tenant_id, count(*) as n from embeddings group by all union all select null, count(*) from embeddings",
)
def point_counts(spark, d):
    from ravelin.operators.sync import point_counts as counts

    return counts(with_tenant(inputs.vectors(spark, d)))
