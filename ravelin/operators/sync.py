"""Keep a vector table in step with its source: snapshot diffs and change events, in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ravelin.functions.embedders import Embedder, embed
from ravelin.operators.retrieval import tenant_topk
from ravelin.operators.transforms import row_to_document, sentence_chunks, with_text
from ravelin.session import broadcast_if_small, checkpointed
from ravelin.sources import vector_table

# The source row and the change envelope.
ROW_DDL = "id bigint, tenant_id string, title string, body string, updated_at timestamp"
EVENT_DDL = f"op string, before struct<{ROW_DDL.replace(' ', ':').replace(',:', ',')}>, after struct<{ROW_DDL.replace(' ', ':').replace(',:', ',')}>"
OP_LABELS = {"c": "INSERT", "r": "SNAPSHOT", "u": "UPDATE", "d": "DELETE"}
ROW_FIELDS = ("id", "tenant_id", "title", "body", "updated_at")


def with_content_hash(docs: DataFrame) -> DataFrame:
    """Hash over text and tenant; a unit separator keeps the two apart."""
    parts = F.concat(F.coalesce("text", F.lit("")), F.lit("\x1f"), F.coalesce("tenant_id", F.lit("")))
    return docs.withColumn("content_hash", F.sha2(parts, 256))


def diff_snapshot(current: DataFrame, state: DataFrame) -> DataFrame:
    """(doc_id, status): new, changed, unchanged or deleted; both inputs hold (doc_id, content_hash)."""
    a = current.select("doc_id", F.col("content_hash").alias("_now"))
    b = state.select("doc_id", F.col("content_hash").alias("_was"))
    status = (
        F.when(F.col("_was").isNull(), "new")
        .when(F.col("_now").isNull(), "deleted")
        .when(F.col("_now") == F.col("_was"), "unchanged")
        .otherwise("changed")
    )
    return a.join(b, "doc_id", "full_outer").select("doc_id", status.alias("status"))


def sync_report(diff: DataFrame) -> DataFrame:
    """One row per new, changed or deleted id and one counting row for the unchanged (its `doc_id` is null).

    Ids stay rows, in any number, rather than lists inside one row.
    """
    counts = diff.groupBy("status").agg(F.count("*").alias("n"))
    moved = diff.where(F.col("status") != "unchanged")
    ids = moved.join(F.broadcast(counts), "status").select("status", "n", "doc_id")  # at most four statuses
    same = counts.where(F.col("status") == "unchanged").select("status", "n", F.lit(None).cast("string").alias("doc_id"))
    return ids.unionByName(same).orderBy("status", "doc_id")


def apply_sync(
    stored: DataFrame,
    docs: DataFrame,
    diff: DataFrame,
    *,
    size: int = 512,
    overlap: int = 50,
    embedder: Embedder | None = None,
    chunker: Callable[[DataFrame, int, int], DataFrame] = sentence_chunks,
) -> DataFrame:
    """The vector table after the change: only new and changed documents are chunked and embedded."""
    diff = checkpointed(diff)
    fresh_ids = diff.where(F.col("status").isin("new", "changed")).select("doc_id")
    # New ids are dropped too, so a run repeated after a crash between two writes cannot store a document twice.
    stale_ids = diff.where(F.col("status") != "unchanged").select("doc_id")
    kept = stored.join(broadcast_if_small(stale_ids), "doc_id", "left_anti")
    delta = docs.select("doc_id", "tenant_id", "text").join(broadcast_if_small(fresh_ids), "doc_id", "left_semi")
    added = embed(chunker(delta, size, overlap), embedder=embedder)
    columns = ["chunk_id", "doc_id", "tenant_id", "text", "embedding"]
    return kept.select(*columns).unionByName(added.select(*columns))


def sync_table(
    docs: DataFrame,
    path: str,
    dim: int,
    *,
    size: int = 512,
    overlap: int = 50,
    embedder: Embedder | None = None,
    chunker: Callable[[DataFrame, int, int], DataFrame] = sentence_chunks,
    multitenant: bool = False,
) -> DataFrame:
    """Bring the stored table at `path` in step with `docs` (doc_id, tenant_id, text) and return the diff.

    The state is the content hash kept with each stored chunk, read alone. Only new and changed documents are chunked,
    embedded and added, as one segment; chunks that go are marked by id. Without a change nothing is written. A document
    without chunks is stored nowhere, so it is listed as new each time.
    """
    spark = docs.sparkSession
    current = with_content_hash(docs.select("doc_id", "tenant_id", "text"))
    exists = vector_table.read_meta(spark, path) is not None
    table = vector_table.read_vectors(spark, path) if exists else None
    state = (table if exists else current.limit(0)).select("doc_id", "content_hash").distinct()
    diff = checkpointed(diff_snapshot(current, state))
    moved = diff.where("status != 'unchanged'")
    if moved.isEmpty() and exists:
        return diff
    fresh = current.join(broadcast_if_small(moved.where("status != 'deleted'").select("doc_id")), "doc_id", "left_semi")
    chunks = embed(chunker(fresh, size, overlap), embedder=embedder)
    if "content_hash" not in chunks.columns:  # the hash travels with the chunks unless the chunker drops it
        chunks = chunks.join(fresh.select("doc_id", "content_hash"), "doc_id")
    added = chunks.select("chunk_id", "doc_id", "tenant_id", "text", "embedding", "content_hash")
    if not exists:
        vector_table.write_vectors(added, path, dim, multitenant=multitenant)
        return diff
    stale = checkpointed(table.join(broadcast_if_small(moved.select("doc_id")), "doc_id", "left_semi").select("chunk_id"))
    if not stale.isEmpty():
        vector_table.delete_vectors(stale, path)
    if not fresh.where(F.trim("text") != "").isEmpty():
        vector_table.write_vectors(added, path, dim, recreate=False)
    return diff


def _null_row() -> Column:
    return F.lit(None).cast("struct<" + ROW_DDL.replace(", ", ",").replace(" ", ":") + ">")


def snapshot_to_events(table: DataFrame) -> DataFrame:
    """The whole source table as snapshot events, in the envelope of the change feed (`value` JSON)."""
    row = F.struct(*[F.col(c) if c in table.columns else F.lit(None).alias(c) for c in ROW_FIELDS])
    return table.select(F.to_json(F.struct(F.lit("r").alias("op"), _null_row().alias("before"), row.alias("after"))).alias("value"))


def jdbc_snapshot(spark, url: str, table: str, *, partition_column: str = "id", lower: int, upper: int, partitions: int, **options) -> DataFrame:
    """Read the source table in ranges of its key, one connection per partition."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=options)


def parsed_or_rejected(raw: DataFrame) -> DataFrame:
    """`raw` with op, before and after of each envelope in `value`, and `rejected`: why it is no event (else null).

    Tombstones (null values) are skipped. An event needs an op and the id of its row: before's for a delete, else after's.
    """
    parsed = raw.where(F.col("value").isNotNull()).withColumn("_e", F.from_json(F.col("value").cast("string"), EVENT_DDL))
    parsed = parsed.select(*raw.columns, "_e.op", "_e.before", "_e.after")
    reason = F.when(F.col("op").isNull(), "no change envelope").when(event_id().isNull(), "no row id")
    return parsed.withColumn("rejected", reason)


def parse_events(raw: DataFrame) -> DataFrame:
    """Change events from `value` (JSON text or bytes). Other columns stay; `rejected_events` has what is no event."""
    return parsed_or_rejected(raw).where("rejected is null").drop("value", "rejected")


def rejected_events(raw: DataFrame) -> DataFrame:
    """The rows of `raw` whose value is there but no change event, with the reason in `rejected`."""
    return parsed_or_rejected(raw).where("rejected is not null").drop("op", "before", "after")


def event_id(op: str = "op") -> Column:
    return F.when(F.col(op) == "d", F.col("before.id")).otherwise(F.col("after.id"))


def latest_events(events: DataFrame) -> DataFrame:
    """The last event of each row id by `seq`; a partial maximum per task precedes the shuffle."""
    keyed = events.select(event_id().alias("id"), "op", "after", "seq")
    return keyed.groupBy("id").agg(F.max_by(F.struct("op", "after", "seq"), "seq").alias("_l")).select("id", "_l.*")


def fold_events(events: DataFrame) -> DataFrame:
    """The state of the source after all events: deletes remove, any other op replaces, the later event wins."""
    return latest_events(events).where(F.col("op") != "d").select("after.*")


def change_log(events: DataFrame) -> DataFrame:
    """One readable line per event."""
    label = F.coalesce(F.create_map(*[F.lit(x) for pair in OP_LABELS.items() for x in pair])[F.col("op")], F.col("op"))
    padded = F.when(F.length(label) < 8, F.rpad(label, 8, " ")).otherwise(label)
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    # A deleted row may arrive without its tenant (only the key is logged); it then reads None, as absent values do.
    tenant = F.coalesce(row["tenant_id"], F.lit("None"))
    line = F.concat(
        padded,
        F.lit(" doc "),
        row["id"].cast("string"),
        F.lit(" ("),
        tenant,
        F.lit(")"),
        F.when(F.col("op") == "d", F.lit("")).otherwise(F.concat(F.lit(": "), F.coalesce(row["title"], F.lit("None")))),
    )
    return events.select("seq", line.alias("line"))


def point_counts(stored: DataFrame) -> DataFrame:
    """Stored vectors in all (`tenant_id` null) and per tenant."""
    return stored.rollup("tenant_id").agg(F.count("*").alias("n"))


def retrieve_after_change(queries: DataFrame, events: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Tenant-scoped best document on the folded state; a question without one keeps a row of nulls."""
    docs = row_to_document(fold_events(events))
    index = embed(docs.withColumnRenamed("doc_id", "chunk_id"), embedder=embedder)
    hits = tenant_topk(embed(queries, embedder=embedder), index, 1)
    best = with_text(hits, docs.select(F.col("doc_id").alias("chunk_id"), "text"))
    return queries.select("query_id").join(best.select("query_id", "chunk_id", "score", "text"), "query_id", "left")
