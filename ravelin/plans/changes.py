"""Tenancy, snapshot sync and change feed plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ravelin.functions.embedders import embed
from ravelin.operators import sync, tenancy, transforms
from ravelin.plans import inputs, plan
from ravelin.plans.sql import DOCS, embedded, events_sql, nearest, windows
from ravelin.sources import vector_table
from ravelin.sources.tables import read_table
from ravelin.streaming import feed

ISSUER, AUDIENCE, NOW = "https://id.example/realms/retrieval", "retrieval-api", 1_700_000_000

CLAIM_CASE = """case when c_acctbal < -500 then 'wrong issuer' when c_acctbal < 0 then 'wrong audience'
  when c_acctbal < 1000 then 'expired' when c_mktsegment = 'BUILDING' then 'belongs to no tenant' end"""


@plan(
    "claims_to_scope",
    f"""select c_custkey, case when c_mktsegment = 'MACHINERY' then '?' else c_name end as username,
  case when {CLAIM_CASE} is null then 'src' || c_nationkey || ',' || lower(c_mktsegment) end as tenants, {CLAIM_CASE} as rejected from customer""",
)
def claims_to_scope(spark, d):
    balance = F.col("c_acctbal")
    claims = F.to_json(
        F.struct(
            F.when(balance < -500, "https://elsewhere.example").otherwise(ISSUER).alias("iss"),
            F.when((balance >= -500) & (balance < 0), "another-api").otherwise(AUDIENCE).alias("aud"),
            F.when((balance >= 0) & (balance < 1000), F.lit(NOW)).otherwise(F.lit(NOW + 60)).alias("exp"),
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("preferred_username"),
            F.when(
                F.col("c_mktsegment") != "BUILDING",
                F.array(F.concat(F.lit("src"), F.col("c_nationkey").cast("string")), F.lower("c_mktsegment")),
            ).alias("groups"),
        )
    )
    rows = read_table(spark, d, "customer").select("c_custkey", claims.alias("claims"))
    scopes = tenancy.claims_to_scope(rows, ISSUER, AUDIENCE, F.lit(NOW))
    return scopes.select("c_custkey", "username", F.array_join("tenants", ",").alias("tenants"), "rejected")


HASHED = "sha256(text || chr(31) || tenant_id)"


@plan("content_hash", f"with {DOCS} select doc_id, {HASHED} as content_hash from docs")
def content_hash(spark, d):
    return sync.with_content_hash(inputs.documents(spark, d)).select("doc_id", "content_hash")


def earlier(spark, d):
    """An earlier state: the labelled documents, other text where the label says low quality, and passages since removed."""
    labels = read_table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("doc_id"), "quality")
    docs = inputs.documents(spark, d).join(labels, "doc_id")
    text = F.when(F.col("quality") == 1, F.col("text")).otherwise(F.concat(F.col("text"), F.lit(" (draft)")))
    gone = read_table(spark, d, "benchmark").select(
        F.concat(F.lit("b-"), F.col("item_id").cast("string")).alias("doc_id"), "text", F.lit("src0").alias("tenant_id")
    )
    return docs.select("doc_id", text.alias("text"), "tenant_id").unionByName(gone)


EARLIER = f"""{DOCS},
was as (select doc_id, case when quality = 1 then text else text || ' (draft)' end as text, tenant_id
  from docs join (select doc_id::varchar as doc_id, quality from labels) using (doc_id)
  union all select 'b-' || item_id, text, 'src0' from benchmark),
diff as (select doc_id, case when w.h is null then 'new' when c.h is null then 'deleted' when w.h = c.h then 'unchanged' else 'changed' end as status
  from (select doc_id, {HASHED} as h from docs) c full join (select doc_id, {HASHED} as h from was) w using (doc_id))"""


def difference(spark, d):
    current = sync.with_content_hash(inputs.documents(spark, d))
    return sync.diff_snapshot(current, sync.with_content_hash(earlier(spark, d)))


@plan("diff_snapshot", f"with {EARLIER} select doc_id, status from diff")
def diff_snapshot(spark, d):
    return difference(spark, d)


@plan(
    "sync_report",
    f"""with {EARLIER}, n as (select status, count(*) as n from diff group by status)
select status, n, doc_id from diff join n using (status) where status <> 'unchanged' union all select status, n, null from n where status = 'unchanged'""",
)
def sync_report(spark, d):
    return sync.sync_report(difference(spark, d))


def vector_digest(df):
    """A number that changes with any component of the vector."""
    weighted = F.transform(F.col("embedding").cast("array<double>"), lambda x, i: x * (i + 1))
    return df.withColumn("digest", F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), 4))


@plan(
    "apply_sync",
    f"""with {EARLIER}, all_docs as (select doc_id, text, tenant_id from docs),
{windows('c', 'all_docs', 512, 50)}, {embedded('ci', 'c', 'chunk_id', 'text')}
select k as chunk_id, round(list_sum(list_transform(range(64), lambda b: e[b + 1] * (b + 1))), 4) as digest from ci""",
)
def apply_sync(spark, d):
    """Bringing the earlier state up to date must give the table built from the current documents."""
    was = earlier(spark, d)
    stored = embed(transforms.word_windows(was, 512, 50))
    after = sync.apply_sync(stored, inputs.documents(spark, d), difference(spark, d), chunker=transforms.word_windows)
    return vector_digest(after).select("chunk_id", "digest")


@plan("snapshot_to_events", f"with {events_sql()} select 'r' as op, null::bigint as before_id, id, tenant_id, title, body from live")
def snapshot_to_events(spark, d):
    """The folded table as snapshot events, read back through the envelope parser."""
    table = sync.fold_events(sync.parse_events(inputs.row_events(spark, d)))
    events = sync.parse_events(sync.snapshot_to_events(table))
    return events.select("op", F.col("before.id").alias("before_id"), "after.id", "after.tenant_id", "after.title", "after.body")


@plan("row_to_document", f"with {events_sql()} select 'pg-' || id as doc_id, title || chr(10) || chr(10) || body as text, tenant_id, title, 'postgres' as source from live")
def row_to_document(spark, d):
    return transforms.row_to_document(sync.fold_events(sync.parse_events(inputs.row_events(spark, d))))


@plan(
    "parse_events",
    f"""with {events_sql()} select seq, op, case when op = 'd' then id end as before_id, case when op <> 'd' then id end as after_id,
  case when op <> 'd' then tenant_id end as tenant_id, case when op <> 'd' then body end as body from ev""",
)
def parse_events(spark, d):
    raw = inputs.row_events(spark, d)
    tombstones = raw.where(F.col("value").contains('"op":"d"')).select(F.lit(None).cast("string").alias("value"), "seq")
    events = sync.parse_events(raw.unionByName(tombstones))
    return events.select("seq", "op", F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"), "after.tenant_id", "after.body")


LIVE = f"with {events_sql()} select id, tenant_id, title, body from live"


@plan("fold_events", LIVE)
def fold_events(spark, d):
    return sync.fold_events(sync.parse_events(inputs.row_events(spark, d))).select("id", "tenant_id", "title", "body")


@plan(
    "change_log",
    f"""with {events_sql()} select seq, rpad(case op when 'c' then 'INSERT' when 'r' then 'SNAPSHOT' when 'u' then 'UPDATE' else 'DELETE' end, 8, ' ')
  || ' doc ' || id || ' (' || tenant_id || ')' || case when op = 'd' then '' else ': ' || title end as line from ev""",
)
def change_log(spark, d):
    return sync.change_log(sync.parse_events(inputs.row_events(spark, d)))


@plan("rejected_events", "select 'not json ' || event_id as value, event_id as seq, 'no change envelope' as rejected from events union all select '{\"op\":\"c\",\"after\":{\"title\":\"' || event_type || '\"}}', event_id, 'no row id' from events")
def rejected_events(spark, d):
    """Every event once more as text that is no envelope, and as a row without an id."""
    events = read_table(spark, d, "events").withColumnRenamed("event_id", "seq")
    broken = F.concat(F.lit("not json "), F.col("seq").cast("string"))
    nobody = F.concat(F.lit('{"op":"c","after":{"title":"'), F.col("event_type"), F.lit('"}}'))
    raw = inputs.row_events(spark, d)
    for value in (broken, nobody):
        raw = raw.unionByName(events.select(value.alias("value"), "seq"))
    return sync.rejected_events(raw)


@plan(
    "sync_table",
    f"with {DOCS} select doc_id, {HASHED} as content_hash from docs where text <> ''",
)
def sync_table(spark, d):
    """An earlier state stored, then brought in step with the documents; what the table holds then."""
    path, now = inputs.scratch(spark, "synced"), inputs.documents(spark, d).where("text != ''").select("doc_id", "tenant_id", "text")
    at = F.pmod(F.col("doc_id").try_cast("long"), F.lit(5))  # filters on it reach the ids of the table too
    before = now.where(at != 0).withColumn("text", F.when(at == 1, F.concat("text", F.lit(" (draft)"))).otherwise(F.col("text")))
    gone = now.where(at == 2).withColumn("doc_id", F.concat(F.lit("old-"), "doc_id"))
    sync.sync_table(before.unionByName(gone), path, 64)
    sync.sync_table(now, path, 64)
    return vector_table.read_vectors(spark, path).select("doc_id", "content_hash").distinct()


@plan("stream_apply", f"with {events_sql()} select 'pg-' || id as doc_id, tenant_id, title || chr(10) || chr(10) || body as text from live")
def stream_apply(spark, d):
    """The feed written as files, drained in micro-batches, and the state read from the log."""
    source, log, progress = (inputs.scratch(spark, n) for n in ("feed", "log", "progress"))
    inputs.row_events(spark, d).repartitionByRange(6, "seq").write.parquet(source)
    feed.stream_apply(feed.file_source(spark, source, 2), log, progress).awaitTermination()
    return feed.current_state(feed.read_log(spark, log)).select("doc_id", "tenant_id", "text")


@plan(
    "retrieve_after_change",
    f"""with {events_sql()}, pg as (select 'pg-' || id as chunk_id, title || chr(10) || chr(10) || body as text, tenant_id from live),
qs as (select distinct event_type || ' ' || props as query_id from events),
{embedded('qi', 'qs', 'query_id', 'query_id')}, {embedded('pi', 'pg', 'chunk_id', 'text', 'text, tenant_id')},
{nearest('h', 'qi', 'pi', 1, "i.tenant_id in ('t0', 't1')")}
select query_id, chunk_id, round(score, 6) as score, text from qs left join h using (query_id) left join pg using (chunk_id)""",
)
def retrieve_after_change(spark, d):
    """Every distinct event line asked of the folded table within two tenants."""
    asked = read_table(spark, d, "events").select(F.concat_ws(" ", "event_type", "props").alias("query_id")).distinct()
    queries = asked.select("query_id", F.col("query_id").alias("text"), F.array(F.lit("t0"), F.lit("t1")).alias("tenants"))
    found = sync.retrieve_after_change(queries, sync.parse_events(inputs.row_events(spark, d)))
    return found.select("query_id", "chunk_id", F.round("score", 6).alias("score"), "text")
