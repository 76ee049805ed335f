"""Retrieval plans over text: tenants, expansion and fusion, recursion, reranking, chains, fan-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ravelin.functions.embedders import embed
from ravelin.operators import postprocess, retrieval, terms, transforms
from ravelin.plans import inputs, plan
from ravelin.plans.sql import (
    ASKED,
    DOC_INDEX,
    QUESTIONS,
    SENTENCE_ROWS,
    bm25,
    embedded,
    nearest,
    tokens,
    windows,
)
from ravelin.sources.tables import read_table, spread

CUTOFF = 0.8
TAKE = "select query_id, chunk_id, round(score, 6) as score, rank from"
POOL = f"with {DOC_INDEX}, {ASKED}, {nearest('pool', 'qi', 'di', 10)}"
POOL_TEXT = f"{POOL}, hits as (select p.*, text from pool p join docs on doc_id = chunk_id)"


def hits_of(df, *extra):
    return df.select("query_id", "chunk_id", F.round("score", 6).alias("score"), *extra)


def asked(spark, d):
    return embed(inputs.questions(spark, d))


def pool_of(spark, d, k=10):
    """The k nearest documents of every question, with their texts."""
    return transforms.with_text(retrieval.topk(asked(spark, d), inputs.document_index(spark, d), k), inputs.document_index(spark, d))


def corpus_of(spark, d):
    return inputs.documents(spark, d).select(F.col("doc_id").alias("chunk_id"), "text")


@plan("topk_text", f"{POOL} {TAKE} pool")
def topk_text(spark, d):
    return hits_of(retrieval.topk(asked(spark, d), inputs.document_index(spark, d), 10), "rank")


SCOPES = "list_contains(['src' || (q.conv_id % 20), 'src' || (q.conv_id % 7)], i.tenant_id)"


@plan("tenant_topk", f"with {DOC_INDEX}, {ASKED}, {nearest('h', 'qi', 'di', 3, SCOPES)} {TAKE} h")
def tenant_topk(spark, d):
    tenant = lambda m: F.concat(F.lit("src"), (F.col("conv_id") % m).cast("string"))
    queries = asked(spark, d).withColumn("tenants", F.array(tenant(20), tenant(7)))
    return hits_of(retrieval.tenant_topk(queries, inputs.document_index(spark, d), 3), "rank")


VARIANTS = """turns as (select conv_id::varchar as conv, turn, text from conversations),
originals as (select conv as query_id, text from turns where turn = 0),
expanded as (select query_id, 0 as variant, text from originals union all
  select conv, row_number() over (partition by conv order by turn), text from turns where turn > 0
  qualify row_number() over (partition by conv order by turn) <= 3)"""


def conversation_queries(spark, d):
    """Opening turns as questions, the later turns of each conversation as their reformulations."""
    turns = read_table(spark, d, "conversations").withColumn("query_id", F.col("conv_id").cast("string"))
    return turns.where("turn = 0").select("query_id", "text"), turns.where("turn > 0").select("query_id", F.col("turn").alias("ord"), "text")


@plan("expand_queries", f"with {VARIANTS} select query_id, variant, md5(text) as digest from expanded")
def expand_queries(spark, d):
    rows = retrieval.expand_queries(*conversation_queries(spark, d), 4)
    return rows.select("query_id", "variant", F.md5(F.col("text").cast("binary")).alias("digest"))


def fused(name: str, hits: str, k: int) -> str:
    return f"""{name}_f as (select query_id, chunk_id, round(sum(1.0 / (60 + rank)), 10) as score from {hits} group by all),
{name} as (select *, row_number() over (partition by query_id order by score desc, chunk_id) as rank from {name}_f
  qualify row_number() over (partition by query_id order by score desc, chunk_id) <= {k})"""


EXPANDED = f"""{VARIANTS}, keyed as (select query_id || '/' || variant as vk, * from expanded), {embedded('qi', 'keyed', 'vk', 'text', 'query_id, variant')}"""


@plan(
    "fuse_rrf",
    f"with {DOC_INDEX}, {EXPANDED}, {nearest('h', 'qi', 'di', 10, group='q.query_id, q.variant', part='query_id, variant')}, {fused('r', 'h', 10)} {TAKE} r",
)
def fuse_rrf(spark, d):
    queries, variants = conversation_queries(spark, d)
    return hits_of(retrieval.expanded_topk(queries, variants, inputs.document_index(spark, d), 10), "rank")


@plan(
    "recursive_topk",
    f"""with {DOC_INDEX}, {ASKED}, summaries as (select doc_id, replace(substr(text, 1, 300), chr(10), ' ') as text from docs),
{embedded('si', 'summaries', 'doc_id', 'text')}, {nearest('l1', 'qi', 'si', 2, item='doc_id')},
{windows('c', 'docs', 256, 20)}, {embedded('ci', 'c', 'chunk_id', 'text', 'doc_id')},
l2s as (select l1.query_id, l1.doc_id, i.k as chunk_id, round(case when q.n * i.n > 0 then list_dot_product(q.e, i.e) / (q.n * i.n) else 0 end, 10) as score
  from l1 join qi q on q.k = query_id join ci i on i.doc_id = l1.doc_id),
l2 as (select *, row_number() over (partition by query_id, doc_id order by score desc, chunk_id) as rank from l2s)
select query_id, doc_id, chunk_id, round(score, 6) as score, rank from l2 where rank <= 3""",
)
def recursive_topk(spark, d):
    docs = inputs.documents(spark, d).select("doc_id", "text")
    chunks = inputs.chunk_index(spark, d, 256, 20)
    return hits_of(retrieval.recursive_topk(asked(spark, d), retrieval.summary_index(docs), chunks, 2, 3), "doc_id", "rank")


@plan("rerank_bm25", f"{POOL_TEXT}, {bm25('r', 'hits', 'questions', '(select doc_id as chunk_id, text from docs)', 3)} {TAKE} r")
def rerank_bm25(spark, d):
    return hits_of(postprocess.bm25_rerank(pool_of(spark, d), inputs.questions(spark, d), corpus_of(spark, d), 3), "rank")


@plan("rerank_bm25_append", f"{POOL_TEXT}, {bm25('r', 'hits', 'questions', '(select doc_id as chunk_id, text from docs)', 3)} {TAKE} r")
def rerank_bm25_append(spark, d):
    """The same over an index stored in two parts: the documents of one language, then all others added to them."""
    path, corpus = inputs.scratch(spark, "terms"), inputs.documents(spark, d).select(F.col("doc_id").alias("chunk_id"), "text", "modality")
    terms.add_terms(corpus.where("modality = 'en'"), path)
    index = terms.add_terms(corpus.where("modality <> 'en' or modality is null"), path)
    return hits_of(postprocess.bm25_rerank(pool_of(spark, d), inputs.questions(spark, d), index, 3), "rank")


def shared_words(name: str, hits: str, questions: str, top_n: int) -> str:
    """CTE `name`: `hits`(query_id, chunk_id, text) ranked by the share of the question's words that they hold."""
    return f"""{name}_w as (select query_id, list_distinct({tokens('text')}) as ws from {questions}),
{name}_s as (select h.query_id, h.chunk_id, h.text, round(len(list_intersect(ws, list_distinct({tokens('h.text')}))) / greatest(len(ws), 1), 10) as score
  from {hits} h join {name}_w using (query_id)),
{name} as (select *, row_number() over (partition by query_id order by score desc, chunk_id) as rank from {name}_s
  qualify row_number() over (partition by query_id order by score desc, chunk_id) <= {top_n})"""


def word_share():
    """A stand-in pair model: the share of the question's words that the passage holds."""

    def shares(questions: list[str], passages: list[str]) -> list[float]:
        import regex

        words = lambda text: {w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}
        asked = [words(q) for q in questions]
        return [round(len(a & words(p)) / max(len(a), 1), 10) for a, p in zip(asked, passages)]

    return shares


@plan("rerank_model", f"{POOL_TEXT}, {shared_words('r', 'hits', 'questions', 3)} {TAKE} r")
def rerank_model(spark, d):
    return hits_of(postprocess.rerank(pool_of(spark, d), inputs.questions(spark, d), word_share(), 3), "rank")


@plan("similarity_cutoff", f"{POOL} {TAKE} pool where score >= {CUTOFF}")
def similarity_cutoff(spark, d):
    return hits_of(postprocess.similarity_cutoff(retrieval.topk(asked(spark, d), inputs.document_index(spark, d), 10), CUTOFF), "rank")


@plan(
    "best_score",
    f"{POOL} select query_id, coalesce(round(max(score), 6), 0) as score from questions left join (select * from pool where score >= {CUTOFF}) using (query_id) group by query_id",
)
def best_score(spark, d):
    """The best score above the cutoff of every user question."""
    hits = retrieval.topk(asked(spark, d), inputs.document_index(spark, d), 10)
    best = postprocess.best_score(postprocess.similarity_cutoff(hits, CUTOFF), inputs.questions(spark, d))
    return best.select("query_id", F.round("score", 6).alias("score"))


REORDERED = """select *, case when rank % 2 = 1 then (rank + 1) // 2 else n + 1 - rank // 2 end as pos
  from (select *, count(*) over (partition by query_id) as n from {0})"""


@plan("long_context_reorder", f"{POOL}, r as ({REORDERED.format('pool')}) select query_id, chunk_id, rank, pos from r")
def long_context_reorder(spark, d):
    hits = retrieval.topk(asked(spark, d), inputs.document_index(spark, d), 10)
    return postprocess.long_context_reorder(hits).select("query_id", "chunk_id", "rank", "pos")


SENTENCE_HITS = f"""{SENTENCE_ROWS}, {embedded('ni', 'sent', 'chunk_id', 'original_text', '"window"')}, {nearest('wh', 'qi', 'ni', 2)}"""


@plan(
    "window_replace",
    f"with {DOC_INDEX}, {ASKED}, {SENTENCE_HITS} select query_id, wh.chunk_id, rank, md5(\"window\") as digest from wh join sent using (chunk_id)",
)
def window_replace(spark, d):
    rows = inputs.sentences(spark, d)
    index = inputs.sentence_index(spark, d)
    hits = transforms.with_text(retrieval.topk(asked(spark, d), index, 2), index)
    swapped = postprocess.window_replace(hits, rows)
    return swapped.select("query_id", "chunk_id", "rank", F.md5(F.col("text").cast("binary")).alias("digest"))


CHAINED = f"""{POOL_TEXT}, cut as (select query_id, chunk_id, text from hits where score >= {CUTOFF}),
{bm25('r', 'cut', 'questions', '(select doc_id as chunk_id, text from docs)', 3)}, ro as ({REORDERED.format('r')})"""


@plan("apply_chain", f"{CHAINED} select query_id, chunk_id, round(score, 6) as score, pos from ro")
def apply_chain(spark, d):
    queries, corpus = inputs.questions(spark, d), corpus_of(spark, d)
    steps = [
        postprocess.as_cutoff(CUTOFF),
        postprocess.as_rerank(lambda h: postprocess.bm25_rerank(h, queries, corpus, 3)),
        postprocess.long_context_reorder,
    ]
    return hits_of(retrieval.retrieve(asked(spark, d), inputs.document_index(spark, d), steps, 10), "pos")


@plan(
    "compare_chains",
    f"""{CHAINED}, {SENTENCE_HITS},
five as (select 'k=10' as chain, query_id, rank as pos, chunk_id, score, text from hits
union all select 'cut={CUTOFF}', query_id, row_number() over (partition by query_id order by score desc, chunk_id), chunk_id, score, text from hits where score >= {CUTOFF}
union all select 'cut={CUTOFF} rescored k=3', query_id, rank, chunk_id, score, text from r
union all select 'cut={CUTOFF} rescored k=3 ends first', query_id, pos, chunk_id, score, text from ro
union all select 'sentence windows k=2', query_id, rank, wh.chunk_id, score, "window" from wh join sent using (chunk_id))
select chain, query_id, pos, chunk_id, round(score, 6) as score, md5(text) as digest from five""",
)
def compare_chains(spark, d):
    queries, corpus = inputs.questions(spark, d), corpus_of(spark, d)
    index = inputs.sentence_index(spark, d)
    window_hits = transforms.with_text(retrieval.topk(asked(spark, d), index, 2), index)
    rerank = lambda h: postprocess.bm25_rerank(h, queries, corpus, 3)
    rows = postprocess.compare_chains(pool_of(spark, d), window_hits, inputs.sentences(spark, d), rerank, CUTOFF, corpus)
    return hits_of(rows, "chain", "pos", F.md5(F.col("text").cast("binary")).alias("digest"))


@plan(
    "assemble_context",
    f"""with {DOC_INDEX}, {ASKED}, {nearest('h', 'qi', 'di', 3)}
select query_id, md5(string_agg(text, ' ' order by rank)) as digest from h join docs on doc_id = chunk_id group by query_id""",
)
def assemble_context(spark, d):
    contexts = transforms.assemble_context(pool_of(spark, d, 3))
    return contexts.select("query_id", F.md5(F.col("context").cast("binary")).alias("digest"))


CORPUS = r"""corpus as (select 'documents' as index_name, doc_id::varchar as id, text from documents union all
  select 'pages', 'p' || page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') from pages union all select 'benchmark', 'b' || item_id, text from benchmark),
routes as (select conv_id || '-' || turn || '/' || index_name as rk, conv_id as query_id, turn as sub_id, index_name, text from conversations
  join (values ('user', 'documents'), ('user', 'benchmark'), ('assistant', 'pages'), ('system', 'benchmark')) r(role, index_name) using (role))"""


def indexes(spark, d):
    docs = inputs.documents(spark, d).select(F.lit("documents").alias("index_name"), F.col("doc_id").alias("chunk_id"), "text")
    pages = spread(read_table(spark, d, "pages"), "page_id").select(
        F.lit("pages").alias("index_name"),
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("chunk_id"),
        F.regexp_replace("html", "<[^>]*>", " ").alias("text"),
    )
    facts = read_table(spark, d, "benchmark").select(
        F.lit("benchmark").alias("index_name"), F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("chunk_id"), "text"
    )
    return embed(docs.unionByName(pages).unionByName(facts))


@plan(
    "fan_out",
    f"""with {CORPUS}, {embedded('qi', 'routes', 'rk', 'text', 'query_id, sub_id, index_name')}, {embedded('ci', 'corpus', 'id', 'text', 'index_name')},
{nearest('h', 'qi', 'ci', 3, 'q.index_name = i.index_name', 'q.query_id, q.sub_id, q.index_name', 'query_id, sub_id, index_name')}
select query_id, sub_id, index_name, chunk_id, round(score, 6) as score, rank from h""",
)
def fan_out(spark, d):
    """User turns go to documents and passages, assistant turns to pages, system turns to passages."""
    names = (
        F.when(F.col("role") == "user", F.array(F.lit("documents"), F.lit("benchmark")))
        .when(F.col("role") == "assistant", F.array(F.lit("pages")))
        .otherwise(F.array(F.lit("benchmark")))
    )
    routes = read_table(spark, d, "conversations").select(
        F.col("conv_id").alias("query_id"), F.col("turn").alias("sub_id"), F.explode(names).alias("index_name"), "text"
    )
    return hits_of(retrieval.fan_out(routes, indexes(spark, d), 3), "sub_id", "index_name", "rank")


@plan(
    "nearest_routes",
    f"""with {QUESTIONS}, subs as (select conv_id || '-' || turn as rk, conv_id as query_id, turn as sub_id, text from conversations),
names as (select source as index_name, string_agg(distinct lang, ' ' order by lang) || ' ' || source as text from documents group by source),
{embedded('qi', 'subs', 'rk', 'text', 'query_id, sub_id')}, {embedded('ni', 'names', 'index_name', 'text')},
{nearest('h', 'qi', 'ni', 2, group='q.query_id, q.sub_id', part='query_id, sub_id', item='index_name')} select query_id, sub_id, index_name from h""",
)
def nearest_routes(spark, d):
    """Routing of every turn to the two document sources described nearest to it."""
    subs = read_table(spark, d, "conversations").select(F.col("conv_id").alias("query_id"), F.col("turn").alias("sub_id"), "text")
    langs = read_table(spark, d, "documents").select("source", "lang").distinct()
    described = langs.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), " ").alias("langs"))
    names = described.select(F.col("source").alias("index_name"), F.concat_ws(" ", "langs", "source").alias("text"))
    return retrieval.nearest_routes(subs, names, 2).select("query_id", "sub_id", "index_name")
