"""Knowledge-graph plans: triples from documents and from the master data, graph questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ravelin.functions.embedders import embed
from ravelin.functions.text import TOKEN_BREAK
from ravelin.operators import graph as kg
from ravelin.plans import inputs, plan
from ravelin.plans.sql import DOCS, embedded, nearest, tokens, windows
from ravelin.sources.tables import read_table, spread

WORD_PHRASES = {"of": "OF", "with": "WITH", "de": "DE", "und": "UND"}
FACT_PHRASES = {"lives in": "LIVES_IN", "is based in": "BASED_IN", "is part of": "PART_OF"}


def triples_sql(name: str, source: str, phrases: dict[str, str], cap: int = 12) -> str:
    word = r"[\p{L}\p{N}#_]+"
    pieces = " union all ".join(
        f"select chunk_id, {n} as ord, '{r}' as rel, ' {p} ' as middle, ps, unnest(range(1, len(ps))) as i from (select chunk_id, string_split(text, ' {p} ') as ps from {source})"
        for n, (p, r) in enumerate(phrases.items())
    )
    return f"""{name}_l as (select chunk_id, ord, rel, length(array_to_string(ps[1:i], '')) + (i - 1) * length(middle) as at_,
  regexp_extract(ps[i], '{word}\\z') as src, regexp_extract(ps[i + 1], '\\A{word}') as dst from ({pieces})),
{name} as (select chunk_id, src, rel, dst from {name}_l where src <> '' and dst <> '' qualify row_number() over (partition by chunk_id order by at_, ord) <= {cap})"""


TEXT_TRIPLES = f"with {DOCS}, {windows('c', 'docs', 300, 30)}, {triples_sql('tr', 'c', WORD_PHRASES)}"
FACT_CHUNKS = """fc as (select 'c-' || c_custkey as chunk_id, c_name || ' lives in ' || n_name || '.' as text from customer join nation on c_nationkey = n_nationkey
  union all select 's-' || s_suppkey, s_name || ' is based in ' || n_name || '.' from supplier join nation on s_nationkey = n_nationkey
  union all select 'n-' || n_nationkey, n_name || ' is part of ' || replace(r_name, ' ', '_') || '.' from nation join region on n_regionkey = r_regionkey)"""
FACTS = f"with {FACT_CHUNKS}, {triples_sql('tr', 'fc', FACT_PHRASES)}"
EDGES = """rel as (select distinct src, rel, dst from tr), ent as (select distinct name from (select src as name from tr union all select dst from tr)),
mention as (select distinct chunk_id as src, 'MENTIONS' as rel, name as dst from (select chunk_id, src as name from tr union all select chunk_id, dst from tr))"""


def text_chunks(spark, d):
    return inputs.chunk_index(spark, d, 300, 30).select("chunk_id", "text")


def fact_chunks(spark, d):
    """One sentence for each customer, supplier and nation."""
    table = lambda name: read_table(spark, d, name)
    nation, region = table("nation"), table("region")
    sentence = lambda rows, prefix, key, name, phrase, place: rows.select(
        F.concat_ws("-", F.lit(prefix), F.col(key).cast("string")).alias("chunk_id"),
        F.concat(F.col(name), F.lit(f" {phrase} "), F.replace(F.col(place), F.lit(" "), F.lit("_")), F.lit(".")).alias("text"),
    )
    customers = table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        sentence(customers, "c", "c_custkey", "c_name", "lives in", "n_name")
        .unionByName(sentence(suppliers, "s", "s_suppkey", "s_name", "is based in", "n_name"))
        .unionByName(sentence(nations, "n", "n_nationkey", "n_name", "is part of", "r_name"))
    )


def fact_graph(spark, d):
    chunks = fact_chunks(spark, d)
    return kg.build_graph(kg.extract_triples(chunks, FACT_PHRASES), chunks)


def text_graph(spark, d):
    chunks = text_chunks(spark, d)
    return kg.build_graph(kg.extract_triples(chunks, WORD_PHRASES), chunks)


def region_questions(spark, d):
    return read_table(spark, d, "region").select(
        F.col("r_regionkey").cast("string").alias("query_id"), F.concat(F.lit("Who lives or trades in "), "r_name", F.lit("?")).alias("text")
    )


REGION_QUESTIONS = "rq as (select r_regionkey::varchar as query_id, 'Who lives or trades in ' || r_name || '?' as text from region)"


@plan("extract_triples", f"{TEXT_TRIPLES} select chunk_id, src, rel, dst, count(*) as n from tr group by all")
def extract_triples(spark, d):
    rows = kg.extract_triples(text_chunks(spark, d), WORD_PHRASES)
    return rows.groupBy("chunk_id", "src", "rel", "dst").agg(F.count("*").alias("n"))


@plan("extract_triples_model", f"{FACTS} select chunk_id, src, rel, dst from tr")
def extract_triples_model(spark, d):
    """The same facts through a user-supplied extractor."""

    def extractor(text: str) -> list[tuple[str, str, str]]:
        known = {"lives in": "LIVES_IN", "is based in": "BASED_IN", "is part of": "PART_OF"}
        out = []
        for phrase, relation in known.items():
            left, found, right = text.rstrip(".").partition(f" {phrase} ")
            if found:
                out.append((left, relation, right))
        return out

    return kg.extract_triples_with(fact_chunks(spark, d), extractor)


@plan("build_graph", f"{TEXT_TRIPLES}, {EDGES} select src, rel, dst, 'relation' as kind from rel union all select src, rel, dst, 'mention' from mention")
def build_graph(spark, d):
    return text_graph(spark, d).edges


@plan("open_graph", f"{TEXT_TRIPLES}, {EDGES} select src, rel, dst, 'relation' as kind from rel union all select src, rel, dst, 'mention' from mention")
def open_graph(spark, d):
    """The edges of the stored text graph, read back."""
    path = inputs.scratch(spark, "graph")
    kg.save_graph(text_graph(spark, d), path)
    return kg.open_graph(spark, path).edges


@plan(
    "graph_stats",
    f"""{TEXT_TRIPLES}, {EDGES} select (select count(*) from ent) + (select count(*) from c) as nodes,
  (select count(*) from rel) + (select count(*) from mention) as relationships, (select count(*) from ent) as entities""",
)
def graph_stats(spark, d):
    return kg.graph_stats(text_graph(spark, d))


@plan("list_triples", f"{FACTS}, {EDGES} select * from rel order by src, rel, dst limit 60")
def list_triples(spark, d):
    return kg.list_triples(fact_graph(spark, d), 60)


INDEXED = f"{FACTS}, {EDGES}, {REGION_QUESTIONS}, {embedded('qi', 'rq', 'query_id', 'text')}, {embedded('ei', 'ent', 'name', 'name')}, {nearest('vs', 'qi', 'ei', 4, item='name')}"


def named_sql(name: str, questions: str, dictionary: str) -> str:
    """CTE `name`(query_id, name): runs of words equal to a run of `dictionary`(run, name) and inside no longer such run."""
    return f"""{name}_q as (select query_id, {tokens('text')} as ws from {questions}),
{name}_s as (select query_id, ws, n, unnest(range(1, len(ws) - n + 2)) as s from {name}_q, (select distinct len(run) as n from {dictionary}) where len(ws) >= n),
{name}_m as (select query_id, s, s + n - 1 as e, d.name from {name}_s join {dictionary} d on d.run = ws[s : s + n - 1]),
{name} as (select distinct query_id, name from {name}_m m
  where not exists (select 1 from {name}_m o where o.query_id = m.query_id and o.s <= m.s and o.e >= m.e and o.e - o.s > m.e - m.s))"""


NAMES = f"names as (select name, {tokens('name')} as run from ent where len({tokens('name')}) > 0)"
KEYWORDS = f"""{NAMES}, {named_sql('kw', 'rq', 'names')},
seeds as (select query_id, name from vs union select query_id, name from kw)"""


@plan("vector_seeds", f"{INDEXED} select query_id, name, round(score, 6) as score, rank from vs")
def vector_seeds(spark, d):
    queries = embed(region_questions(spark, d))
    hits = kg.vector_seeds(queries, kg.entity_index(fact_graph(spark, d)), 4)
    return hits.select("query_id", "name", F.round("score", 6).alias("score"), "rank")


@plan(
    "keyword_seeds",
    f"""{TEXT_TRIPLES}, {EDGES}, syn as (select lang as keyword, source as synonym from documents group by all),
{NAMES}, q as (select conv_id || '-' || turn as query_id, text from conversations where role = 'user'),
dict as (select run, name from names union select {tokens('keyword')}, name from syn join names on run = {tokens('synonym')}),
{named_sql('kws', 'q', 'dict')} select query_id, name from kws""",
)
def keyword_seeds(spark, d):
    """Words of every user question among the entities of the text graph; language codes stand for their sources."""
    synonyms = read_table(spark, d, "documents").select(F.col("lang").alias("keyword"), F.col("source").alias("synonym")).distinct()
    return kg.keyword_seeds(inputs.questions(spark, d), text_graph(spark, d).entities, synonyms)


@plan(
    "keyword_seeds_phrases",
    f"""with ent as (select distinct trim(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', '_', 'g'), '_') as name from benchmark),
{NAMES}, q as (select doc_id::varchar as query_id, {tokens('text')} as ws from documents),
pairs as (select query_id, ws, name, run from q join names on contains(' ' || array_to_string(ws, ' ') || ' ', ' ' || array_to_string(run, ' ') || ' ')),
m as (select query_id, name, len(run) as n, unnest(list_filter(range(1, len(ws) - len(run) + 2), lambda i: ws[i : i + len(run) - 1] = run)) as s from pairs)
select distinct query_id, name from m where not exists
  (select 1 from m o where o.query_id = m.query_id and o.s <= m.s and o.s + o.n >= m.s + m.n and o.n > m.n)""",
)
def keyword_seeds_phrases(spark, d):
    """Names of many words: every benchmark passage, written with underscores, looked up in every document."""
    joined = F.btrim(F.regexp_replace("text", TOKEN_BREAK, "_"), F.lit("_"))
    names = read_table(spark, d, "benchmark").select(joined.alias("name")).distinct()
    return kg.keyword_seeds(inputs.documents(spark, d).select(F.col("doc_id").alias("query_id"), "text"), names)


def walk_sql(seeds: str) -> str:
    return f"""both_ways as (select src as at_, dst as to_, src, rel, dst from rel where src <> dst union all select dst, src, src, rel, dst from rel where src <> dst),
p1 as (select s.query_id, s.name as a, e.to_ as b, src, rel, dst from {seeds} s join both_ways e on e.at_ = s.name),
p2 as (select p1.query_id, e.src, e.rel, e.dst from p1 join both_ways e on e.at_ = p1.b and e.to_ <> p1.a),
paths as (select query_id, src, rel, dst, min(hop) as hop from (select query_id, src, rel, dst, 1 as hop from p1 union all select query_id, src, rel, dst, 2 from p2) group by all)"""


REGION_SEEDS = "rs as (select replace(r_name, ' ', '_') as query_id, replace(r_name, ' ', '_') as name from region)"


@plan("walk", f"{FACTS}, {EDGES}, {REGION_SEEDS}, {walk_sql('rs')} select query_id, src, rel, dst, hop from paths")
def walk(spark, d):
    """Two hops out of every region: its nations, then whoever lives or is based there."""
    seeds = read_table(spark, d, "region").select(F.replace(F.col("r_name"), F.lit(" "), F.lit("_")).alias("name"))
    return kg.walk(seeds.withColumn("query_id", F.col("name")), fact_graph(spark, d).edges, 2)


STATED = f"{INDEXED}, {KEYWORDS}, {walk_sql('seeds')}, found as (select query_id, src, rel, dst, hop, chunk_id, text from paths join (select distinct * from tr) using (src, rel, dst) join fc using (chunk_id))"


@plan("graph_retrieve", f"{STATED} select query_id, src, rel, dst, hop, chunk_id, text from found")
def graph_retrieve(spark, d):
    return kg.graph_retrieve(embed(region_questions(spark, d)), fact_graph(spark, d), depth=2, k=4)


@plan(
    "graph_vs_vector",
    f"""{STATED}, {embedded('ci', 'fc', 'chunk_id', 'text', 'text')}, {nearest('plain', 'qi', 'ci', 3)}
select query_id, 'vector' as method, chunk_id, text from plain join fc using (chunk_id) union all select distinct query_id, 'graph', chunk_id, text from found""",
)
def graph_vs_vector(spark, d):
    index = embed(spread(fact_chunks(spark, d), "chunk_id"))
    return kg.graph_vs_vector(embed(region_questions(spark, d)), fact_graph(spark, d), index)
