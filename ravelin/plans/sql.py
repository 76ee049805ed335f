"""SQL building blocks of the checks. They restate the definitions, not the Spark plans."""

from __future__ import annotations

TOKENS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda z: z <> '')"
WORDS = r"list_filter(regexp_split_to_array({0}, '[ \t\n\r\f]+'), lambda z: z <> '')"
BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"
SENTENCES = (
    r"list_filter(list_transform(regexp_split_to_array({0}, '[.!?]+[ \t\n\r\f]+'), lambda s: trim(s, " + BLANKS + r")), lambda s: s <> '')"
)
COSINE = "case when {0}.n * {1}.n > 0 then list_dot_product({0}.e, {1}.e) / ({0}.n * {1}.n) else 0 end"


def tokens(text: str) -> str:
    return TOKENS.format(text)


def exact(value: str, digits: int) -> str:
    """Half-up rounding of the decimal value, free of binary halves."""
    return f"round(({value})::decimal(28,12), {digits})::double"


def embedded(name: str, source: str, key: str, text: str, carry: str = "") -> str:
    """CTEs ending in `name`(k, e, n and the carried columns): hashed token counts, unit length, float storage."""
    extra = f", {carry}" if carry else ""
    return f"""
{name}_t as (select {key} as k, unnest({tokens(text)}) as tok from {source}),
{name}_c as (select k, ('0x' || substr(md5(tok), 1, 8))::bigint % 64 as b, count(*)::double as c from {name}_t group by all),
{name}_m as (select k, map(list(b), list(c)) as m, sqrt(sum(c * c)) as len from {name}_c group by k),
{name}_e as (select s.{key} as k{extra}, list_transform(range(64), lambda b: (coalesce(m[b], 0) / coalesce(len, 1))::float::double) as e
  from {source} s left join {name}_m x on x.k = s.{key}),
{name} as (select *, sqrt(list_dot_product(e, e)) as n from {name}_e)"""


def nearest(name: str, queries: str, items: str, k: int, on: str = "true", group: str = "q.k as query_id", part: str = "query_id", item: str = "chunk_id") -> str:
    """CTE `name`(group…, item, score, rank): the k best items of each query by cosine."""
    return f"""
{name}_s as (select {group}, i.k as {item}, round({COSINE.format('q', 'i')}, 10) as score from {queries} q join {items} i on {on}),
{name} as (select *, row_number() over (partition by {part} order by score desc, {item}) as rank from {name}_s
  qualify row_number() over (partition by {part} order by score desc, {item}) <= {k})"""


DOCS = "docs as (select doc_id::varchar as doc_id, text, source as tenant_id from documents)"
QUESTIONS = "questions as (select conv_id || '-' || turn as query_id, conv_id, text from conversations where role = 'user')"
FACTS = "facts as (select item_id::varchar as query_id, text, text as expected from benchmark)"
OOS = "oos as (select conv_id || '-' || turn as query_id, text from conversations where role = 'system')"
DOC_INDEX = DOCS + "," + embedded("di", "docs", "doc_id", "text", "tenant_id, text")
ASKED = QUESTIONS + "," + embedded("qi", "questions", "query_id", "text", "conv_id, text")
FACT_INDEX = FACTS + "," + embedded("fi", "facts", "query_id", "text", "expected, text")
VECTORS = """v as (select vec_id as k, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n,
  label from embeddings)"""
SCALED = """sv as (select k, list_transform(e, lambda x: x * (1 + k % 5)) as e, n * (1 + k % 5) as n from v)"""


def windows(name: str, source: str, size: int, overlap: int, key: str = "doc_id") -> str:
    """CTE `name`(key, seq, chunk_id, text): windows of words."""
    step = size - overlap
    return f"""
{name}_w as (select {key}, {WORDS.format('text')} as ws from {source}),
{name}_i as (select {key}, ws, unnest(range(0, greatest(0, ceil((len(ws) - {size}) / {step}))::bigint + 1)) as seq from {name}_w where len(ws) > 0),
{name} as (select {key}, seq, {key} || '#' || seq as chunk_id, array_to_string(ws[seq * {step} + 1 : seq * {step} + {size}], ' ') as text from {name}_i)"""


SENTENCE_ROWS = f"""
sent_l as (select doc_id, {SENTENCES.format('text')} as ss from docs),
sent_i as (select doc_id, ss, unnest(range(0, len(ss))) as seq from sent_l),
sent as (select doc_id, seq, doc_id || '#' || seq as chunk_id, ss[seq + 1] as original_text,
  array_to_string(ss[greatest(1, seq - 2) : seq + 4], ' ') as "window" from sent_i)"""


def bm25(name: str, hits: str, questions: str, corpus: str, top_n: int) -> str:
    """CTE `name`(query_id, chunk_id, score, rank, text): `hits`(query_id, chunk_id, text) ranked by BM25."""
    return f"""
{name}_tok as (select chunk_id, {tokens('text')} as ts from {corpus}),
{name}_st as (select count(*) as docs, avg(len(ts)) as al from {name}_tok),
{name}_df as (select term, count(*) as df from (select chunk_id, unnest(list_distinct(ts)) as term from {name}_tok) group by term),
{name}_tf as (select chunk_id, any_value(l) as l, term, count(*) as tf from (select chunk_id, len(ts) as l, unnest(ts) as term
  from {name}_tok where chunk_id in (select chunk_id from {hits})) group by chunk_id, term),
{name}_qt as (select query_id, unnest(list_distinct({tokens('text')})) as term from {questions}),
{name}_sc as (select h.query_id, h.chunk_id,
  sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * l / al))) as s
  from {hits} h join {name}_qt using (query_id) join {name}_df using (term) join {name}_tf tf on tf.chunk_id = h.chunk_id and tf.term = {name}_df.term
  cross join {name}_st group by all),
{name}_all as (select h.query_id, h.chunk_id, h.text, round(coalesce(s, 0), 10) as score from {hits} h left join {name}_sc using (query_id, chunk_id)),
{name} as (select *, row_number() over (partition by query_id order by score desc, chunk_id) as rank from {name}_all
  qualify row_number() over (partition by query_id order by score desc, chunk_id) <= {top_n})"""


def events_sql() -> str:
    return """ev as (select event_id as seq, user_id as id, 't' || (user_id % 5) as tenant_id, event_type as title, props as body,
  case event_type when 'signup' then 'c' when 'view' then 'r' when 'error' then 'd' else 'u' end as op from events),
live as (select id, tenant_id, title, body from (select *, row_number() over (partition by id order by seq desc) as r from ev) where r = 1 and op <> 'd')"""
