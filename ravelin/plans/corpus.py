"""Document plans: loaders over files written from the tables, chunking, windows, embedding."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ravelin.operators import transforms
from ravelin.plans import inputs, plan
from ravelin.plans.sql import DOC_INDEX, DOCS, SENTENCE_ROWS, SENTENCES, WORDS, windows
from ravelin.sources import files, media
from ravelin.sources.tables import read_table, spread


def benchmark_files(spark, d, kind: str) -> str:
    """One file per benchmark passage below `<folder>/item_id=<n>/`."""
    path = inputs.scratch(spark, kind)
    rows = read_table(spark, d, "benchmark")
    if kind == "text":
        rows.select("item_id", "text").write.partitionBy("item_id").text(path)
    else:
        rows.select("item_id", F.col("item_id").alias("id"), "text").write.partitionBy("item_id").json(path)
    return path


def document_csv(spark, d) -> str:
    path = inputs.scratch(spark, "csv")
    rows = spread(read_table(spark, d, "documents"), "doc_id").select("doc_id", "lang", "source", "n_chars", "text")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


TEXT_FILES = "select 'text' as modality, text || chr(10) as text from benchmark"
JSON_FILES = "select 'json' as modality, 'id: ' || item_id || chr(10) || 'text: ' || text as text from benchmark"
CSV_FILES = "select 'csv' as modality, concat_ws(', ', doc_id, lang, source, n_chars, text) as text from documents"


@plan("load_text", TEXT_FILES)
def load_text(spark, d):
    return files.load_text(spark, benchmark_files(spark, d, "text"), recursive=True).select("modality", "text")


@plan("load_json", JSON_FILES)
def load_json(spark, d):
    return files.load_json(spark, benchmark_files(spark, d, "json"), recursive=True).select("modality", "text")


@plan("load_csv", CSV_FILES)
def load_csv(spark, d):
    return files.load_csv(spark, document_csv(spark, d)).select("modality", "text")


@plan("load_tenant_tree", "select 'item_id=' || item_id as tenant_id, text || chr(10) as text from benchmark")
def load_tenant_tree(spark, d):
    return files.load_tenant_tree(spark, benchmark_files(spark, d, "text")).select("tenant_id", "text")


@plan("load_corpus", f"select modality, count(*) as n, sum(length(text)) as chars from ({TEXT_FILES} union all {JSON_FILES} union all {CSV_FILES}) group by modality")
def load_corpus(spark, d):
    docs = files.load_corpus(
        spark, benchmark_files(spark, d, "text"), benchmark_files(spark, d, "json"), document_csv(spark, d), recursive=True
    )
    return docs.groupBy("modality").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


PAGE_KEY = "substr(sha256('caption|' || url || '|' || strlen(html) || '|' || page_id * 1000), 1, 24)"


def page_files(spark, d):
    """Pages as if they were media files: name, size, time and bytes."""
    pages = read_table(spark, d, "pages")
    return spread(pages, "page_id").select(
        F.col("page_id").cast("string").alias("path"),
        F.col("url").alias("name"),
        F.octet_length("html").cast("bigint").alias("size"),
        (F.col("page_id") * 1000).alias("mtime_us"),
        F.col("html").cast("binary").alias("content"),
    )


def page_cache(spark, d):
    """The pages of plain http addresses are known already."""
    known = media.with_cache_key(page_files(spark, d).drop("content"), "caption").where(F.col("name").startswith("http://"))
    return known.select("key", F.concat(F.lit("known "), "path").alias("text"))


@plan("media_cache_split", f"select page_id::varchar as path, {PAGE_KEY} as key, starts_with(url, 'http://') as hit from pages")
def media_cache_split(spark, d):
    return media.cache_split(page_files(spark, d).drop("content"), page_cache(spark, d), "caption").select("path", "key", "hit")


@plan(
    "extract_text",
    f"""select page_id::varchar as doc_id, {PAGE_KEY} as key, 'image' as modality, starts_with(url, 'http://') as cached,
  case when starts_with(url, 'http://') then 'known ' || page_id else regexp_extract(html, '<title>([^<]*)</title>', 1) end as text
  from pages where starts_with(url, 'http://') or regexp_extract(html, '<title>([^<]*)</title>', 1) <> ''""",
)
def extract_text(spark, d):
    def title(path: str, content: bytes) -> str | None:
        found = re.search("<title>([^<]*)</title>", content.decode())
        return found.group(1) if found else None

    rows = media.extract_text(page_files(spark, d), title, "image", page_cache(spark, d))
    return rows.select("doc_id", "key", "modality", "cached", "text")


@plan(
    "extract_pages",
    """select page_id || '#' || (i - 1) as doc_id, i - 1 as page, parts[i] as text from
  (select page_id, parts, unnest(range(1, len(parts) + 1)) as i from (select page_id, regexp_extract_all(html, '>([^<>]+)<', 1) as parts from pages))""",
)
def extract_pages(spark, d):
    """Many documents a file: each run of text between two tags of a web page."""

    def parts(path: str, content: bytes) -> list[str]:
        return re.findall(">([^<>]+)<", content.decode())

    none = spark.createDataFrame([], media.PAGE_CACHE_SCHEMA)
    return media.extract_pages(page_files(spark, d), parts, "pdf", none).select("doc_id", "page", "text")


@plan("count_by_modality", "select coalesce(lang, 'unknown') as modality, count(*) as n from documents group by all")
def count_by_modality(spark, d):
    return transforms.count_by_modality(inputs.documents(spark, d))


@plan("replicate", "select doc_id || '#' || i as doc_id, md5(text) as digest from documents, range(3) r(i)")
def replicate(spark, d):
    return transforms.replicate(inputs.documents(spark, d), 3).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def digests(chunks):
    return chunks.select("chunk_id", F.md5(F.col("text").cast("binary")).alias("digest"))


def packing_sql(size: int, overlap: int) -> str:
    """The greedy packing, one piece at a time for every document."""
    return f"""with recursive {DOCS},
sent as (select doc_id, {SENTENCES.format('text')} as ss from docs),
cut as (select doc_id, flatten(list_transform(ss, lambda s: list_transform(range(0, ceil(len({WORDS.format('s')}) / {size})::bigint),
  lambda i: array_to_string(({WORDS.format('s')})[i * {size} + 1 : (i + 1) * {size}], ' ')))) as ps from sent),
p as (select doc_id, ps, list_transform(ps, lambda s: len({WORDS.format('s')})) as cs from cut where len(ps) > 0),
rec as (
  select doc_id, cs, 1::bigint as pos, 1::bigint as first, cs[1]::bigint as total, null::bigint as f, null::bigint as l from p
  union all
  select doc_id, cs, pos + 1, case when total + c <= {size} then first when ts + c <= {size} then pos - j + 1 else pos + 1 end,
    (case when total + c <= {size} then total + c when ts + c <= {size} then ts + c else c end)::bigint,
    case when total + c > {size} then first end, case when total + c > {size} then pos end
  from (select *, cs[pos + 1] as c, coalesce(list_sum(cs[pos - j + 1 : pos]), 0) as ts from (
    select *, len(list_filter(range(1, pos - first + 2), lambda j: list_sum(cs[pos - j + 1 : pos]) <= {overlap})) as j from rec where pos < len(cs)))),
spans as (select doc_id, f, l from rec where f is not null union all select doc_id, first, pos from rec where pos = len(cs)),
chunks as (select doc_id || '#' || (row_number() over (partition by doc_id order by l) - 1) as chunk_id,
  array_to_string(ps[f:l], ' ') as text from spans join p using (doc_id))
select chunk_id, md5(text) as digest from chunks"""


@plan("sentence_chunks", packing_sql(128, 16))
def sentence_chunks(spark, d):
    return digests(transforms.sentence_chunks(inputs.documents(spark, d), 128, 16))


@plan("word_windows", f"with {DOCS}, {windows('c', 'docs', 128, 16)} select chunk_id, md5(text) as digest from c")
def word_windows(spark, d):
    return digests(transforms.word_windows(inputs.documents(spark, d), 128, 16))


@plan("sentence_windows", f"with {DOCS}, {SENTENCE_ROWS} select chunk_id, md5(original_text) as sentence, md5(\"window\") as around from sent")
def sentence_windows(spark, d):
    rows = inputs.sentences(spark, d)
    return rows.select(
        "chunk_id", F.md5(F.col("original_text").cast("binary")).alias("sentence"), F.md5(F.col("window").cast("binary")).alias("around")
    )


@plan("doc_summary", "select doc_id::varchar as doc_id, replace(substr(text, 1, 300), chr(10), ' ') as text from documents")
def doc_summary(spark, d):
    return transforms.doc_summary(inputs.documents(spark, d)).select("doc_id", "text")


@plan(
    "embed_text",
    f"with {DOC_INDEX} select * from (select k as chunk_id, pos, round(e[pos + 1], 6) as x from (select k, e, unnest(range(64)) as pos from di)) where x <> 0",
)
def embed_text(spark, d):
    rows = inputs.document_index(spark, d).select("chunk_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))
    return rows.withColumn("x", F.round("x", 6)).where("x <> 0")


@plan(
    "batch_rows",
    "select doc_id::varchar as doc_id, ((row_number() over (partition by lang order by doc_id::varchar) - 1) // 50)::bigint as batch from documents",
)
def batch_rows(spark, d):
    rows = inputs.documents(spark, d).select("doc_id", "modality")
    return transforms.batch_rows(rows, 50, ["doc_id"], ["modality"]).select("doc_id", F.col("batch").cast("bigint").alias("batch"))
