"""Ranked lexical search on K2-treaps: quadtrees over the grid of terms and documents whose cells hold impact maxima."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravelin.llm.blocks import dealt, meeting
from ravelin.llm.common import arrow_batches, arrow_rows, slices, stored, table
from ravelin.session import broadcast_if_small

TOP = 20
#: A shard, the grid of one treap, ends with the document that reaches one of these.
POSTINGS, DOCS = 1 << 19, 1 << 14
#: Items of a block of queries, and ranges of documents that descend at a time.
ITEMS, AT_ONCE = 256, 64
#: Inner cells hold their maximum in units of this many, rounded up; an impact is below 1,000,000, so 16 bits are enough.
UNIT = 16
#: A stored row holds a whole shard, so few of them are buffered for a row group.
BLOCK_FILES = {"parquet.block.row.count.limit": 4, "compression": "zstd"}

#: Bytes of UTF-8 that belong to a term stay, A to Z in lower case; all others become blanks.
_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """All terms of a text in UTF-8, in order."""
    return text.translate(_TERM_BYTES).split()


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


_POSTINGS = pa.schema(
    [("shard", pa.int64()), ("holding", pa.int64()), ("tokens", pa.int64()), ("terms", pa.list_(pa.binary())), ("df", pa.list_(pa.int32()))]
    + [(c, pa.binary()) for c in ("doc_ids", "known", "lengths", "sizes", "rows", "tf")]
)
_POSTINGS_SQL = "shard long, holding long, tokens long, terms array<binary>, df array<int>, doc_ids binary, known binary, lengths binary, sizes binary, rows binary, tf binary"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of shards: of each document its terms' rows and how often they occur."""
    shard = TaskContext.get().partitionId() << 33

    def shard_row(numbers, ids, lengths, rows, tf) -> pa.RecordBatch:
        sizes, every = np.array([len(r) for r in rows], "<u4"), np.concatenate([*rows, np.empty(0, np.int64)])
        df = np.bincount(every, minlength=len(numbers))
        new = np.empty(len(numbers), np.int64)
        order = np.argsort(-df, kind="stable")  # frequent terms first, so that the full cells lie together
        new[order] = np.arange(len(order))
        names = list(numbers)
        one = {"shard": shard, "holding": int(np.count_nonzero(lengths)), "tokens": sum(lengths), "terms": [names[k] for k in order.tolist()], "df": df[order]}
        one |= {"doc_ids": np.array([i or 0 for i in ids], "<i8").tobytes(), "known": np.array([i is not None for i in ids]).tobytes()}
        one |= {"lengths": np.array(lengths, "<i8").tobytes(), "sizes": sizes.tobytes(), "rows": new[every].astype("<u4").tobytes(), "tf": np.concatenate([*tf, np.empty(0, np.int64)]).astype("<u4").tobytes()}
        return arrow_batches({k: [v] for k, v in one.items()}, _POSTINGS)

    fresh = lambda: (_Numbers(), [], [], [], [])
    state, held = fresh(), 0
    for part in slices(batches):
        for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
            numbers, ids, lengths, rows, tf = state
            found = terms(text or b"")
            own, times = np.unique(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)), return_counts=True)
            ids.append(doc)
            lengths.append(len(found))
            rows.append(own)
            tf.append(times)
            held += len(own)
            if held >= POSTINGS or len(ids) >= DOCS:
                yield shard_row(*state)
                state, held, shard = fresh(), 0, shard + 1
    if state[1]:
        yield shard_row(*state)


def norms(lengths: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    return 75 + (25 * lengths * documents) // max(1, tokens)


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1_000 * tf + 12 * norm)


def _interleaved(x: np.ndarray) -> np.ndarray:
    """The lower 16 bits of every number with a zero bit before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = (x | (x << shift)) & mask
    return x


def build(rows: np.ndarray, docs: np.ndarray, tf: np.ndarray, impact: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Term frequencies of the leaves, and of each level above them the nodes' children and maxima, in order of cells.

    The grid is cut into square bands of 2 ** depth rows, each the root of a quadtree: a node has four bits for the
    quadrants that hold postings (row half, then document half), and the greatest impact below it in UNITs.
    """
    side = (1 << depth) - 1
    cells = ((rows >> depth) << (2 * depth)) | (_interleaved(rows & side) << 1) | _interleaved(docs)
    order = np.argsort(cells)
    cells, leaves, best = cells[order], tf[order], impact[order]
    children, maxima = [], []
    for _ in range(depth):
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] >> 2 != cells[:-1] >> 2]))
        children.append(np.bitwise_or.reduceat(np.uint8(1) << (cells & 3).astype(np.uint8), starts))
        best = np.maximum.reduceat(best, starts)
        maxima.append((-(-best // UNIT)).astype("<u2"))
        cells = cells[starts] >> 2
    return leaves.astype("<u4"), children, maxima


_TREAPS = pa.schema(
    [("shard", pa.int64()), ("depth", pa.int32()), ("terms", pa.list_(pa.binary()))]
    + [(c, pa.binary()) for c in ("doc_ids", "known", "norms", "leaves")]
    + [(c, pa.list_(pa.binary())) for c in ("children", "maxima")]
)
_TREAPS_SQL = "shard long, depth int, terms array<binary>, doc_ids binary, known binary, norms binary, leaves binary, children array<binary>, maxima array<binary>"


def _plant(documents: int, tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            if not row["terms"]:
                continue  # documents without terms only
            lengths, sizes, rows, tf = (np.frombuffer(row[c], kind).astype(np.int64) for c, kind in (("lengths", "<i8"), ("sizes", "<u4"), ("rows", "<u4"), ("tf", "<u4")))
            docs, norm = np.repeat(np.arange(len(sizes)), sizes), norms(lengths, documents, tokens)
            depth = max(1, (len(sizes) - 1).bit_length())
            leaves, children, maxima = build(rows, docs, tf, impacts(tf, norm[docs]), depth)
            one = {c: row[c] for c in ("shard", "terms", "doc_ids", "known")} | {"depth": depth, "norms": norm.astype("<i8").tobytes(), "leaves": leaves.tobytes()}
            one |= {"children": [c.tobytes() for c in children], "maxima": [m.tobytes() for m in maxima]}
            yield arrow_batches({k: [v] for k, v in one.items()}, _TREAPS)

    return run


class Treap:
    """One shard's quadtrees; node 0 of every level is the empty cell."""

    def __init__(self, row: dict) -> None:
        self.depth = row["depth"]
        self.rows = {t: k for k, t in enumerate(row["terms"])}
        self.norms, self.known = np.frombuffer(row["norms"], "<i8"), np.frombuffer(row["known"], bool)
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        empty = lambda x: np.concatenate([[0], x])
        self.leaves = empty(np.frombuffer(row["leaves"], "<u4").astype(np.int64))
        self.children = [empty(np.frombuffer(c, np.uint8)) for c in row["children"]]
        self.maxima = [empty(np.frombuffer(m, "<u2")) for m in row["maxima"]]
        self.first = [1 + np.cumsum(np.bitwise_count(c)) - np.bitwise_count(c) for c in self.children]

    def descend(self, level: int, nodes: np.ndarray, ranges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of every range of documents, with the node of each row's path in them; `level` is the nodes'."""
        children, first = self.children[level - 1][nodes], self.first[level - 1][nodes]
        low = (((rows >> (level - 1)) & 1) << 1).astype(np.uint8)
        halves = []
        for half in (0, 1):
            quadrant = low + np.uint8(half)
            below = children & ((np.uint8(1) << quadrant) - np.uint8(1))
            halves.append(np.where((children >> quadrant) & 1, first + np.bitwise_count(below), 0))
        return np.concatenate(halves), np.concatenate([2 * ranges, 2 * ranges + 1])

    def search(self, asked: list[tuple[bytes, int]], floor: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that may be among the first `top`: none with a score below `floor` or below the last of them.

        Ranges of documents wait in a heap by their bound, the sum of their cells' weighted maxima; those with the
        highest bound descend first, some at a time, all rows together, until no bound reaches the floor.
        """
        found = [(self.rows[t], w) for t, w in asked if t in self.rows]
        rows, weights = (np.array(x, np.int64) for x in (zip(*found, strict=True) if found else ([], [])))
        docs, values, best = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.empty(0, np.int64)
        heap, ticket = [], count()

        def push(level: int, nodes: np.ndarray, ranges: np.ndarray, bounds: np.ndarray) -> None:
            kept = np.flatnonzero(bounds >= max(floor, 1))
            if len(kept):
                kept = kept[np.argsort(-bounds[kept])]
                heapq.heappush(heap, (-int(bounds[kept[0]]), next(ticket), level, nodes[kept], ranges[kept], bounds[kept]))

        if len(rows):
            roots = (1 + (rows >> self.depth))[None, :]
            push(self.depth, roots, np.zeros(1, np.int64), (self.maxima[-1][roots].astype(np.int64) @ weights) * UNIT)
        while heap and -heap[0][0] >= floor:
            _, _, level, nodes, ranges, bounds = heapq.heappop(heap)
            if len(bounds) > AT_ONCE:
                push(level, nodes[AT_ONCE:], ranges[AT_ONCE:], bounds[AT_ONCE:])
            nodes, ranges = self.descend(level, nodes[:AT_ONCE], ranges[:AT_ONCE], rows)
            if level > 1:
                push(level - 1, nodes, ranges, (self.maxima[level - 2][nodes].astype(np.int64) @ weights) * UNIT)
                continue
            there = ranges < len(self.norms)
            tf, ranges = self.leaves[nodes[there]], ranges[there]
            scored = impacts(tf, self.norms[ranges][:, None]) @ weights
            good = scored >= max(floor, 1)
            docs.append(ranges[good])
            values.append(scored[good])
            best = np.sort(np.concatenate([best, scored[good]]))[-top:]
            if len(best) == top:
                floor = max(floor, int(best[0]))
        docs, values = np.concatenate(docs), np.concatenate(values)
        order = np.lexsort((self.doc_ids[docs], ~self.known[docs], -values))[:top]
        return docs[order], values[order]


_HITS = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _find(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far: dict[int, list[int]] = {}  # the best scores of each item in this task's shards
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            treap, hits = Treap(row), {f.name: [] for f in _HITS}
            for item in row["queries"]:
                best = so_far.get(item["item"], [])
                docs, values = treap.search([(t["term"], t["weight"]) for t in item["asked"]], best[-1] if len(best) == top else 0, top)
                so_far[item["item"]] = sorted([*best, *values.tolist()], reverse=True)[:top]
                ids = [i if k else None for i, k in zip(treap.doc_ids[docs].tolist(), treap.known[docs].tolist(), strict=True)]
                for name, some in zip(hits, ([item["item"]] * len(ids), [item["item_id"]] * len(ids), ids, values.tolist()), strict=True):
                    hits[name] += some
            yield arrow_batches(hits, _HITS)

    return run


def _terms_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = [terms(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("item"), part.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item", "item_id", "found"])


class Index:
    """The stored treaps of a table of documents, and what the scores need of all of them."""

    def __init__(self, documents: int, tokens: int, frequencies: DataFrame, treaps: DataFrame) -> None:
        self.documents, self.tokens, self.frequencies, self.treaps = documents, tokens, frequencies, treaps


def build_index(docs: DataFrame) -> Index:
    """Index every row of `docs` (doc_id, text): terms are counted once, then each shard of documents gets a treap.

    Null and empty texts have no terms and are never found. Repeated rows and ids are rows of their own. Other columns
    are left out. A long text is one column of its shard's grid.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with arrow_rows(docs.sparkSession, 1_024):
        postings = stored(rows.mapInArrow(_gather, _POSTINGS_SQL), "postings", **BLOCK_FILES)
    documents, tokens = (int(x or 0) for x in postings.agg(F.sum("holding"), F.sum("tokens")).first())
    with arrow_rows(docs.sparkSession, 1):
        treaps = stored(postings.drop("df", "holding", "tokens").mapInArrow(_plant(documents, tokens), _TREAPS_SQL), "treaps", **BLOCK_FILES)
    return Index(documents, tokens, postings.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("df").alias("df")))), treaps)


def search(index: Index, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's `top` documents with a score above 0, equal scores by doc_id.

    A term's weight comes from the number of documents that hold it; its impact in a document from how often it occurs
    there and the document's length. Each item's rows descend a shard's treap together, best range of documents first.
    Items without terms, or with terms that no document has, get no rows; items that share an id stay items of their own.
    Documents without id come last among ties.
    """
    spark = items.sparkSession
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    named = rows.mapInArrow(_terms_of_items, "item long, item_id long, found array<binary>")
    asked = stored(named.select("item", "item_id", F.explode("found").alias("term")).groupBy("item", "item_id", "term").agg(F.count("*").alias("times")), "asked")
    wanted = broadcast_if_small(asked.select("term").distinct())
    df = index.frequencies.join(wanted, "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * index.documents + 2.0) / (2.0 * F.col("df") + 1.0)))
    weighted = asked.join(df, "term").withColumn("weight", F.col("times") * weight).where("weight > 0")
    queries = stored(weighted.groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "weight")).alias("asked"), F.sum(F.octet_length("term") + 16).alias("bytes")), "items")
    dealt_out, cells = dealt(queries, ITEMS, "item")
    together = stored(dealt_out.groupBy("cell").agg(F.collect_list(F.struct("item", "item_id", "asked")).alias("queries"), F.sum("bytes").alias("bytes")), "query-blocks")
    with arrow_rows(spark, 1):
        both = meeting(index.treaps, together, cells, "bytes", "shard").select("queries", *index.treaps.columns)
        hits = stored(both.mapInArrow(_find(top), "item long, item_id long, doc_id long, score long"), "hits")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The first documents of every benchmark item."""
    index = build_index(table(spark, folder, "documents").select("doc_id", "text"))
    return search(index, table(spark, folder, "benchmark").select("item_id", "text"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
with words as (
  select doc_id, unnest({_TERMS.format("text")}) as term from documents
), postings as (
  select doc_id, term, count(*) as tf from words group by doc_id, term
), lengths as (
  select doc_id, sum(tf)::bigint as n from postings group by doc_id
), whole as (
  select count(*) as docs, sum(n)::bigint as tokens from lengths
), asked as (
  select item_id, term, count(*) as times
  from (select item_id, unnest({_TERMS.format("text")}) as term from benchmark) group by item_id, term
), weights as (
  select term, floor(1000 * ln((2.0::double * any_value(docs) + 2) / (2.0::double * count(*) + 1)))::bigint as w
  from postings, whole where term in (select term from asked) group by term
), scored as (
  select a.item_id, p.doc_id,
         sum(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * l.n * whole.docs) // whole.tokens))))::bigint as score
  from asked a join weights w using (term) join postings p using (term) join lengths l using (doc_id), whole
  group by a.item_id, p.doc_id
), ranked as (
  select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""
