"""Hard negatives by Four-Russians scoring: subset-sum tables of anchors looked up with bit-plane bytes of candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravelin.llm.blocks import dealt, meeting
from ravelin.llm.common import arrow_batches, arrow_rows, slices, stored, table

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of its positive's.
LEAST, MOST = 50, 95
SCALE = 256.0
ANCHOR_EVERY = 50
#: Rows of a block of candidates, anchors of a block of queries, and candidates scored at a time.
BLOCK, ANCHORS, TILE = 4_096, 1_024, 256
#: Dimensions that share a table.
GROUP = 8


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of every component, modulo 2 ** 64 where it needs more than 64 bits."""
    whole = np.fmod(np.floor(SCALE * vectors), 2.0**64)
    return np.where(np.abs(whole) < 2.0**63, whole, whole - np.copysign(2.0**64, whole)).astype(np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes (plane, group, row) of the rows' two's complement: a byte holds one bit of each dimension of a group."""
    rows, dims = values.shape
    top = max(int(values.max(initial=0)), ~int(values.min(initial=0)))
    padded = np.zeros((rows, -(-dims // GROUP) * GROUP), dtype=np.int64)
    padded[:, :dims] = values
    bits = [np.packbits(((padded >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(top.bit_length() + 1)]
    return np.stack(bits)


def from_planes(bits: np.ndarray) -> np.ndarray:
    """The values (row, dimension) that `planes` was made of, padded to whole groups."""
    values = np.zeros((bits.shape[2], bits.shape[1] * GROUP), dtype=np.int64)
    for p, plane in enumerate(bits):
        ones = np.unpackbits(np.ascontiguousarray(plane.T), axis=1, bitorder="little").astype(np.int64)
        values += -(ones << p) if p == len(bits) - 1 else ones << p
    return values


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(group, subset, anchor): what the dimensions of each subset of a group add up to, doubled up bit by bit."""
    groups = anchors.shape[1] // GROUP
    sums = np.zeros((groups, 1 << GROUP, len(anchors)), dtype=kind)
    for g in range(groups):
        for k in range(GROUP):
            sums[g, 1 << k : 2 << k] = sums[g, : 1 << k] + anchors[:, g * GROUP + k].astype(kind)
    return sums


def scores(bits: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, inner products (row, anchor)) tile by tile: a lookup for each plane and group, shifted and added.

    Arithmetic is modulo 2 ** 64, or 2 ** 32 where no score can need more.
    """
    groups = max(bits.shape[1], -(-anchors.shape[1] // GROUP))
    width = anchors.shape[1]
    padded = np.zeros((len(anchors), groups * GROUP), dtype=np.int64)
    padded[:, :width] = anchors
    low = np.abs(padded.astype(np.float64)).sum(axis=1).max(initial=0) * 2.0 ** (len(bits) - 1) < 2.0**30
    sums = subset_sums(padded, np.int32 if low else np.int64)
    held = np.empty((TILE, len(anchors)), dtype=sums.dtype)
    with np.errstate(over="ignore"):
        for start in range(0, bits.shape[2], TILE):
            some = bits[:, :, start : start + TILE]
            n = some.shape[2]
            total = np.zeros((n, len(anchors)), dtype=sums.dtype)
            for p in range(len(bits) - 1, -1, -1):  # from the sign's plane down: double, then add
                total += total
                plane = np.zeros_like(total) if p == len(bits) - 1 else total
                for g in range(bits.shape[1]):
                    plane += np.take(sums[g], some[p, g], axis=0, out=held[:n], mode="clip")
                total = -plane if p == len(bits) - 1 else plane
            yield start, total


_BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("labels", pa.binary()), ("shape", pa.list_(pa.int32())), ("bits", pa.binary())])
_BLOCKS_SQL = "block long, ids binary, known binary, labels binary, shape array<int>, bits binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows in order of vec_id, unknown ids last, with their bit planes."""
    block = TaskContext.get().partitionId() << 24
    for part in slices(batches, BLOCK):
        vectors = part.column("vector").to_pylist()
        dims = max(map(len, vectors), default=0)
        values = np.zeros((part.num_rows, dims))
        for k, v in enumerate(vectors):
            values[k, : len(v)] = v
        known = ~part.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        ids = part.column("vec_id").fill_null(0).to_numpy()
        order = np.lexsort((ids, ~known))
        bits = planes(integers(values[order]))
        whole = {"ids": ids[order].astype("<i8"), "known": known[order], "labels": part.column("label").to_numpy()[order].astype("<i8"), "bits": bits}
        yield arrow_batches({"block": [block], "shape": [list(bits.shape)]} | {k: [v.tobytes()] for k, v in whole.items()}, _BLOCKS)
        block += 1


def packed(embeddings: DataFrame) -> DataFrame:
    """Blocks of the rows that take part, as bit planes; a row's number is its block's number times BLOCK and its place."""
    label = F.col("label").cast("long")
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector"))
    rows = rows.where(label.isNotNull() & vector.isNotNull() & ~bad)
    moved = F.when(F.col("vec_id") % 7 == 0, ((F.col("label").cast("decimal(20,0)") + 1) % 10).cast("long")).otherwise(F.col("label"))
    return rows.select("vec_id", moved.alias("label"), "vector").mapInArrow(_pack, _BLOCKS_SQL)


class _Block:
    def __init__(self, row: dict) -> None:
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.known = np.frombuffer(row["known"], bool)
        self.bits = np.frombuffer(row["bits"], np.uint8).reshape(row["shape"])
        self.rows = row["block"] * BLOCK + np.arange(len(self.ids))


_ANCHORS = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary())])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 1):
        for row in part.to_pylist():
            block = _Block(row)
            at = np.flatnonzero(block.known & (block.ids % ANCHOR_EVERY == 0))
            vectors = from_planes(np.ascontiguousarray(block.bits[:, :, at]))
            yield arrow_batches({"anchor": block.rows[at], "anchor_id": block.ids[at], "label": block.labels[at], "vector": [v.astype("<i8").tobytes() for v in vectors]}, _ANCHORS)


class _Queries:
    """A block of anchors; `windows` holds the lowest and highest score a negative may have, for each positive."""

    def __init__(self, rows: list[dict]) -> None:
        self.anchors, self.ids, self.labels = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("anchor", "anchor_id", "label"))
        vectors = [np.frombuffer(r["vector"], "<i8") for r in rows]
        self.vectors = np.zeros((len(rows), max(map(len, vectors))), dtype=np.int64)
        for k, v in enumerate(vectors):
            self.vectors[k, : len(v)] = v
        self.windows = [window_of(r["positive_scores"]) for r in rows] if "positive_scores" in rows[0] else []


def window_of(positive_scores: list[int]) -> list[tuple[int, int]]:
    """Least and greatest score of a negative for each positive score, in whole numbers."""
    return [(-(-LEAST * s // 100), MOST * s // 100) for s in positive_scores]


_FOUND = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("other", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "anchor long, anchor_id long, place int, other long, other_id long, score long"


def _gathered() -> tuple[dict[str, list], callable]:
    found: dict[str, list] = {f.name: [] for f in _FOUND}

    def give(queries: _Queries, a: int, place: int, block: _Block, at: np.ndarray, values: np.ndarray) -> None:
        n = len(at)
        ids = [i if k else None for i, k in zip(block.ids[at].tolist(), block.known[at].tolist(), strict=True)]
        for name, some in zip(found, ([int(queries.anchors[a])] * n, [int(queries.ids[a])] * n, [place] * n, block.rows[at].tolist(), ids, values.tolist()), strict=True):
            found[name] += some

    return found, give


def _best_positives(block: _Block, queries: _Queries) -> pa.RecordBatch:
    """For each anchor the first POSITIVES other rows of its label in this block."""
    found, give = _gathered()
    for label in np.intersect1d(block.labels, queries.labels).tolist():
        rows, asked = np.flatnonzero(block.labels == label), np.flatnonzero(queries.labels == label)
        whole = np.concatenate([s for _, s in scores(np.ascontiguousarray(block.bits[:, :, rows]), queries.vectors[asked])])
        for column, a in enumerate(asked.tolist()):
            others = np.flatnonzero(block.rows[rows] != queries.anchors[a])
            own = whole[others, column].astype(np.int64)
            if len(own) > POSITIVES:  # all that reach the last one's score, then in order
                enough = np.partition(own, len(own) - POSITIVES)[len(own) - POSITIVES]
                others, own = others[own >= enough], own[own >= enough]
            order = np.lexsort((np.arange(len(own)), ~own))[:POSITIVES]  # ~ turns the order round without overflow
            give(queries, a, 0, block, rows[others[order]], own[order])
    return arrow_batches(found, _FOUND)


def _best_negatives(block: _Block, queries: _Queries) -> pa.RecordBatch:
    """For each anchor and positive the first NEGATIVES rows of another label in this block with a score in the window."""
    found, give = _gathered()
    whole = np.concatenate([s for _, s in scores(block.bits, queries.vectors)])
    for a, windows in enumerate(queries.windows):
        rows = np.flatnonzero(block.labels != queries.labels[a])
        own = whole[rows, a].astype(np.int64)
        least, most = min(w[0] for w in windows), max(w[1] for w in windows)
        within = (own >= least) & (own <= most)
        rows, own = rows[within], own[within]
        order = np.argsort(~own, kind="stable")  # rows are in order of vec_id
        rows, own = rows[order], own[order]
        for place, (low, high) in enumerate(windows):
            start = int(np.searchsorted(~own, ~high))
            at = np.arange(start, min(start + NEGATIVES, len(own)))
            at = at[own[at] >= low]
            give(queries, a, place, block, rows[at], own[at])
    return arrow_batches(found, _FOUND)


def _scan(work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries = None, None
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            if row["cell"] != cell:
                cell, queries = row["cell"], _Queries(row["queries"])
            yield work(_Block(row), queries)

    return run


def _met(blocks: DataFrame, anchors: DataFrame, work, keep: int, name: str) -> DataFrame:
    """The first `keep` rows for each anchor (and positive) over all blocks: those of each block, then those of all."""
    with arrow_rows(blocks.sparkSession, 1):  # a row holds a block and its queries
        dealt_out, cells = dealt(anchors, ANCHORS, "anchor")
        listed = F.collect_list(F.struct(*anchors.columns)).alias("queries")
        together = stored(dealt_out.groupBy("cell").agg(listed, F.sum(F.octet_length("vector")).alias("bytes")), f"{name}-queries")
        both = meeting(blocks, together, cells, "bytes", "block").select("cell", "queries", *blocks.columns)
        found = stored(both.mapInArrow(_scan(work), _FOUND_SQL), name)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor's positives.

    Components become floor(256 x); a score is the whole inner product, made of lookups: the anchors' subset sums of eight
    dimensions are tabled, and each byte of a candidate's bit planes indexes them. Anchors (vec_id divisible by 50) meet
    all rows block by block; a block gives a bounded number of rows for each anchor, and the first of all blocks remain.
    Positives are the first 5 other rows of the label, negatives the first 3 of other labels whose score lies between
    50 and 95 percent of the positive's; higher scores come first, then smaller vec_id.

    Rows with a null label, vector or component, or a component that is not finite, take no part. A row without vec_id is
    no anchor and comes last among ties; rows that share a vec_id stay rows of their own, anchors too, in a fixed but
    unstated order. A shorter vector counts as filled up with zeros. Scores are taken modulo 2 ** 64, so they are right as
    long as they fit a long. Other columns are left out; an empty table gives no rows.
    """
    blocks = stored(packed(embeddings), "planes")
    with arrow_rows(embeddings.sparkSession, 1):
        anchors = stored(blocks.mapInArrow(_anchors, "anchor long, anchor_id long, label long, vector binary"), "anchors")
    positives = stored(_met(blocks, anchors, _best_positives, POSITIVES, "positives"), "chosen")
    listed = positives.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("ranked"))
    asked = stored(anchors.join(listed.select("anchor", F.col("ranked.score").alias("positive_scores")), "anchor"), "asked")
    negatives = _met(blocks, asked, _best_negatives, NEGATIVES, "negatives")
    own = positives.select("anchor", (F.col("rank") - 1).alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    both = negatives.select("anchor", "anchor_id", "place", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return both.join(own, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor of the embeddings."""
    return hard_negatives(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))


ORACLE = """
with taken as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from taken a join taken b on a.vec_id <> b.vec_id
  where a.vec_id % 50 = 0
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
), negatives as (
  select p.anchor_id, p.positive_id, s.other_id as negative_id, p.positive_score, s.score as negative_score,
         row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id)::int as rank
  from positives p join scored s on s.anchor_id = p.anchor_id
  where not s.same and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""
