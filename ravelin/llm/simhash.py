"""SimHash fingerprints, all fingerprints within a Hamming radius through permuted block tables, and verified near copies."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm import hamming_dedup
from ravelin.llm.common import arrow_batches, arrow_rows, slices, stored, table, temp, texts_of
from ravelin.llm.components import components
from ravelin.llm.near_dedup import BATCH_ROWS, candidate_pairs, node_of, stray_links, verified_links
from ravelin.llm.shingles import mix, shingles
from ravelin.session import broadcast_if_small

BITS, RADIUS = 64, 3
#: Texts that share this part of their distinct shingles are near copies. Their fingerprints differ in about 10 bits at
#: 0.8, more than block tables can reach, so they are found by bands of least hashes and verified.
SIMILAR = 0.8
BANDS, ROWS = 12, 4
#: Six blocks, of which two fingerprints within radius 3 agree in three at least: 20 tables with keys of 32 or 33 bits.
BLOCKS = 6
#: Fingerprints of a bucket compared at a time.
TILE = 2_048
#: Fingerprints of a bucket that are searched in one task.
CROWDED = 8_192
#: How hard texts are compressed before they cross the sort.
LEVEL = 9

_SIGNS = (2 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) - 1)


def fingerprints(texts: list[str]) -> np.ndarray:
    """One 64-bit fingerprint for each text: every occurrence of a shingle votes with its hash's bits.

    A bit is set where the votes for it are more than those against it. A text without words has fingerprint 0.
    """
    return _voted(*shingles(texts))


def _voted(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    cells = (owner[:, None] * 8 + np.arange(8)) * 256 + octets
    counts = np.bincount(cells.ravel(), minlength=len(sizes) * 8 * 256).reshape(-1, 256)
    votes = (counts @ _SIGNS).reshape(len(sizes), 64) > 0
    return np.packbits(votes, axis=1).view(">u8").ravel().astype(np.uint64)


def least_bands(hashes: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    """BANDS keys for each text, each of ROWS least hashes of its shingles; none for a text without words.

    Two texts of similarity s share a key with the probability 1 - (1 - s ** ROWS) ** BANDS, 0.998 at 0.8.
    """
    out: list[list[int]] = [[] for _ in sizes]
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    starts = (np.cumsum(sizes) - sizes)[filled]
    multipliers = np.random.Generator(np.random.PCG64(31)).integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.empty((len(filled), BANDS), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(filled), band + 1, dtype=np.uint64)
            for m in multipliers[band * ROWS : (band + 1) * ROWS]:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(hashes * m, starts))
            keys[:, band] = key
    for k, row in zip(filled.tolist(), keys.astype(np.int64).tolist(), strict=True):
        out[k] = row
    return out


def edited(text: str, following: str) -> str:
    """`text` with its last quarter replaced by as much of the beginning of the next text."""
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("place", pa.int32()), ("text", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string())]
    + [(c, pa.int64()) for c in ("bits", "edited_bits", "next_bits")]
    + [("node", pa.binary()), ("bands", pa.list_(pa.int64()))]
)
_FIRST, _LAST, _DONE = 0, 1, 2
_OUT_SQL = "doc_id long, part int, place int, text string, n_chars long, edited_sha256 string, bits long, edited_bits long, next_bits long, node binary, bands array<long>"


def _finished(ids: list, texts: list[str], following: list[str], part: int, in_turn: bool = False) -> pa.RecordBatch:
    """Finished rows; `in_turn` tells that each text but the last is followed by the one after it, whose votes then serve both."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    found = shingles(texts)
    own, other = _voted(*found), fingerprints(changed)
    after = np.concatenate([own[1:], fingerprints(following[-1:])]) if in_turn else fingerprints(following)
    own, other, after = (x.astype(np.int64) for x in (own, other, after))
    nodes = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
    n = len(texts)
    digests = [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed]
    return arrow_batches(
        {"doc_id": ids, "part": [part] * n, "place": [_DONE] * n, "text": [None] * n, "n_chars": [len(t) for t in texts], "edited_sha256": digests, "bits": own, "edited_bits": other, "next_bits": after, "node": nodes, "bands": least_bands(*found)}, _OUT
    )


def _open(doc_id, text: str, part: int, place: int) -> pa.RecordBatch:
    return arrow_batches({f.name: [None] for f in _OUT} | {"doc_id": [doc_id], "part": [part], "place": [place], "text": [text]}, _OUT)


_SMALL = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("packed", pa.binary())])


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the way through the sort."""
    small = zstandard.ZstdCompressor(level=LEVEL)
    for some in slices(batches):
        packed = [small.compress(t) for t in some.column("text").cast(pa.binary()).to_pylist()]
        yield arrow_batches({"doc_id": some.column("doc_id"), "tie": some.column("tie"), "packed": packed}, _SMALL)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of id: each text with the next one of the partition. The first text and the last row stay open."""
    part, held, whole = TaskContext.get().partitionId(), None, zstandard.ZstdDecompressor()
    for some in slices(batches):
        ids = some.column("doc_id").to_pylist()
        texts = [whole.decompress(t).decode("utf-8", "surrogatepass") for t in some.column("packed").to_pylist()]
        if held is None:
            yield _open(None, texts[0], part, _FIRST)
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = ids[-1], texts[-1]
        if len(ids) > 1:
            yield _finished(ids[:-1], texts[:-1], texts[1:], part, in_turn=True)
    if held is not None:
        yield _open(*held, part, _LAST)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for some in slices(batches):
        yield _finished(some.column("doc_id").to_pylist(), texts_of(some), texts_of(some, "following"), -1)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, bits, edited_bits, next_bits) of every text, its edited text and the next text.

    Besides, `node` stands for the text itself, and `bands` are its keys for near copies.

    Rows are range-sorted by doc_id (ties by the text's hash; null ids come first) and streamed, each task looking one
    row ahead. Two texts of each task, its first and its last, are joined across task borders; after the last document
    comes the first. A single document follows itself. Null text counts as empty. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    small = rows.withColumn("tie", F.xxhash64("text")).mapInArrow(_shrink, "doc_id long, tie long, packed binary")
    along = stored(small.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_along, _OUT_SQL), "edits")
    parts = sorted(r[0] for r in along.where(F.col("place") == _FIRST).select("part").collect())  # one number for each task
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next_part int")
    firsts = along.where(F.col("place") == _FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    lasts = along.where(F.col("place") == _LAST).select("doc_id", "text", "part").join(after, "part").join(firsts, "next_part")
    kept = ("doc_id", "n_chars", "edited_sha256", "bits", "edited_bits", "next_bits", "node", "bands")
    closed = stored(lasts.select("doc_id", "text", "following").mapInArrow(_close, _OUT_SQL).select(*kept), "closed")  # one row for each task
    return along.where(F.col("place") == _DONE).select(*kept).unionAll(closed)


def masks(bits: int = BITS, blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """The bits that each table compares: every choice of blocks - radius blocks."""
    edges = [round(k * bits / blocks) for k in range(blocks + 1)]
    spans = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(some) for some in combinations(spans, blocks - radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_TABLE, _BUCKET = temp("table"), temp("bucket")


def _bucket_links(radius: int):
    """Links that join all fingerprints of a bucket that a chain of links within the radius joins; buckets come sorted.

    A bucket is searched tile by tile, and only the first link that reaches a fingerprint is given out.
    """
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def forest(members: np.ndarray) -> tuple[list[int], list[int]]:
        """Breadth first: every fingerprint is linked to the one that first reaches it."""
        left, right, rest = [], [], members
        while len(rest):
            front, rest = rest[:1], rest[1:]
            while len(front) and len(rest):
                some, front = front[:TILE], front[TILE:]
                reached = []
                for at in range(0, len(rest), TILE):
                    near = np.bitwise_count(some[:, None] ^ rest[None, at : at + TILE]) <= radius
                    found = np.flatnonzero(near.any(axis=0))
                    left += some[near[:, found].argmax(axis=0)].tolist()
                    right += rest[at + found].tolist()
                    reached.append(at + found)
                new = np.concatenate(reached)
                front, rest = np.concatenate([front, rest[new]]), np.delete(rest, new)
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_at = bucket_at = None
        run_of: list[np.ndarray] = []

        def flush():
            members = np.unique(np.concatenate(run_of).view(np.uint64)) if run_of else np.empty(0, np.uint64)
            if len(members) > 1:
                left, right = forest(members)
                if left:
                    yield arrow_batches({c: np.array(x, np.uint64).astype(np.int64) for c, x in (("a", left), ("b", right))}, out)

        for batch in batches:
            tables, buckets, bits = (batch.column(c).to_numpy() for c in (_TABLE, _BUCKET, "bits"))
            if not len(bits):
                continue
            cuts = np.flatnonzero((tables[1:] != tables[:-1]) | (buckets[1:] != buckets[:-1])) + 1
            edges = [0, *cuts.tolist(), len(bits)]
            sizes = np.diff(edges)
            ends = {0, len(sizes) - 1}  # these may go on in the batches around
            for k in sorted(ends | set(np.flatnonzero(sizes > 1).tolist())):
                start, size = edges[k], sizes[k]
                if (tables[start], buckets[start]) != (table_at, bucket_at):
                    yield from flush()
                    run_of, table_at, bucket_at = [], tables[start], buckets[start]
                run_of.append(bits[start : start + size])
        yield from flush()

    return run


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) that connect all fingerprints (`bits`) within `radius` of each other, directly or in a chain.

    Each distinct fingerprint enters one table for each choice of blocks; two within the radius agree in all blocks of one
    table at least, so no link is missed. Only links that join two groups of a bucket are given out, so a bucket of m gives
    m - 1 at most. Buckets are counted first: the fingerprints of those with more than `crowded` are linked by the tables
    of hamming_dedup, which split a crowded bucket further (for a radius of 3, theirs).
    """
    distinct = prints.select("bits").where("bits is not null").distinct()
    tables = F.array(*(F.struct(F.lit(k).alias(_TABLE), F.col("bits").bitwiseAND(F.lit(_signed(m))).alias(_BUCKET)) for k, m in enumerate(masks(BITS, blocks, radius))))
    dealt = distinct.select("bits", F.inline(tables))
    rest = None
    if radius <= hamming_dedup.RADIUS:
        full = broadcast_if_small(dealt.groupBy(_TABLE, _BUCKET).agg(F.count("*").alias("n")).where(F.col("n") > crowded).select(_TABLE, _BUCKET))
        if full.head(1):
            crowd = dealt.join(full, [_TABLE, _BUCKET], "left_semi").select("bits").distinct()
            rest = hamming_dedup.near_links(crowd, radius=radius)
            dealt = dealt.join(full, [_TABLE, _BUCKET], "left_anti")
    sorted_buckets = dealt.repartition(_TABLE, _BUCKET).sortWithinPartitions(_TABLE, _BUCKET)
    links = sorted_buckets.mapInArrow(_bucket_links(radius), "a long, b long")
    return links if rest is None else links.unionAll(rest)


def near_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(bits, near_class) of the fingerprints that have another one within the radius: the least bits of their chain."""
    return components(near_links(prints, radius)).select(F.col("node").alias("bits"), F.col("root").alias("near_class"))


def copy_links(docs: DataFrame, prints: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Links (a, b) of fingerprints that connect all texts with a shared band whose distinct shingles reach `similar`.

    `prints` are the rows of fingerprint_edits for `docs`. Candidates are verified by the Jaccard similarity of their
    shingles; a bucket is linked as in near_dedup, with an exact pass over buckets of several components.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("node", node_of(F.col("text")))
    signed = prints.select("doc_id", "node", "bands")
    with arrow_rows(spark, BATCH_ROWS):
        plain = spark.sparkContext.broadcast(None)  # every shingle weighs 1
        roots = components(verified_links(rows, stored(candidate_pairs(signed), "candidates"), plain, similar))
        last = stored(stray_links(rows, signed, roots, plain, similar), "strays")
    links = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(last)
    bits = prints.groupBy("node").agg(F.first("bits").alias("bits"))
    own, other = (bits.select(F.col("node").alias(c), F.col("bits").alias(f"{c}_bits")) for c in ("a", "b"))
    return links.join(own, "a").join(other, "b").where("a_bits != b_bits").select(F.col("a_bits").alias("a"), F.col("b_bits").alias("b"))


def _text(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited text, their likeness, and the class of near documents.

    A chain of documents makes a class, each within radius 3 of another or sharing SIMILAR of its distinct shingles.
    """
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = fingerprint_edits(docs)
    links = near_links(rows).unionAll(copy_links(docs, rows))
    classes = components(links).select(F.col("node").alias("bits"), F.col("root").alias("near_class"))
    like = lambda other: 1.0 - F.bit_count(F.col("bits").bitwiseXOR(F.col(other))) / F.lit(float(BITS))
    joined = rows.join(classes, "bits", "left")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _text(F.col("bits")).alias("fingerprint"),
        _text(F.col("edited_bits")).alias("edited_fingerprint"),
        like("edited_bits").alias("near_edited"),
        like("next_bits").alias("near_next"),
        _text(F.coalesce("near_class", "bits")).alias("near_class"),
    )
