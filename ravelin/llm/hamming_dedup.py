"""SimHash near-duplicates by multi-index hashing: Hamming balls within segments, table matches, complete distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import arrow_batches, slices, stored, table
from ravelin.llm.components import components
from ravelin.session import broadcast_if_small

WIDTH, SEED, RADIUS = 3, 42, 3
#: Widths of the segments, from the first table to the last: two halves, of a crowded bucket's other half two quarters,
#: and of a crowded quarter's other quarter two octets.
SEGMENTS = (32, 16, 8)
#: Distinct fingerprints of a bucket that are compared in one place; a bucket with more is indexed again by the next segments.
CROWDED = 4_096
#: Fingerprints of a bucket compared at a time.
TILE = 512

_BITS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACES = 256 * np.arange(8)


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of every shingle of the text's words, ASCII letters in lower case."""
    words = text.lower().split()  # of bytes: blanks 09 to 0D and 20, letters A to Z only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WIDTH:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[: -WIDTH] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[WIDTH - 1 :].tolist(), strict=True)], dtype=np.uint64)


def fingerprint(text: bytes) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; zero without words."""
    hashes = shingle_hashes(text)
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + _PLACES).ravel(), minlength=2_048).reshape(8, 256) @ _BITS_OF
    return int.from_bytes(np.packbits((2 * counts > len(hashes)).ravel()).tobytes(), "big")


_PRINTS = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = [fingerprint(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
        yield arrow_batches({"doc_id": part.column("doc_id"), "bits": np.array(found, dtype=np.uint64).astype(np.int64)}, _PRINTS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits) of every row's whole text; null text counts as empty, bits are signed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_print, "doc_id long, bits long")


def _ball(own: Column, rest: Column, path: Column, width: int) -> Column:
    """(key, free) for the segment `own` and for it with each set bit cleared."""
    flags = F.array(*(F.lit(1 << k).cast("long") for k in range(width)))
    cleared = F.transform(F.filter(flags, lambda f: own.bitwiseAND(f) != 0), lambda f: own - f)
    return F.transform(F.concat(F.array(own), cleared), lambda b: F.struct((path + b).alias("key"), rest.alias("free")))


def _spread(rows: DataFrame, width: int) -> DataFrame:
    """Every row once for each key of its two segments of `width` bits: the segment itself, and with one set bit cleared.

    Two segments that differ in one bit at most share the key of the one without that bit, so this half of the ball of
    radius 1 is enough. `free` holds the bits that no key has taken yet.
    """
    mask, path = F.lit((1 << width) - 1).cast("long"), F.shiftleft("key", width + 1)
    high, low = F.shiftrightunsigned("free", width).bitwiseAND(mask), F.col("free").bitwiseAND(mask)
    return rows.select("bits", F.inline(F.concat(_ball(high, low, path, width), _ball(low, high, path + F.lit(1 << width).cast("long"), width))))


def _forest(members: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that join all members that a chain of links within the radius joins: each to the one that first reaches it."""
    left, right, rest = [], [], members
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            some, front = front[:TILE], front[TILE:]
            kept = []
            for at in range(0, len(rest), TILE):
                tile = rest[at : at + TILE]
                near = np.bitwise_count(some[:, None] ^ tile[None, :]) <= radius  # of unsigned numbers, as signed ones lose their sign
                reached = near.any(axis=0)
                left += some[near[:, reached].argmax(axis=0)].tolist()
                right += tile[reached].tolist()
                front = np.concatenate([front, tile[reached]])
                kept.append(tile[~reached])
            rest = np.concatenate(kept)
    return left, right


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(radius: int):
    """Links within each bucket; rows come sorted by key, and a bucket may go on in the next batch."""

    def links(keys: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        sizes = np.diff(edges)
        pairs = edges[:-1][sizes == 2]
        a, b = bits[pairs], bits[pairs + 1]
        near = (np.bitwise_count(a ^ b) <= radius) & (a != b)
        left, right = a[near].tolist(), b[near].tolist()
        for k in np.flatnonzero(sizes > 2).tolist():
            some = _forest(np.unique(bits[edges[k] : edges[k + 1]]), radius)
            left += some[0]
            right += some[1]
        return arrow_batches({c: np.array(x, np.uint64).astype(np.int64) for c, x in (("a", left), ("b", right))}, _LINKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bits = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            bits = np.concatenate([bits, batch.column("bits").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])  # keys are ascending
            if last:
                yield links(keys[:last], bits[:last])
                keys, bits = keys[last:], bits[last:]
        if len(keys):
            yield links(keys, bits)

    return run


def _matched(rows: DataFrame, radius: int) -> DataFrame:
    return rows.select("key", "bits").repartition("key").sortWithinPartitions("key").mapInArrow(_verify(radius), "a long, b long")


def near_links(bits: DataFrame, crowded: int = CROWDED, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all fingerprints (`bits`) within `radius` (3 at most) of each other, directly or in a chain.

    Of two fingerprints within 3 bits one half differs in one bit at most, so both enter a common bucket of that half's
    table. Buckets are counted first. One with more than `crowded` fingerprints is indexed again by the quarters of its
    other half, then by octets, by the same argument: no bucket is cut and no link is lost, and a fingerprint has a
    bounded number of keys whatever the size of its group. A bucket of n gives n - 1 links at most.
    """
    rows = bits.where("bits is not null").select("bits").distinct().select("bits", F.lit(0).cast("long").alias("key"), F.col("bits").alias("free"))
    links = None
    for width in SEGMENTS:
        rows = _spread(rows, width)
        full = None
        if width != SEGMENTS[-1]:
            full = broadcast_if_small(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("key"))
            full = full if full.head(1) else None
        found = _matched(rows if full is None else rows.join(full, "key", "left_anti"), radius)
        links = found if links is None else links.unionAll(found)
        if full is None:
            return links
        rows = rows.join(full, "key", "left_semi")
    return links


def near_components(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, bits, component_id) of every row: component_id is the least doc_id that links within RADIUS reach.

    Words are runs of anything but blanks (20, 09 to 0D); shingles have three words, a shorter text is one shingle, and a
    text without words (null and empty ones too) has fingerprint zero, which is linked like any other. Equal fingerprints
    are one node from the start, so groups of copies of any size cost one. Rows without doc_id take part; a component's id
    is null only where all its ids are. Repeated rows stay repeated, other columns are left out, long texts are read
    whole, and an empty table gives no rows.
    """
    prints = stored(fingerprints(docs), "near-prints")
    first = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "near-firsts")
    roots = components(near_links(first, crowded)).select(F.col("node").alias("bits"), "root")
    placed = stored(first.join(roots, "bits", "left").select("bits", "first_id", F.coalesce("root", "bits").alias("root")), "near-roots")
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(placed.join(least, "root").select("bits", "component_id"), "bits").select("doc_id", "bits", "component_id")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_components(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
