"""Packing along a space-filling curve: neighbouring documents share sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import arrow_batches, slices, stored, table, temp, texts_of
from ravelin.llm.words import default_path, encoder

SEQUENCE = 4_096
END_ID = 2
DIMENSIONS, BITS = 4, 12

_KEY, _TIE, _IDS = temp("key"), temp("tie"), temp("ids")


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (rows of coordinates below 2 ** bits) along the Hilbert curve; at most 63 bits in all.

    The transposed form: undo the curve's turns from the highest bit down, take the Gray code, interleave the bits.
    """
    x = points.T.astype(np.int64)
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def projection(size: int, dimensions: int = DIMENSIONS, seed: int = 17) -> np.ndarray:
    """A fixed random direction for each of `size` hashed features."""
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((size, dimensions)).astype(np.float32)


def curve_keys(ids: list[np.ndarray], directions: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of documents given as feature lists: project the count vector, scale it, put it on the grid."""
    sums = np.array([directions[x].sum(axis=0) / max(1.0, len(x)) ** 0.5 for x in ids], dtype=np.float64).reshape(len(ids), directions.shape[1])
    spread = 0.5 + 0.5 * sums / (1.0 + np.abs(sums))
    return hilbert_keys(np.minimum((spread * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def _encode(path: str, end_id: int):
    out = pa.schema([("doc_id", pa.int64()), (_KEY, pa.int64()), (_TIE, pa.int64()), (_IDS, pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        directions, end = projection(len(coder.pieces)), np.array([end_id], dtype="<u2").tobytes()
        for part in slices(batches):
            ids = [x + end for x in coder.encode(texts_of(part))]
            keys = curve_keys([np.frombuffer(x, "<u2") for x in ids], directions)
            yield arrow_batches({"doc_id": part.column("doc_id"), _KEY: keys, _TIE: part.column(_TIE), _IDS: ids}, out)

    return run


def _powers(length: int) -> list[int]:
    """Lengths that cut `length` ids into powers of two."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def _fill(sequence: int):
    out = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        open_pieces: list[tuple] = []  # of the sequence being filled: doc_id, start, doc_tokens, ids
        filled = 0
        done: dict[str, list] = {f.name: [] for f in out}

        def close(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for doc, start, total, ids in pieces:
                for name, value in zip(done, (doc, start, len(ids), total, number, offset, ids.astype("<u4").tobytes()), strict=True):
                    done[name].append(value)
                offset += len(ids)
            number += 1

        for part in slices(batches):
            for doc, raw in zip(part.column("doc_id").to_pylist(), part.column(_IDS).to_pylist(), strict=True):
                ids, at = np.frombuffer(raw, "<u2"), 0
                while at < len(ids):
                    piece = ids[at : at + sequence - filled]
                    open_pieces.append((doc, at, len(ids), piece))
                    at, filled = at + len(piece), filled + len(piece)
                    if filled == sequence:
                        close(open_pieces)
                        open_pieces, filled = [], 0
            if done["doc_id"]:
                yield arrow_batches(done, out)
                done = {f.name: [] for f in out}
        for length in _powers(filled):  # the rest of the partition: sequences of a power of two need no padding
            some, room = [], length
            while room:
                doc, start, total, ids = open_pieces.pop(0)
                some.append((doc, start, total, ids[:room]))
                if len(ids) > room:
                    open_pieces.insert(0, (doc, start + room, total, ids[room:]))
                room -= min(room, len(ids))
            close(some)
        if done["doc_id"]:
            yield arrow_batches(done, out)

    return run


def pack(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of the documents' token sequences (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    Each document's ids and `end_id` are taken as a hashed count vector, projected to four dimensions and given its place
    on a Hilbert curve; the documents are range-sorted by that place (ties by a hash of the row, so that equal texts
    spread over partitions), and each partition cuts its run of ids into full sequences. What is left at the end of a
    partition is cut into sequences of a power of two, so no sequence needs padding. The encoded documents are stored
    once, since sorting samples them first.

    A null or empty text is the end id alone. Repeated and null ids are packed like others; a piece's ids are
    little-endian unsigned 32-bit. Other columns are left out. An empty table gives no pieces.
    """
    path = path or default_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias(_TIE))
    coded = stored(rows.mapInArrow(_encode(path, end_id), f"doc_id long, {_KEY} long, {_TIE} long, {_IDS} binary"), "tokens")
    along = coded.repartitionByRange(_KEY, _TIE, "doc_id").sortWithinPartitions(_KEY, _TIE, "doc_id")
    return along.mapInArrow(_fill(sequence), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into sequences of at most 4096 ids."""
    pieces = pack(table(spark, folder, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
