"""BPE encoding and decoding through a table of distinct words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import arrow_batches, slices, table, temp, texts_of
from ravelin.llm.words import CACHE_WORDS, default_path, encoder, split

#: Neighbouring rows of an input partition share one list of words; a block ends with the slice that reaches these bytes.
BLOCK_BYTES = 24 << 20
SHARDS_PER_PARTITION = 2

_BLOCK, _KIND, _TEXT, _WORDS, _IDS, _ROWS = (temp(x) for x in ("block", "kind", "text", "words", "ids", "rows"))
_LISTED = pa.schema([(_BLOCK, pa.int64()), ("shard", pa.int32()), (_WORDS, pa.binary())])
_PACKED = pa.schema([(_BLOCK, pa.int64()), (_ROWS, pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices with the number of their block: a function of the partition and its rows."""
    block, held = TaskContext.get().partitionId() << 33, 0
    for part in slices(batches):
        yield block, part
        held += part.column(text).nbytes
        if held >= BLOCK_BYTES:
            block, held = block + 1, 0


def _word_lists(shards: int):
    """Distinct words of each block of rows, dealt out by the word's checksum; words hold no white space, so a line each."""

    def listed(block: int, words: set[str], small: zstandard.ZstdCompressor) -> pa.RecordBatch:
        parts: list[list[str]] = [[] for _ in range(shards)]
        for word in words:
            parts[zlib.crc32(word.encode("utf-8", "surrogatepass")) % shards].append(word)
        filled = [k for k, p in enumerate(parts) if p]
        lines = [small.compress("\n".join(sorted(parts[k])).encode("utf-8", "surrogatepass")) for k in filled]
        return arrow_batches({_BLOCK: [block] * len(filled), "shard": filled, _WORDS: lines}, _LISTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, small = None, set(), zstandard.ZstdCompressor()
        for block, part in _blocks(batches, _TEXT):
            if at != block and words:
                yield listed(at, words, small)
                words = set()
            at = block
            for text in texts_of(part, _TEXT):
                words.update(split(text))
        if words:
            yield listed(at, words, small)

    return run


def _pack(text: str):
    """The rows of each slice as one compressed payload, with their block's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for block, part in _blocks(batches, text):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as stream:
                stream.write_batch(part)
            yield arrow_batches({_BLOCK: [block], _ROWS: [sink.getvalue().to_pybytes()]}, _PACKED)

    return run


def _lines(packed: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass").split("\n")


def _encode_shard(path: str):
    """Encode a shard's distinct words once each; answer every list with its words' ids, in the list's order."""

    def run(_key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, ids, small = encoder(path), {}, zstandard.ZstdCompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                words = _lines(batch.column(_WORDS)[row].as_py())
                if len(ids) > CACHE_WORDS:
                    ids.clear()
                new = [w for w in words if w not in ids]
                if new:
                    coder.forget()
                    coder.learn(new)
                    ids.update((w, coder.words[w]) for w in new)
                found = [ids[w] for w in words]
                sizes = np.array([len(f) for f in found], dtype="<u4").tobytes()
                answer = small.compress(sizes + b"".join(found))
                yield pa.RecordBatch.from_arrays([batch.column(_BLOCK).slice(row, 1), batch.column(_WORDS).slice(row, 1), pa.array([answer], pa.binary())], names=[_BLOCK, _WORDS, _IDS])

    return run


def _assemble(path: str, text: str, keep: list[str], out: pa.Schema):
    """Stream blocks, their word lists first, and put every text's ids together by word position."""

    def coded(part: pa.RecordBatch, ids: dict[str, bytes], coder, pieces: np.ndarray) -> pa.RecordBatch:
        ends: dict[str, list] = {f.name: [] for f in out}
        for whole_text in texts_of(part, text):
            try:
                whole = b"".join(map(ids.__getitem__, split(whole_text)))
            except KeyError:  # the rows came in another order than when they were listed
                whole = coder.encode([whole_text])[0]
            numbers = np.frombuffer(whole, "<u2")
            ends["n_tokens"].append(len(numbers))
            ends["ids"].append(numbers.astype("<u4").tobytes())
            ends["decoded"].append(" ".join(pieces[numbers].tolist()))
        return pa.RecordBatch.from_arrays([part.column(k) for k in keep] + [pa.array(ends[f.name], f.type) for f in out], names=[*keep, *(f.name for f in out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, block, ids, whole = encoder(path), None, {}, zstandard.ZstdDecompressor()
        pieces = np.array(coder.pieces, dtype=object)
        for row in (r for part in slices(batches, 1) for r in part.to_pylist()):
            if row[_BLOCK] != block:
                block, ids = row[_BLOCK], {}
            if row[_KIND] == 1:
                for part in pa.ipc.open_stream(row[_ROWS]):
                    yield coded(part, ids, coder, pieces)
                continue
            words, payload = _lines(row[_WORDS]), whole.decompress(row[_IDS])
            sizes, at = np.frombuffer(payload, "<u4", len(words)).tolist(), 4 * len(words)
            for word, size in zip(words, sizes, strict=True):
                ids[word] = payload[at : at + size]
                at += size

    return run


def _prepared(docs: DataFrame, path: str, text: str) -> DataFrame:
    """Packed rows and their word lists with ids, dealt out by block, lists before rows."""
    shards = max(2, SHARDS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lists = docs.select(F.col(f"`{text}`").alias(_TEXT)).mapInArrow(_word_lists(shards), f"{_BLOCK} long, shard int, {_WORDS} binary")
    answers = lists.groupBy("shard").applyInArrow(_encode_shard(path), f"{_BLOCK} long, {_WORDS} binary, {_IDS} binary")
    rows = docs.mapInArrow(_pack(text), f"{_BLOCK} long, {_ROWS} binary")
    both = rows.withColumn(_KIND, F.lit(1)).unionByName(answers.withColumn(_KIND, F.lit(0)), allowMissingColumns=True)
    return both.repartition(_BLOCK).sortWithinPartitions(_BLOCK, _KIND)


def encode_decode(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens`, `ids` (little-endian unsigned 32-bit) and `decoded` of every whole text.

    Every distinct word of a block of rows goes once to the shard that its checksum names; a shard encodes each distinct
    word once (again only where it forgot beyond CACHE_WORDS) and answers with ids in list order; the answers meet the
    block's rows, whose words are replaced by ids by position. Decoding is a lookup of every id in the vocabulary's
    id-to-piece table, which each task holds: a join on the bounded side, done in place. Compressed rows and word lists
    move, never a row for each word, so a frequent word costs a line for each block.

    A null or empty text has no ids and decodes to "". A long text is read whole and ends its block, so a task holds one
    block's words. Repeated rows stay repeated; null ids and other columns pass through; an empty table gives an empty
    one. Columns called n_tokens, ids or decoded are replaced.
    """
    path = path or default_path()
    docs = docs.drop("n_tokens", "ids", "decoded").withColumn(text, F.col(f"`{text}`").cast("string"))
    both = _prepared(docs, path, text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
    return both.mapInArrow(_assemble(path, text, docs.columns, out), f"{schema}, n_tokens long, ids binary, decoded string")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    coded = encode_decode(table(spark, folder, "documents").select("doc_id", "text"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
