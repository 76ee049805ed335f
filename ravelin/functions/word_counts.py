"""Words of a batch of texts, counted in numpy. The words are the tokens of `text.tokens`."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Task functions travel by value, so executors need numpy and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of texts whose words are counted at once (a longer text alone); what a task holds does not grow with its texts.
COUNT_BYTES = 4 << 20


def byte_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts with at most `COUNT_BYTES` bytes, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, before = 0, 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, before + COUNT_BYTES, side="right")))
        yield at, end
        at, before = end, int(ends[end - 1])


#: Each byte in lower case, and a space for what is ASCII and no letter or number; other texts come split and in lower case.
SPACED = np.array([ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)] + list(range(128, 256)), np.uint8)


def spaced(texts: pa.Array) -> pa.Array:
    """The texts as bytes, in lower case and with a space for each ASCII character that is no letter or number."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    size = int(ends[-1] - ends[0])
    raw = np.frombuffer(data, np.uint8, size, int(ends[0])) if size else np.empty(0, np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(SPACED[raw])])


def word_table(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words as bytes, and for each word of the texts the row it stands in and its place among them."""
    pieces = pc.split_pattern(spaced(pc.fill_null(texts, "")), b" ")
    flat = pieces.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(texts)), pieces.value_lengths().to_numpy(zero_copy_only=False))
    place = flat.indices.to_numpy(zero_copy_only=False)
    kept = place != pc.index(flat.dictionary, b"").as_py()
    return flat.dictionary, row[kept], place[kept]


def counted_words(texts: pa.Array) -> pa.Array:
    """(length, terms: each distinct word with its count, in the order of their bytes) of each text; nulls where it is null."""
    words, row, place = word_table(texts)
    order = pc.sort_indices(words).to_numpy(zero_copy_only=False)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    size = max(1, len(words))
    pair, tf = np.unique(row * size + rank[place], return_counts=True)
    null = pc.is_null(texts).to_numpy(zero_copy_only=False)
    term = words.take(pa.array(order[pair % size])).cast(pa.string())
    terms = pa.StructArray.from_arrays([term, pa.array(tf.astype(np.int32))], ["term", "tf"])
    ends = np.append(0, np.cumsum(np.bincount(pair // size, minlength=len(texts)))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(null, False)) if len(texts) else pa.array(ends), terms)
    length = pa.array(np.bincount(row, minlength=len(texts)).astype(np.int32), mask=null)
    return pa.StructArray.from_arrays([length, lists], ["length", "terms"])
