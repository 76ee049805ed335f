"""Text expressions. All of them work inside one row, so none of them shuffles."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Task functions travel by value, so executors need Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The splitting patterns every stored table and query must share.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
WORD_BREAK = r"[ \t\n\r\f]+"
SENTENCE_BREAK = r"[.!?]+[ \t\n\r\f]+"
WORD = r"[^ \t\n\r\f]+"
BLANKS = " \t\n\r\f"


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def spaced_tokens(text: Column) -> Column:
    """The tokens in one string, a space between two."""
    return F.regexp_replace(F.lower(text), TOKEN_BREAK, " ")


def spaced_where_needed(text: Column) -> Column:
    """ASCII texts as they are, which `word_counts` splits itself; others as `spaced_tokens`."""
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(spaced_tokens(text))


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def sentences(text: Column) -> Column:
    trimmed = F.transform(F.split(text, SENTENCE_BREAK), lambda s: F.btrim(s, F.lit(BLANKS)))
    return F.filter(trimmed, lambda s: s != "")


def summary(text: Column, chars: int = 300) -> Column:
    return F.translate(F.substring(text, 1, chars), "\n", " ")


def word_window_spans(word_list: Column, size: int, overlap: int) -> Column:
    """Texts of consecutive windows of `size` words sharing `overlap` words, until the end is covered."""
    if not 0 <= overlap < size:
        raise ValueError(f"overlap {overlap} must be at least 0 and below the window size {size}")
    step = size - overlap
    count = F.size(word_list)
    last = F.greatest(F.lit(0), F.ceil((count - size) / F.lit(step))).cast("int")
    starts = F.sequence(F.lit(0), last)
    texts = F.transform(starts, lambda i: F.array_join(F.slice(word_list, i * step + 1, F.lit(size)), " "))
    return F.when(count > 0, texts).otherwise(F.array().cast("array<string>"))


def pack_sentences(text: str, size: int, overlap: int) -> list[str]:
    """Greedy packing of whole sentences into chunks of at most `size` words; a longer sentence is cut first.

    Each chunk begins with the longest tail of the one before that has at most `overlap` words, where that fits.
    """
    pieces, counts = [], []
    for sentence in re.split(SENTENCE_BREAK, text):
        found = re.findall(WORD, sentence)
        for at in range(0, len(found), size):
            part = found[at : at + size]
            pieces.append(" ".join(part))
            counts.append(len(part))
    chunks, first, total = [], 0, 0
    for at, n in enumerate(counts):
        if total + n > size:
            chunks.append(" ".join(pieces[first:at]))
            tail, held = at, 0
            while tail > first and held + counts[tail - 1] <= overlap:
                tail -= 1
                held += counts[tail]
            first, total = (tail, held) if held + n <= size else (at, 0)
        total += n
    return [*chunks, " ".join(pieces[first:])] if pieces else []


def packed_chunks(text: Column, size: int, overlap: int) -> Column:
    """The chunks of each text by `pack_sentences`; a null text has none."""
    if size < 1:
        raise ValueError(f"chunks of {size} words")

    @F.arrow_udf("array<string>")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [pack_sentences((t or b"").decode(errors="replace"), size, overlap) for t in texts.cast(pa.binary()).to_pylist()]
            yield pa.array(found, pa.list_(pa.string()))

    return packed(text)
