"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import slices, table, texts_of

BITS = 18
#: The classifier is fitted on at most this many labelled texts, chosen by a hash of their id, in this many shards whose
#: weights are averaged.
TRAIN_ROWS, SHARDS = 8_000, 4
EPOCHS = 6
THRESHOLD = 0.3
CACHE_WORDS = 400_000

#: Learning rate and regularisation of the follow-the-regularised-leader updates.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4

_RUNS = re.compile(r"([A-ZÀ-ÖØ-Þ])[A-ZÀ-ÖØ-Þ]*|([a-zß-öø-ÿ])[a-zß-öø-ÿ]*|([0-9])[0-9]*|([^\W\d_])[^\W\d_]*|(.)\5*", re.DOTALL)


def _shape(word: str) -> str:
    """The word with every run of capitals, small letters, digits or one sign written once."""
    return _RUNS.sub(lambda m: "X" if m[1] else "x" if m[2] else "9" if m[3] else "l" if m[4] else m[5], word)


class WordHashes(dict):
    """Word to (hash of the word, hash of its shape) in one integer; forgets all beyond a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) << 31 | zlib.crc32(_shape(word).encode("utf-8", "surrogatepass")) >> 1
        self[word] = value
        return value


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


def _mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.uint64(salt)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts, one row of five for each word (the word, the word pair, its shape, the shape pair,
    whether it repeats the word before it), and the number of words of each text."""
    known, codes, sizes = _hashes(), [], []
    for text in texts:
        words = text.split()
        sizes.append(len(words))
        codes.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
    code = np.concatenate(codes) if codes else np.empty(0, np.int64)
    sizes = np.array(sizes, dtype=np.int64)
    word, shape = (code >> 31).astype(np.uint64), (code & 0x7FFFFFFF).astype(np.uint64)
    first = np.zeros(len(code), dtype=bool)
    starts = np.cumsum(sizes) - sizes
    first[starts[sizes > 0]] = True
    before_word, before_shape = np.roll(word, 1), np.roll(shape, 1)
    before_word[first], before_shape[first] = 0, 0
    same = np.where(first, 2, word == before_word).astype(np.uint64)
    zero = np.zeros(1, dtype=np.uint64)
    return np.stack([_mix(word, zero, 1), _mix(word, before_word, 2), _mix(shape, zero, 3), _mix(shape, before_shape, 4), _mix(same, zero, 5)], axis=1).astype(np.int32), sizes


def _train(frame: pd.DataFrame) -> pd.DataFrame:
    """Follow the regularised leader over one shard's texts; returns the weights that are not zero (index -1: the bias)."""
    frame = frame.sort_values(["at", "text"], kind="stable")
    rows, sizes = features(frame["text"].tolist())
    ends = np.cumsum(sizes)
    examples = []
    for end, size, label in zip(ends, sizes, frame["label"], strict=True):
        index, count = np.unique(rows[end - size : end], return_counts=True)
        examples.append((np.append(index, 1 << BITS), np.append(count / max(size, 1), 1.0), float(label)))
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weight(index: np.ndarray) -> np.ndarray:
        at = z[index]
        return np.where(np.abs(at) <= L1, 0.0, (np.sign(at) * L1 - at) / ((BETA + np.sqrt(n[index])) / ALPHA + L2))

    for epoch in range(EPOCHS):
        for k in np.random.Generator(np.random.PCG64(epoch)).permutation(len(examples)):
            index, value, label = examples[k]
            w = weight(index)
            gradient = (1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            step = (np.sqrt(n[index] + gradient**2) - np.sqrt(n[index])) / ALPHA
            z[index] += gradient - step * w
            n[index] += gradient**2
    w = weight(np.arange(len(z)))
    kept = np.flatnonzero(w)
    return pd.DataFrame({"index": np.where(kept == 1 << BITS, -1, kept), "weight": w[kept]})


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, shards: int = SHARDS) -> tuple[np.ndarray, float]:
    """Weights and bias from (doc_id, text, label): a bounded choice of rows, each shard trained on its own, averaged.

    Rows with a null label are left out; without any row the weights are zero and every score is 0.5.
    """
    chosen = labelled.where("label is not null").select(F.xxhash64("doc_id").alias("at"), F.coalesce("text", F.lit("")).alias("text"), "label")
    chosen = chosen.orderBy("at", "text").limit(rows)
    shard = F.pmod(F.col("at"), F.lit(shards))
    parts = chosen.groupBy(shard.alias("shard")).applyInPandas(_train, "index long, weight double")
    summed = parts.groupBy("index").agg(F.sum("weight").alias("weight")).toPandas()  # 2 ** BITS + 1 rows at most
    used = max(1, chosen.select(shard.alias("s")).distinct().count())
    weights = np.zeros(1 << BITS, dtype=np.float32)
    own = summed[summed["index"] >= 0]
    weights[own["index"].to_numpy()] = own["weight"] / used
    return weights, float(summed.loc[summed["index"] < 0, "weight"].sum() / used)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the column `name`: the logistic of the bias and the sparse dot product of weights and n-gram shares.

    An empty or null text has no n-grams and gets the bias alone; a long one is read whole. All other columns and repeated
    rows are kept; a column called `name` is replaced.
    """
    docs = docs.drop(name)
    kept = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model[0])
    bias = model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for part in slices(batches):
            rows, sizes = features(texts_of(part, text))
            sums = np.concatenate([[0.0], np.cumsum(weights[rows].sum(axis=1), dtype=np.float64)])
            ends = np.cumsum(sizes)
            margin = bias + (sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)
            scores = pa.array(1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [scores], names=[*kept, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{name}` double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Train on the labelled documents that are not held out. A document with several labels counts with each."""
    ids = labels.where(~held_out(F.col("doc_id"))).where("quality is not null")
    few = ids.select("doc_id", F.col("quality").alias("label")).orderBy(F.xxhash64("doc_id"), "label").limit(TRAIN_ROWS)
    joined = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # TRAIN_ROWS rows at most
    return train(joined)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, names: tuple[str, str, str] = ("held_out", "score", "predicted")) -> DataFrame:
    """`docs` with held_out, score and predicted (1 where the score reaches the threshold), called by `names`.

    Only the text enters a score, so equal texts tie. Null ids are not held out and are scored like others; long texts are
    read whole; empty tables work: without labels every score is 0.5. Columns called like the results are replaced.
    """
    held, value, verdict = names
    scored = score(docs.drop(*names), fit(docs, labels), name=value)
    return scored.withColumns({held: held_out(F.col("doc_id")), verdict: (F.col(value) >= threshold).cast("int")})


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return classify(docs, table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted")
