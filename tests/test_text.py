import pytest
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ravelin.functions import text as tx
from ravelin.functions.embedders import HashEmbedder, ModelEmbedder, Normalized, embed
from ravelin.operators import transforms
from tests.conftest import rows


def packed(text: str, size: int, overlap: int) -> list[str]:
    """Chunk packing by the book, one document at a time."""
    split = [s.strip(" \t\n\r\f") for s in re.split(r"[.!?]+[ \t\n\r\f]+", text)]
    pieces = []
    for sentence in filter(None, split):
        words = [w for w in re.split(r"[ \t\n\r\f]+", sentence) if w]
        pieces += [words[i : i + size] for i in range(0, len(words), size)]
    chunks, held = [], []
    for piece in pieces:
        if sum(map(len, held)) + len(piece) > size:
            chunks.append(held)
            tail = []
            for old in reversed(held):
                if sum(map(len, tail)) + len(old) > overlap:
                    break
                tail.insert(0, old)
            held = tail if sum(map(len, tail)) + len(piece) <= size else []
        held = [*held, piece]
    return [" ".join(" ".join(p) for p in c) for c in [*chunks, held] if c]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a b. ", "c d e f g h i j! ", "k ", "l m?\n", ". "]), max_size=30).map("".join), min_size=1, max_size=20))
def test_sentence_chunks_match_the_definition(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows(transforms.sentence_chunks(docs, 6, 3).select("doc_id", "seq", "text"), "doc_id", "seq")
    want = [(i, n, c) for i, t in enumerate(texts) for n, c in enumerate(packed(t, 6, 3))]
    assert got == want


def test_word_windows_cover_the_end(spark):
    docs = spark.createDataFrame([("x", " ".join("abcdefghij")), ("one", "a"), ("none", " ")], "doc_id string, text string")
    got = rows(transforms.word_windows(docs, 4, 1).select("chunk_id", "text"), "chunk_id")
    assert got == [("one#0", "a"), ("x#0", "a b c d"), ("x#1", "d e f g"), ("x#2", "g h i j")]


def test_sentence_windows(spark):
    docs = spark.createDataFrame([("x", "A. B! C? D. E")], "doc_id string, text string")
    got = rows(transforms.sentence_windows(docs, 1).select("original_text", "window"), "seq")
    assert got == [("A", "A B"), ("B", "A B C"), ("C", "B C D"), ("D", "C D E"), ("E", "D E")]


def test_summary_cuts_then_replaces(spark):
    df = spark.createDataFrame([("ab\ncd",)], "text string").select(tx.summary(F.col("text"), 3))
    assert df.first()[0] == "ab "


def test_replicas_keep_metadata(spark):
    docs = spark.createDataFrame([("x", "t", {"a": "1"}), ("y", "u", {"b": "2"})], "doc_id string, text string, metadata map<string,string>")
    got = rows(transforms.replicate(docs, 3), "doc_id")
    assert len(got) == 6 and len({r[0] for r in got}) == 6
    assert got[0] == ("x#0", "t", {"a": "1"})


def test_batches_of_three(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "pos int")
    sizes = transforms.batch_rows(df, 3, ["pos"]).groupBy("batch").count()
    assert rows(sizes, "batch") == [(0, 3), (1, 3), (2, 1)]


def test_row_to_document(spark):
    df = spark.createDataFrame([(1, "acme", "first", "body")], "id long, tenant_id string, title string, body string")
    assert rows(transforms.row_to_document(df)) == [("pg-1", "first\n\nbody", "acme", "first", "postgres")]


def test_hash_embedder_unit_or_zero(spark):
    df = embed(spark.createDataFrame([("a b a",), ("",), (None,)], "text string"), embedder=HashEmbedder(16))
    for text, vector in rows(df.select("text", "embedding")):
        length = sum(x * x for x in vector)
        assert len(vector) == 16 and abs(length - (1 if text else 0)) < 1e-6


def test_model_embedder_loads_in_the_task_and_normalizes(spark):
    def load():
        return lambda texts: [[float(len(t)), 0.0] for t in texts]

    df = embed(spark.createDataFrame([("abc",)], "text string"), embedder=Normalized(ModelEmbedder("len", 2, load)))
    assert rows(df.select("embedding")) == [([1.0, 0.0],)]


def test_model_embedder_hands_over_at_most_a_batch(spark):
    def load():
        def model(texts):
            return [[float(len(texts)), float(text)] for text in texts]

        return model

    texts = spark.range(0, 10, 1, 1).selectExpr("cast(id as string) as text")
    got = rows(embed(texts, embedder=ModelEmbedder("count", 2, load, batch=4)).select("embedding"))
    assert [v for (v,) in got] == [[4.0 if i < 8 else 2.0, float(i)] for i in range(10)]
    assert embed(texts.where("text > 'z'"), embedder=ModelEmbedder("count", 2, load)).count() == 0
    with pytest.raises(ValueError):
        embed(texts, embedder=ModelEmbedder("count", 2, load, batch=0))


def test_hash_embedder_counts_words_by_batch(spark):
    """Words are counted for many texts at once, not bucket by bucket in every row; the vectors are those of single words."""
    import hashlib
    import math

    import numpy as np

    texts = ["a b a", "...", "", None, " Ünï, ΣΑΣ½x!", "no 1 no 2 no"] + [f"w{i} w{i % 7}" for i in range(5000)]
    words = [["a", "b", "a"], [], [], [], ["ünï", "σας½x"], ["no", "1", "no", "2", "no"]] + [[f"w{i}", f"w{i % 7}"] for i in range(5000)]
    df = embed(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), embedder=HashEmbedder(16))
    assert "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()
    for (vector,), own in zip(rows(df.select("embedding", "id").orderBy("id").select("embedding")), words, strict=True):
        counts = [0] * 16
        for word in own:
            counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
        length = math.sqrt(sum(c * c for c in counts)) or 1.0
        assert vector == [float(np.float32(c / length)) for c in counts]


def test_words_are_counted_a_bounded_number_of_bytes_at_a_time(monkeypatch):
    """what is held at once does not grow with the texts of a batch, and slices of an array count alike."""
    import pyarrow as pa

    from ravelin.functions import embedders, word_counts

    texts = pa.array(["skip", "Ab, ab c", None, "", "x" * 50, "é1 É", "c"]).slice(1)
    monkeypatch.setattr(word_counts, "COUNT_BYTES", 10)
    runs = list(word_counts.byte_slices(texts))
    assert runs == [(0, 3), (3, 4), (4, 6)]
    assert embedders.hashed_counts(texts, 8).tolist() == [r for a, b in runs for r in embedders.hashed_counts(texts.slice(a, b - a), 8).tolist()]
    assert embedders.hashed_counts(texts, 8).sum(axis=1).tolist() == [3, 0, 0, 1, 2, 1]


def test_embedding_and_term_counts_split_by_spark_where_texts_are_not_ascii(spark):
    from ravelin.operators.terms import term_counts

    texts = ["".join(f"A{chr(c)}b {chr(c)}" for c in range(at, at + 64)) for at in range(0, 0x500, 64)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(tx.tokens(F.col("text")).alias("words"), term_counts(F.col("text")).alias("c")).collect()
    for words, counted in got:
        assert counted["length"] == len(words)
        assert {t["term"]: t["tf"] for t in counted["terms"]} == {w: words.count(w) for w in words}


def test_sentences_are_packed_by_batch(spark):
    """the chunks of a text come from one pass over its words, not from a fold of expressions."""
    docs = spark.createDataFrame([(1, None), (2, " \n"), (3, "a b. c\xa0d! e\x0bf")], "doc_id int, text string")
    chunks = transforms.sentence_chunks(docs, 3, 1)
    assert "ArrowEvalPython" in chunks._jdf.queryExecution().executedPlan().toString()
    assert rows(chunks.select("chunk_id", "text")) == [("3#0", "a b c\xa0d"), ("3#1", "c\xa0d e\x0bf")]
