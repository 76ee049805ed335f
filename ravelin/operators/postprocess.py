"""Steps applied to retrieved hits. A step is a function from hits to hits; inputs are never changed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ravelin.functions.text import tokens
from ravelin.functions.vectors import SCORE_DIGITS
from ravelin.operators.membership import sifted
from ravelin.operators.nearest import ranked
from ravelin.operators.terms import TermIndex, add_terms, counts_of
from ravelin.session import broadcast_if_small, checkpointed, shared_path

Step = Callable[[DataFrame], DataFrame]

# BM25 constants (Robertson & Zaragoza, 2009).
BM25_K1 = 1.2
BM25_B = 0.75


def similarity_cutoff(hits: DataFrame, cutoff: float) -> DataFrame:
    return hits.where(F.col("score") >= cutoff)


def best_score(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Each question's highest score; 0 where it has no hit or no score."""
    best = hits.groupBy("query_id").agg(F.max(F.coalesce("score", F.lit(0.0))).alias("score"))
    return queries.select("query_id").join(best, "query_id", "left").select("query_id", F.coalesce("score", F.lit(0.0)).alias("score"))


def long_context_reorder(hits: DataFrame) -> DataFrame:
    """Best hits at both ends: odd ranks count in from the front, even ranks from the back (column `pos`)."""
    per_query = Window.partitionBy("query_id")
    r = F.row_number().over(per_query.orderBy(F.desc("score"), F.asc("chunk_id")))
    placed = hits.withColumns({"_r": r, "_n": F.count("*").over(per_query)})
    front = ((F.col("_r") + 1) / 2).cast("int")
    back = (F.col("_n") + 1 - F.col("_r") / 2).cast("int")
    return placed.withColumn("pos", F.when(F.col("_r") % 2 == 1, front).otherwise(back)).drop("_r", "_n")


def window_replace(hits: DataFrame, sentences: DataFrame) -> DataFrame:
    """Each hit's text becomes its stored window; a hit without one keeps its text."""
    wanted = broadcast_if_small(hits.select("chunk_id").distinct())
    windows = sifted(sentences.select("chunk_id", "window"), wanted, "chunk_id").join(wanted, "chunk_id", "left_semi")
    return hits.join(windows, "chunk_id", "left").withColumn("text", F.coalesce("window", "text")).drop("window")


def keep_top(scored: DataFrame, top_n: int) -> DataFrame:
    return ranked(scored.drop("rank"), top_n, ["query_id"])


def rerank(hits: DataFrame, queries: DataFrame, scorer: Callable[[list[str], list[str]], list[float]], top_n: int = 3, batch: int = 5) -> DataFrame:
    """Score (question, passage) pairs with a user model; its scores replace the old ones and `top_n` are kept."""
    pairs = hits.join(queries.select("query_id", F.col("text").alias("_question")), "query_id")

    @F.pandas_udf("double")
    def pair_score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for question, passage in batches:
            out: list[float] = []
            for at in range(0, len(question), batch):
                out.extend(scorer(question[at : at + batch].tolist(), passage[at : at + batch].tolist()))
            yield pd.Series(out, index=question.index, dtype="float64")

    return keep_top(pairs.withColumn("score", pair_score("_question", "text")).drop("_question"), top_n)


def bm25_rerank(hits: DataFrame, queries: DataFrame, corpus: DataFrame | TermIndex, top_n: int = 3) -> DataFrame:
    """Model-free reranker: BM25 of each pooled passage under corpus-wide statistics.

    `corpus` is a stored term index, or chunks (chunk_id, text) that are read once to make one in the shared folder.
    Of the index only the frequencies of the questions' words and the rows of pooled passages are used. Only the ids of
    the hits are stored here, never their texts, so the hits are read twice: `with_text` stores the search behind them.
    """
    pairs = checkpointed(hits.select("query_id", "chunk_id"))
    index = corpus if isinstance(corpus, TermIndex) else add_terms(corpus, shared_path(hits.sparkSession, "terms"))
    terms = checkpointed(queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term")))
    df = index.frequencies.join(broadcast_if_small(terms.select("term").distinct()), "term", "left_semi")
    idf = df.select("term", F.log(1 + (F.lit(index.docs) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    weighted = terms.join(broadcast_if_small(idf), "term")
    damp = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.lit(index.mean_length))
    scored = (
        pairs.join(weighted, "query_id")
        .join(counts_of(index, pairs), ["chunk_id", "term"])
        .groupBy("query_id", "chunk_id")
        .agg(F.sum(F.col("idf") * F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + damp)).alias("_bm25"))
    )
    replaced = hits.drop("score").join(scored, ["query_id", "chunk_id"], "left")
    return keep_top(
        replaced.withColumn("score", F.round(F.coalesce("_bm25", F.lit(0.0)), SCORE_DIGITS)).drop("_bm25"), top_n
    )


def as_cutoff(cutoff: float) -> Step:
    """A cutoff step that `apply_chain` can recognise."""

    def step(hits: DataFrame) -> DataFrame:
        return similarity_cutoff(hits, cutoff)

    step.needs_similarity = True
    return step


def as_rerank(run: Step) -> Step:
    """Mark a step that replaces similarity scores by scores of another scale."""

    def step(hits: DataFrame) -> DataFrame:
        return run(hits)

    step.replaces_score = True
    return step


def apply_chain(hits: DataFrame, steps: list[Step]) -> DataFrame:
    """Run the steps from left to right; a cutoff after a rescoring step is refused."""
    rescored = False
    for step in steps:
        if rescored and getattr(step, "needs_similarity", False):
            raise ValueError("similarity cutoff after a reranker would compare scores of another scale")
        rescored = rescored or getattr(step, "replaces_score", False)
        hits = hits.transform(step)
    return hits


def compare_chains(
    pool: DataFrame, window_hits: DataFrame, sentences: DataFrame, reranker: Step, cutoff: float = 0.3, texts: DataFrame | None = None
) -> DataFrame:
    """Five labelled chains over one stored pool and one sentence-window search (columns `chain`, `pos`).

    With `texts` (chunk_id, text), where the pool's texts come from, only ids and scores of the pool are stored and placed;
    the texts are joined once to the rows of all chains. The reranker sees texts but must not change them then, and the
    pool is read twice: `with_text` stores the search behind it.
    """
    bare = (lambda df: df) if texts is None else (lambda df: df.drop("text"))
    stored = checkpointed(bare(pool))
    kept = checkpointed(bare(apply_chain(stored if texts is None else pool, [as_cutoff(cutoff), as_rerank(reranker)])))
    by_rank = lambda df: df.withColumn("pos", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")))
    columns = ["query_id", "pos", "chunk_id", "score"]
    pooled = {
        "k=10": by_rank(stored),
        f"cut={cutoff}": by_rank(similarity_cutoff(stored, cutoff)),
        f"cut={cutoff} rescored k=3": by_rank(kept),
        f"cut={cutoff} rescored k=3 ends first": long_context_reorder(kept),
    }
    parts = [df.select(F.lit(label).alias("chain"), *columns, *([] if texts is not None else ["text"])) for label, df in pooled.items()]
    rows = reduce(DataFrame.unionByName, parts)
    if texts is not None:
        rows = _texts_of_copies(rows, texts, stored.select("chunk_id").distinct(), ["chain", "query_id", "chunk_id"])
    windows = by_rank(window_replace(window_hits, sentences))
    return rows.unionByName(windows.select(F.lit("sentence windows k=2").alias("chain"), *columns, "text"))


def _texts_of_copies(rows: DataFrame, texts: DataFrame, ids: DataFrame, same: list[str]) -> DataFrame:
    """The text of each row, all of chunks in `ids`. Of an id that comes several times, rows that agree in `same` get one text after the other."""
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*same).orderBy("pos")))
    wanted = broadcast_if_small(ids)
    found = sifted(texts.select("chunk_id", "text"), wanted, "chunk_id").join(wanted, "chunk_id", "left_semi")
    copies = Window.partitionBy("chunk_id")
    numbered = found.withColumns({"_copy": F.row_number().over(copies.orderBy("text")), "_copies": F.count("*").over(copies)})
    turn = F.pmod(F.col("_r") - 1, F.col("_copies")) + 1 == F.col("_copy")  # one side's columns alone would make it a second join key
    return rows.alias("r").join(numbered.alias("t"), (F.col("r.chunk_id") == F.col("t.chunk_id")) & turn).select("r.*", "t.text").drop("_r")
