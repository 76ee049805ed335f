"""Knowledge graph as tables: triples, entities, edges, bounded walks, graph retrieval."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ravelin.functions.embedders import Embedder, embed
from ravelin.functions.text import tokens
from ravelin.operators.nearest import search
from ravelin.session import broadcast_if_small, checkpointed

MENTIONS = "MENTIONS"
NAME = r"[\p{L}\p{N}#_]+"


@dataclass(frozen=True)
class Graph:
    entities: DataFrame  # name
    chunks: DataFrame  # chunk_id, text
    edges: DataFrame  # src, rel, dst, kind ('relation' between entities, 'mention' from chunk to entity)
    sources: DataFrame  # chunk_id, src, rel, dst: the chunks each relation was read from


def _stated(text: Column, phrase: str, order: int, relation: str) -> Column:
    """Triples of one phrase with their place in the text: what ends a piece before the phrase and begins the one after.

    Pieces are shared by the phrases on both sides of them, so "a of b of c" gives both triples.
    """
    middle = f" {phrase} "

    def triples(pieces: Column) -> Column:
        ends = F.aggregate(
            pieces, F.array(F.lit(0)), lambda at, piece: F.array_append(at, F.element_at(at, -1) + F.length(piece) + len(middle))
        )
        return F.transform(F.array(ends), lambda at: F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: F.struct(
            (F.get(at, i) - len(middle)).alias("at"),
            F.lit(order).alias("order"),
            F.regexp_extract(F.get(pieces, i - 1), rf"{NAME}\z", 0).alias("src"),
            F.lit(relation).alias("rel"),
            F.regexp_extract(F.get(pieces, i), rf"\A{NAME}", 0).alias("dst"),
        )))[0]

    split = F.split(text, rf"\Q{middle}\E", -1)
    found = F.when(F.contains(text, F.lit(middle)), F.transform(F.array(split), triples)[0])
    return F.filter(F.coalesce(found, F.array()), lambda t: (t["src"] != "") & (t["dst"] != ""))


def extract_triples(chunks: DataFrame, phrases: Mapping[str, str], max_per_chunk: int | None = 12) -> DataFrame:
    """Rule-based triples `<name> <phrase> <name>`; of each chunk the first ones in the text, or all if the cap is None."""
    found = F.concat(*(_stated(F.col("text"), phrase, n, relation) for n, (phrase, relation) in enumerate(phrases.items())))
    if max_per_chunk is not None:
        found = F.slice(F.sort_array(found), 1, max_per_chunk)
    return chunks.select("chunk_id", F.inline(found)).select("chunk_id", "src", "rel", "dst")


def extract_triples_with(
    chunks: DataFrame, extractor: Callable[[str], list[tuple[str, str, str]]], max_per_chunk: int | None = 12
) -> DataFrame:
    """Triples of a user model, the first `max_per_chunk` of each chunk, or all if the cap is None."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (cid, *triple) for cid, text in zip(batch["chunk_id"], batch["text"]) for triple in extractor(text)[:max_per_chunk]
            ]
            yield pd.DataFrame(rows, columns=["chunk_id", "src", "rel", "dst"])

    return chunks.select("chunk_id", "text").mapInPandas(run, "chunk_id string, src string, rel string, dst string")


def build_graph(triples: DataFrame, chunks: DataFrame) -> Graph:
    triples = checkpointed(triples)  # the extractor runs once, whatever is derived from its triples
    ends = triples.select("chunk_id", F.explode(F.array("src", "dst")).alias("name"))
    relations = triples.select("src", "rel", "dst").distinct().withColumn("kind", F.lit("relation"))
    mentions = ends.distinct().select(
        F.col("chunk_id").cast("string").alias("src"), F.lit(MENTIONS).alias("rel"), F.col("name").alias("dst"), F.lit("mention").alias("kind")
    )
    return Graph(ends.select("name").distinct(), chunks.select("chunk_id", "text"), relations.unionByName(mentions), triples.distinct())


PARTS = ("entities", "chunks", "edges", "sources")


def save_graph(graph: Graph, path: str) -> Graph:
    """Store a graph in a folder that does not exist yet, and return it as read back."""
    for part in PARTS:
        getattr(graph, part).write.parquet(f"{path}/{part}")
    return open_graph(graph.entities.sparkSession, path)


def open_graph(spark: SparkSession, path: str) -> Graph:
    return Graph(*(spark.read.parquet(f"{path}/{part}") for part in PARTS))


def graph_stats(graph: Graph) -> DataFrame:
    counted = (
        graph.entities.select(F.lit("entity").alias("what"))
        .unionByName(graph.chunks.select(F.lit("chunk").alias("what")))
        .unionByName(graph.edges.select(F.lit("edge").alias("what")))
    )
    return counted.agg(
        F.count_if(F.col("what") != "edge").alias("nodes"),
        F.count_if(F.col("what") == "edge").alias("relationships"),
        F.count_if(F.col("what") == "entity").alias("entities"),
    )


def list_triples(graph: Graph, limit: int = 60) -> DataFrame:
    facts = graph.edges.where(F.col("kind") == "relation").select("src", "rel", "dst")
    return facts.orderBy("src", "rel", "dst").limit(limit)


def entity_index(graph: Graph, embedder: Embedder | None = None) -> DataFrame:
    return embed(graph.entities, "name", embedder)


def vector_seeds(queries: DataFrame, entities: DataFrame, k: int = 4, **layout) -> DataFrame:
    """The `k` entities nearest each question."""
    return search(queries, entities, k, item_id="name", **layout)


def keyword_seeds(queries: DataFrame, entities: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Entities named in the question, or meant by a synonym: names of any number of words, in any case.

    Names and questions are compared as runs of letter and digit words, so "middle east" names MIDDLE_EAST. A name inside
    a longer one found at the same place is passed over. Names without a letter or digit are never found. A question's
    words first meet the first words of names, which tell how many words to take; those runs then meet whole names.
    """
    named = entities.select("name", tokens(F.col("name")).alias("_run")).where(F.size("_run") > 0)
    if synonyms is not None:
        meant = synonyms.select(tokens(F.col("keyword")).alias("_said"), tokens(F.col("synonym")).alias("_run"))
        meant = meant.where(F.size("_said") > 0).distinct()
        named = named.unionByName(meant.join(named, "_run").select("name", F.col("_said").alias("_run"))).distinct()
    lengths = named.groupBy(F.get("_run", 0).alias("_word")).agg(F.collect_set(F.size("_run")).alias("_lengths"))
    asked = queries.select("query_id", tokens(F.col("text")).alias("_words")).withColumn("_text", F.xxhash64("_words"))
    words = asked.select("query_id", "_text", F.posexplode("_words").alias("_at", "_word"))
    starts = words.join(lengths, "_word").groupBy("query_id", "_text").agg(F.collect_list(F.struct("_at", "_lengths")).alias("_starts"))

    def runs_from(start: Column) -> Column:
        at = start["_at"]
        return F.transform(start["_lengths"], lambda n: F.struct(at.alias("_at"), n.alias("_n"), F.slice("_words", at + 1, n).alias("_run")))

    # Runs are cut inside the question's row, so that its words are not copied to each of its places.
    cut = asked.join(starts, ["query_id", "_text"]).select("query_id", "_text", F.inline(F.flatten(F.transform("_starts", runs_from))))
    found = cut.where(F.size("_run") == F.col("_n")).join(named.select("_run").distinct(), "_run", "left_semi")
    # Runs by start, longest first: one that ends no later than an earlier one lies inside it. A question bounds the window.
    before = Window.partitionBy("query_id", "_text").orderBy("_at", F.desc("_n")).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("_at") + F.col("_n")).over(before), F.lit(0))
    found = found.dropDuplicates(["query_id", "_text", "_at", "_n"])
    widest = found.withColumn("_reach", reach).where(F.col("_at") + F.col("_n") > F.col("_reach"))
    return widest.select("query_id", "_run").distinct().join(named, "_run").select("query_id", "name").distinct()


def walk(seeds: DataFrame, edges: DataFrame, depth: int = 2) -> DataFrame:
    """Relations on simple paths of at most `depth` hops from each query's seeds, with the hop they are first met.

    Edges are followed both ways and mentions are not followed. A relation lies on such a path exactly
    when one of its ends is within depth-1 hops, so each hop keeps only the newly reached entities of
    each query, never the paths themselves.
    """
    relations = edges.where((F.col("kind") == "relation") & (F.col("src") != F.col("dst"))).select("src", "rel", "dst")
    touching = relations.select(
        F.explode(F.array(F.struct(F.col("src").alias("at"), F.col("dst").alias("to")), F.struct(F.col("dst").alias("at"), F.col("src").alias("to")))).alias("e"),
        "src",
        "rel",
        "dst",
    ).select("e.at", "e.to", "src", "rel", "dst")
    reached = checkpointed(seeds.select("query_id", F.col("name").alias("at")).distinct())
    frontier, found = reached, None
    for hop in range(1, depth + 1):
        step = checkpointed(broadcast_if_small(frontier).join(touching, "at"))
        rows = step.select("query_id", "src", "rel", "dst", F.lit(hop).alias("hop"))
        found = rows if found is None else found.unionByName(rows)
        if hop < depth:
            fresh = step.select("query_id", F.col("to").alias("at")).distinct()
            frontier = fresh.join(reached, ["query_id", "at"], "left_anti")
            if hop + 1 < depth:
                frontier = checkpointed(frontier)
                reached = reached.unionByName(frontier)
    return found.groupBy("query_id", "src", "rel", "dst").agg(F.min("hop").alias("hop"))


def graph_retrieve(
    queries: DataFrame,
    graph: Graph,
    *,
    depth: int = 2,
    k: int = 4,
    synonyms: DataFrame | None = None,
    entities: DataFrame | None = None,
    embedder: Embedder | None = None,
) -> DataFrame:
    """Relations reached from vector and keyword seeds, each with the chunks it was read from."""
    index = entities if entities is not None else entity_index(graph, embedder)
    near = vector_seeds(queries, index, k).select("query_id", "name")
    named = keyword_seeds(queries, graph.entities, synonyms)
    paths = walk(near.unionByName(named).distinct(), graph.edges, depth)
    stated = graph.sources.join(graph.chunks, "chunk_id")
    return paths.join(stated, ["src", "rel", "dst"], "left").select("query_id", "src", "rel", "dst", "hop", "chunk_id", "text")


def graph_vs_vector(queries: DataFrame, graph: Graph, chunk_index: DataFrame, *, k: int = 3, **options) -> DataFrame:
    """The same questions by plain chunk search and by the graph, labelled by `method`."""
    plain = search(queries, chunk_index, k).join(graph.chunks, "chunk_id")
    plain = plain.select("query_id", F.lit("vector").alias("method"), "chunk_id", "text")
    through = graph_retrieve(queries, graph, **options).where(F.col("chunk_id").isNotNull())
    return plain.unionByName(through.select("query_id", F.lit("graph").alias("method"), "chunk_id", "text").distinct())
