import itertools
import random
import re

from ravelin.functions.embedders import embed
from ravelin.operators import graph as kg
from tests.conftest import rows

CHUNKS = [("1", "Ann lives in Oslo. Bob lives in Oslo."), ("2", "Oslo is part of Norway."), ("3", "Nothing here")]
PHRASES = {"lives in": "LIVES_IN", "is part of": "PART_OF"}


def small(spark):
    chunks = spark.createDataFrame(CHUNKS, "chunk_id string, text string")
    return kg.build_graph(kg.extract_triples(chunks, PHRASES), chunks)


def test_graph_tables(spark):
    graph = small(spark)
    assert rows(kg.list_triples(graph)) == [("Ann", "LIVES_IN", "Oslo"), ("Bob", "LIVES_IN", "Oslo"), ("Oslo", "PART_OF", "Norway")]
    assert rows(kg.graph_stats(graph)) == [(4 + 3, 3 + 5, 4)]
    assert len(rows(kg.list_triples(graph, 2))) == 2


def test_extraction_is_capped(spark):
    chunks = spark.createDataFrame([("1", " ".join(f"a{i} lives in b{i}." for i in range(20)))], "chunk_id string, text string")
    assert kg.extract_triples(chunks, PHRASES).count() == 12
    many = lambda text: [("s", "r", str(i)) for i in range(20)]
    assert kg.extract_triples_with(chunks, many, 5).count() == 5


def test_triples_share_names_and_the_cap_follows_the_text(spark):
    text = "ash of birch of cedar with elm of " + " ".join(f"w{i} of v{i}," for i in range(20)) + " oak with pine\n"
    chunks = spark.createDataFrame([("1", text), ("2", None), ("3", ""), ("4", " of , with x of ")], "chunk_id string, text string")
    phrases = {"with": "WITH", "of": "OF"}
    first = kg.extract_triples(chunks, phrases, 4)
    assert rows(first) == [("1", "ash", "OF", "birch"), ("1", "birch", "OF", "cedar"), ("1", "cedar", "WITH", "elm"), ("1", "elm", "OF", "w0")]
    every = kg.extract_triples(chunks, phrases, None)
    assert every.count() == 3 + 1 + 20 + 1 and ("1", "oak", "WITH", "pine") in rows(every)


def simple_paths(edges, seed, depth):
    """Relations on simple paths from `seed`, by listing the paths."""
    found, paths = {}, [(seed, ())]
    for hop in range(1, depth + 1):
        longer = []
        for path in paths:
            at, *_ = path[0:1]
            for s, r, o in edges:
                for a, b in ((s, o), (o, s)):
                    if a == path[0] and b not in path[1] and b != path[0]:
                        found.setdefault((s, r, o), hop)
                        longer.append((b, (*path[1], path[0])))
        paths = longer
    return found


def test_walk_equals_listing_simple_paths(spark):
    edges = [("a", "r", "b"), ("b", "r", "c"), ("c", "r", "d"), ("a", "q", "c"), ("d", "r", "e"), ("b", "s", "a"), ("e", "r", "e"), ("x", "r", "y")]
    frame = spark.createDataFrame([(*e, "relation") for e in edges] + [("1", "MENTIONS", "a", "mention")], "src string, rel string, dst string, kind string")
    seeds = spark.createDataFrame([("q", "a"), ("z", "e")], "query_id string, name string")
    for depth, (query, seed) in itertools.product((1, 2, 3), (("q", "a"), ("z", "e"))):
        got = {r[:3]: r[3] for r in rows(kg.walk(seeds, frame, depth).where(f"query_id = '{query}'").select("src", "rel", "dst", "hop"))}
        assert got == simple_paths(edges, seed, depth)


def test_graph_retrieval_by_keyword_synonym_and_vector(spark):
    graph = small(spark)
    queries = embed(spark.createDataFrame([("q", "who is in norge")], "query_id string, text string"))
    synonyms = spark.createDataFrame([("norge", "Norway")], "keyword string, synonym string")
    assert rows(kg.keyword_seeds(queries, graph.entities, synonyms)) == [("q", "Norway")]
    got = rows(kg.graph_retrieve(queries, graph, depth=2, k=1, synonyms=synonyms).select("src", "dst", "chunk_id").distinct(), "src", "dst")
    assert ("Ann", "Oslo", "1") in got and ("Oslo", "Norway", "2") in got
    index = embed(graph.chunks)
    methods = rows(kg.graph_vs_vector(queries, graph, index, synonyms=synonyms).groupBy("method").count(), "method")
    assert [m for m, _ in methods] == ["graph", "vector"]


def spans_by_hand(text, names):
    """Names whose words stand in the text in a row, but for those inside a longer one."""
    words = lambda s: [w for w in re.split(r"[\W_]+", (s or "").lower()) if w]
    asked, spans = words(text), []
    for name in names:
        run = words(name)
        spans += [(i, i + len(run), name) for i in range(len(asked) - len(run) + 1) if run and asked[i : i + len(run)] == run]
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1] and a[1] - a[0] < b[1] - b[0]
    return {name for *span, name in spans if not any(inside(span, other) for other in spans)}


def test_names_of_several_words_are_found_and_the_longest_wins(spark):
    names = ["New York", "york", "New York City", "MIDDLE_EAST", "Item#7", "east", "##", "", "a b a", "b", "a b a b"]
    texts = ["is new york city in York?", "the Middle-East", "item 7, item#7", "New york", None, "", "a b a b a", "## b"]
    entities = spark.createDataFrame([(n,) for n in names], "name string")
    queries = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "query_id string, text string")
    got = rows(kg.keyword_seeds(queries.unionByName(queries), entities))  # repeated questions change nothing
    assert len(got) == len(set(got))
    assert set(got) == {(str(i), n) for i, t in enumerate(texts) for n in spans_by_hand(t, names)}


def test_names_against_a_plain_search_of_random_words(spark):
    draw = random.Random(3)
    some = lambda low, high: " ".join(draw.choice("abc") for _ in range(draw.randint(low, high)))
    names, texts = sorted({some(1, 4) for _ in range(20)}), [some(0, 12) for _ in range(60)]
    entities = spark.createDataFrame([(n,) for n in names], "name string")
    queries = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "query_id string, text string")
    assert set(rows(kg.keyword_seeds(queries, entities))) == {(str(i), n) for i, t in enumerate(texts) for n in spans_by_hand(t, names)}


def test_synonyms_of_several_words(spark):
    entities = spark.createDataFrame([("New_York",), ("apple",)], "name string")
    synonyms = spark.createDataFrame([("the big apple", "new york"), ("fruit", "apple")], "keyword string, synonym string")
    queries = spark.createDataFrame([("1", "In the Big Apple"), ("2", "a fruit"), ("3", "big apple")], "query_id string, text string")
    assert rows(kg.keyword_seeds(queries, entities, synonyms), "query_id") == [("1", "New_York"), ("2", "apple"), ("3", "apple")]


def test_a_model_without_a_cap_keeps_all_triples(spark):
    chunks = spark.createDataFrame([("1", "x")], "chunk_id string, text string")
    assert kg.extract_triples_with(chunks, lambda text: [("s", "r", str(i)) for i in range(20)], None).count() == 20


def test_a_stored_graph_is_the_same_when_opened(spark, tmp_path):
    graph, path = small(spark), str(tmp_path / "graph")
    kg.save_graph(graph, path)
    opened = kg.open_graph(spark, path)
    for part in kg.PARTS:
        assert sorted(rows(getattr(opened, part))) == sorted(rows(getattr(graph, part)))
    assert rows(kg.graph_stats(opened)) == rows(kg.graph_stats(graph))
