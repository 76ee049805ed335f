import json
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ravelin.functions.embedders import embed
from ravelin.operators import evaluation as ev
from ravelin.operators import membership
from ravelin.operators import postprocess as pp
from ravelin.operators import retrieval, tenancy, transforms
from ravelin.operators.postprocess import bm25_rerank
from ravelin.operators.terms import add_terms, read_terms, term_counts
from tests.conftest import rows


def hits(spark, scores):
    data = [("q", f"c{i}", f"text {i}", s) for i, s in enumerate(scores)]
    return spark.createDataFrame(data, "query_id string, chunk_id string, text string, score double")


def test_cutoff_keeps_input_and_drops_nulls(spark):
    scores = [k / 16 for k in range(-3, 16)]
    pool = hits(spark, [*scores, None])
    for floor in (-0.1, 0.25, 0.26, 2.0):
        kept = rows(pp.similarity_cutoff(pool, floor).select("score"), "score")
        assert [r[0] for r in kept] == [s for s in scores if s >= floor]
    assert pool.count() == len(scores) + 1


@pytest.mark.parametrize("size", range(1, 11))
def test_reorder_puts_the_best_at_the_ends(spark, size):
    scores = [1 - k / 32 for k in range(size)]
    placed = rows(pp.long_context_reorder(hits(spark, scores)).select("pos", "score"), "pos")
    assert [p for p, _ in placed] == list(range(1, size + 1))
    want = []
    for score in reversed(scores):  # from the worst up, each goes outside of those before it, the best in front
        want = [score, *want] if scores.index(score) % 2 == 0 else [*want, score]
    assert [s for _, s in placed] == want


def test_chain_refuses_a_cutoff_after_reranking(spark):
    pool = hits(spark, [0.9, 0.1])
    rescale = pp.as_rerank(lambda h: h.withColumn("score", F.col("score") * 10))
    assert pp.apply_chain(pool, [pp.as_cutoff(0.5), rescale]).count() == 1
    with pytest.raises(ValueError, match="another scale"):
        pp.apply_chain(pool, [rescale, pp.as_cutoff(0.5)])


def test_rerank_replaces_scores_in_batches(spark):
    pool, queries = hits(spark, [0.9, 0.8, 0.7]), spark.createDataFrame([("q", "ask")], "query_id string, text string")
    scorer = lambda qs, ps: [float(p[-1]) for p in ps]
    got = rows(pp.rerank(pool, queries, scorer, 2, batch=2).select("chunk_id", "score", "rank"), "rank")
    assert got == [("c2", 2.0, 1), ("c1", 1.0, 2)]


def test_window_replace_keeps_text_without_window(spark):
    windows = spark.createDataFrame([("c0", "wide")], "chunk_id string, window string")
    got = rows(pp.window_replace(hits(spark, [0.9, 0.8]), windows).select("chunk_id", "text"), "chunk_id")
    assert got == [("c0", "wide"), ("c1", "text 1")]


def test_windows_and_texts_of_other_chunks_are_sifted_out(spark, monkeypatch):
    """What an exact join shuffles follows the hits where they are too many to be broadcast."""
    monkeypatch.setattr(membership, "BROADCAST_ROWS", 0)
    found = hits(spark, [0.9, 0.8]).withColumn("chunk_id", F.concat("chunk_id", F.lit("#0")))
    ids = spark.range(20_000).select(F.concat(F.lit("c"), F.col("id").cast("string"), F.lit("#0")).alias("chunk_id"))
    windows = ids.where("chunk_id <> 'c1#0'").select("chunk_id", F.concat(F.lit("wide "), "chunk_id").alias("window")).unionByName(
        spark.createDataFrame([(None, "none")], "chunk_id string, window string")
    )
    kept = membership.sifted(windows, found.select("chunk_id"), "chunk_id")
    assert {"c0#0"} <= {r[0] for r in rows(kept.select("chunk_id"))} and kept.count() < 2_000
    assert membership.sifted(windows.select(F.lit(1).alias("chunk_id")), spark.range(5).withColumnRenamed("id", "chunk_id"), "chunk_id").count() == 20_000
    swapped = pp.window_replace(found, windows)
    assert rows(swapped.select("chunk_id", "text"), "chunk_id") == [("c0#0", "wide c0#0"), ("c1#0", "text 1")]
    assert "ArrowEvalPython" in swapped._jdf.queryExecution().executedPlan().toString()
    texted = transforms.with_text(found.drop("text"), windows.withColumnRenamed("window", "text"))
    assert rows(texted.select("chunk_id", "text", "score")) == [("c0#0", "wide c0#0", 0.9)]
    assert "ArrowEvalPython" in texted._jdf.queryExecution().executedPlan().toString()


def test_compared_chains_store_no_texts(spark, monkeypatch):
    """A chunk id that comes twice gives both of its texts in every chain, as hits that carry them do."""
    texts = spark.createDataFrame([("a", "one"), ("a", "two"), ("b", "three"), ("c", None)], "chunk_id string, text string")
    found = spark.createDataFrame([("q", "a", 0.9), ("q", "b", 0.5), ("q", "c", 0.1), ("r", "c", 0.7)], "query_id string, chunk_id string, score double")
    pool = transforms.with_text(found, texts)
    wide = spark.createDataFrame([("q", "s", "small", 0.3)], "query_id string, chunk_id string, text string, score double")
    windows = spark.createDataFrame([("s", "wide")], "chunk_id string, window string")
    halved, stored = lambda h: h.withColumn("score", F.col("score") / 2), []
    want = rows(pp.compare_chains(pool, wide, windows, halved, 0.3).select("chain", "query_id", "chunk_id", "score", "text"))
    monkeypatch.setattr(pp, "checkpointed", lambda df, keep=pp.checkpointed: stored.append(df.columns) or keep(df))
    got = pp.compare_chains(pool, wide, windows, halved, 0.3, texts)
    assert len(stored) == 2 and not any("text" in names for names in stored)
    assert Counter(want) == Counter(rows(got.select("chain", "query_id", "chunk_id", "score", "text")))
    assert rows(got.where("chain = 'k=10' and query_id = 'q'").select("pos"), "pos") == [(1,), (2,), (3,), (4,)]


def test_fusion_by_hand(spark):
    lists = spark.createDataFrame([("q", 0, "a", 1), ("q", 0, "b", 2), ("q", 1, "b", 1), ("q", 1, "c", 2)], "query_id string, variant int, chunk_id string, rank int")
    got = rows(retrieval.fuse_rrf(lists, 2).select("chunk_id", "score"), F.desc("score"))
    assert got == [("b", round(1 / 61 + 1 / 62, 10)), ("a", round(1 / 61, 10))]


def test_expansion_keeps_original_and_first_variants(spark):
    queries = spark.createDataFrame([("q", "orig")], "query_id string, text string")
    variants = spark.createDataFrame([("q", i, f"v{i}") for i in range(5)] + [("other", 0, "x")], "query_id string, ord int, text string")
    assert rows(retrieval.expand_queries(queries, variants, 4).select("text"), "variant") == [("orig",), ("v0",), ("v1",), ("v2",)]


def test_recursive_search_stays_inside_chosen_documents(spark):
    docs = spark.createDataFrame([("d1", "cats purr. cats sleep"), ("d2", "dogs bark. dogs run"), ("d3", "rust iron. cats")], "doc_id string, text string")
    chunks = embed(transforms.word_windows(docs, 2, 0))
    queries = embed(spark.createDataFrame([("q", "cats purr sleep")], "query_id string, text string"))
    got = retrieval.recursive_topk(queries, retrieval.summary_index(docs), chunks, 1, 2)
    assert [r[0] for r in rows(got.select("doc_id").distinct())] == ["d1"] and got.count() == 2


def test_scores_of_smoke_sentences(spark):
    docs = spark.createDataFrame([("1", "cosine ignores magnitude"), ("2", "dot product uses magnitude"), ("3", "bread recipes")], "chunk_id string, text string")
    queries = embed(spark.createDataFrame([("q", "which metric ignores magnitude")], "query_id string, text string"))
    got = retrieval.compare_metrics(queries, embed(docs), 2)
    assert rows(got.groupBy("metric").count(), "metric") == [("cosine", 2), ("dot_product", 2), ("euclidean", 2)]


def test_out_of_scope_rates(spark):
    asked = spark.createDataFrame([("a", "x"), ("b", "y")], "query_id string, text string")
    none = spark.createDataFrame([], "query_id string, chunk_id string")
    each = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2")], "query_id string, chunk_id string")
    assert ev.out_of_scope_rate(none, asked).first()[0] == 0.0
    assert ev.out_of_scope_rate(each, asked).first()[0] == 1.0


def test_fact_recall_any_case_and_misses(spark):
    found = spark.createDataFrame([("a", "1", "The THREE", 1), ("a", "2", "stages", 2)], "query_id string, chunk_id string, text string, rank int")
    labels = spark.createDataFrame([("a", "three stages"), ("b", "x")], "query_id string, expected string")
    assert ev.fact_recall(found, labels).first()[0] == 0.5


def test_judged_runs(spark):
    raw = spark.createDataFrame([(" 0.5 ",), ("7",), ("-1",), ("n/a",), ("NaN",), (None,)], "raw_score string")
    assert [r[1] for r in ev.parse_judge_score(raw).collect()] == [0.5, 1.0, 0.0, 0.0, 0.0, 0.0]
    runs = spark.createDataFrame([("a", ["Index", "and GENERATION"]), ("b", ["x"]), ("c", ["x"])], "query_id string, contexts array<string>")
    examples = spark.createDataFrame([("a", "generation"), ("b", "y"), ("c", "")], "query_id string, expected_keyword string")
    assert rows(ev.context_recall(runs, examples), "query_id") == [("a", 1), ("b", 0), ("c", 0)]


def test_run_log_errors_are_counted_not_fatal(spark):
    log = spark.createDataFrame([("m", 0.0, 1.0, True), ("m", 1.0, 5.0, False), ("m", 6.0, 2.0, True), ("bad", 0.0, 1.0, False)], "mode string, started double, latency double, ok boolean")
    assert rows(ev.run_summary(log), "mode") == [("bad", 1.0, 1.0, None, None, 1), ("m", 8.0, 0.38, 1.5, 2.0, 1)]


def test_median_and_speedup(spark):
    log = spark.createDataFrame([("s", i, x) for i, x in enumerate([100.0, 3.0, 1.0, 2.0])], "series string, run int, seconds double")
    assert rows(ev.median_after_warmup(log)) == [("s", 2.0)]
    table = spark.createDataFrame([(0, "base", 22.1, 398), (1, "fast", 2.5, 398), (2, "zero", 0.0, 398)], "ord int, strategy string, seconds double, nodes int")
    got = rows(ev.speedup(table, "seconds", "nodes").select("strategy", "speedup", "nodes_per_sec"), "ord")
    assert got == [("base", 1.0, 18.0), ("fast", 8.84, 159.2), ("zero", None, None)]


def test_best_rows(spark):
    configs = spark.createDataFrame([("a", 0.95, 2.0), ("b", 0.99, 2.0), ("c", 0.9, 0.1)], "config_id string, recall double, latency_ms double")
    assert ev.best_config(configs).first()["config_id"] == "a"
    assert ev.best_config(configs, 1.0).count() == 0
    ranked = spark.createDataFrame([(0, "x", 0.9, 1), (1, "y", 0.9, 0), (2, "z", 0.9, 0)], "ord int, strategy string, recall double, extra_calls int")
    assert ev.best_strategy(ranked).first()["strategy"] == "y"


def test_claims(spark):
    import json

    good = dict(iss="i", aud="a", exp=100, preferred_username="alice", groups=["acme"])
    cases = [good, {**good, "iss": "x"}, {**good, "aud": "x"}, {**good, "exp": 10}, {**good, "groups": []}, {k: v for k, v in good.items() if k != "preferred_username"}, {**good, "aud": ["b", "a"]}]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)], "n int, claims string")
    got = rows(tenancy.claims_to_scope(df, "i", "a", F.lit(50)).select("n", "username", "tenants", "rejected"), "n")
    assert [g[3] for g in got] == [None, "wrong issuer", "wrong audience", "expired", "belongs to no tenant", None, None]
    assert got[0][1:3] == ("alice", ["acme"]) and got[1][2] is None and got[5][1] == "?"


def test_claims_that_cannot_be_read_are_rejected(spark):
    from ravelin.operators.tenancy import claims_to_scope

    base = {"iss": "i", "aud": "a", "preferred_username": "u", "groups": ["g", " "]}
    cases = [{}, {"exp": 2000}, {"exp": 1.5}, {"exp": "2000"}, {"nbf": 1500}, {"iat": 5000}, {"groups": [""]}, {"exp": 1e9}]
    claims = spark.createDataFrame([(i, json.dumps(base | c)) for i, c in enumerate(cases)], "n int, claims string")
    got = rows(claims_to_scope(claims, "i", "a", F.lit(1000)).select("n", "tenants", "rejected"), "n")
    assert [g[2] for g in got] == [None, None, "expired", "unreadable time", "not valid yet", "not valid yet", "belongs to no tenant", None]
    assert got[0][1] == ["g"]


WORD_TEXTS = [("1", "a b a, A"), ("2", "B c"), ("3", ""), ("4", None), ("5", "!?"), ("6", "c c c d e a")]


def test_term_counts_of_one_text(spark):
    chunks = spark.createDataFrame(WORD_TEXTS, "chunk_id string, text string")
    counted = chunks.select("chunk_id", term_counts(F.col("text")).alias("c")).select("chunk_id", "c.length", "c.terms")
    got = {r["chunk_id"]: (r["length"], r["terms"] and [tuple(t) for t in r["terms"]]) for r in counted.collect()}
    assert got.pop("4") == (None, None)
    for key, text in WORD_TEXTS:
        if text is not None:
            words = re.findall("[a-z]+", text.lower())
            assert got[key] == (len(words), sorted(Counter(words).items()))


def bm25_by_hand(texts, question):
    words = {key: re.findall("[a-z]+", text.lower()) for key, text in texts if text is not None}
    mean, out = sum(map(len, words.values())) / len(words), {}
    for key, own in words.items():
        out[key] = 0.0
        for term in set(question.split()):
            df, tf = sum(term in w for w in words.values()), own.count(term)
            out[key] += math.log(1 + (len(texts) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean)) if tf else 0
    return out


def test_term_index_in_parts_equals_one_and_refuses_known_ids(spark, tmp_path):
    chunks = spark.createDataFrame(WORD_TEXTS, "chunk_id string, text string")
    path = str(tmp_path / "terms")
    with pytest.raises(ValueError):
        read_terms(spark, path)
    for part in ("chunk_id <= '2'", "chunk_id between '3' and '5'", "chunk_id > '5'"):
        index = add_terms(chunks.where(part), path)
    with pytest.raises(ValueError):
        add_terms(chunks.where("chunk_id = '2'"), path)
    queries = spark.createDataFrame([("q", "a c zz"), ("none", "zz")], "query_id string, text string")
    pool = queries.crossJoin(chunks.select("chunk_id", F.col("text").alias("passage"))).select("query_id", "chunk_id", F.col("passage").alias("text"))
    hits = pool.where("text is not null").withColumn("score", F.lit(0.5))
    ranked = lambda corpus: rows(bm25_rerank(hits, queries, corpus, 9).select("query_id", "chunk_id", "score"), "query_id", "chunk_id")
    got = ranked(index)
    assert got == ranked(chunks)
    assert {c: s for q, c, s in got if q == "q"} == pytest.approx(bm25_by_hand(WORD_TEXTS, "a c zz"), abs=1e-9)
    assert all(s == 0 for q, _, s in got if q == "none")


def test_term_index_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "chunk_id string, text string")
    index = add_terms(none, str(tmp_path / "terms"))
    assert index.docs == 0 and index.rows.count() == 0


def test_timed_sweep_and_the_pick_over_its_rows(spark):
    found = {"all": ["1", "2"], "half": ["1"], "none": [], "slow": ["1", "2"]}
    spent = {"all": [9.0, 0.4, 0.2, 0.3], "half": [9.0, 0.1, 0.1, 0.1], "none": [9.0, 0.1, 0.1, 0.1], "slow": [1.0, 2.0, 2.0, 2.0]}
    ticks, at = [], 0.0
    for name in found:
        for seconds in spent[name]:
            ticks += [at, at + seconds]
            at += seconds
    clock = iter(ticks)
    hits = lambda ids: spark.createDataFrame([("q", i) for i in ids], "query_id string, chunk_id string")
    configs = {name: (lambda ids=ids: hits(ids)) for name, ids in found.items()}
    swept = ev.timed_sweep(configs, hits(["1", "2"]), repeats=3, clock=lambda: next(clock))
    assert rows(swept, "config_id") == [("all", 1.0, 300.0), ("half", 0.5, 100.0), ("none", 0.0, 100.0), ("slow", 1.0, 2000.0)]
    assert rows(ev.best_config(swept, 0.95)) == [("all", 1.0, 300.0)]
    assert rows(ev.best_config(swept, 0.5)) == [("half", 0.5, 100.0)]


def test_timed_sweep_searches_the_truth_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pairs = spark.createDataFrame([("q", "1"), ("q", "2")], "query_id string, chunk_id string")
    swept = ev.timed_sweep({"all": lambda: pairs}, pairs.mapInArrow(counted, pairs.schema), repeats=1)
    assert [r[:2] for r in rows(swept)] == [("all", 1.0)]
    assert seen.value == 2


def test_best_score_of_each_question(spark):
    found = spark.createDataFrame([("1", 0.2), ("1", 0.7), ("2", None), ("3", -0.4)], "query_id string, score double")
    asked = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "query_id string")
    assert rows(pp.best_score(found, asked), "query_id") == [("1", 0.7), ("2", 0.0), ("3", -0.4), ("4", 0.0)]


def test_reranked_hits_are_stored_without_their_texts(spark, monkeypatch):
    """a passage found by many questions would be stored as many times."""
    stored = []
    monkeypatch.setattr(pp, "checkpointed", lambda df: (stored.append(df.columns), df)[1])
    chunks = spark.createDataFrame(WORD_TEXTS, "chunk_id string, text string")
    queries = spark.createDataFrame([("p", "a"), ("q", "a c")], "query_id string, text string")
    hits = queries.select("query_id").crossJoin(chunks.where("chunk_id in ('1', '6')")).withColumn("score", F.lit(0.5))
    ranked = bm25_rerank(hits, queries, chunks, 1)
    assert [r[:2] for r in rows(ranked.select("query_id", "chunk_id", "text"), "query_id")] == [("p", "1"), ("q", "6")]
    assert stored and not any("text" in columns for columns in stored)
