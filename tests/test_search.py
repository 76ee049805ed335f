import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ravelin.operators import approximate, lists, quantization, retrieval
from ravelin.operators.evaluation import recall_at_k
from ravelin.operators import nearest
from ravelin.operators.nearest import BIT_ITEMS, ITEM_BLOCK, METRICS, TASK_PAIRS, Vectors, as_words, best_pairs, cell_parts, exact_scores, first_copies, k_first, search
from ravelin.operators.ordering import exact_quantiles, numbered
from ravelin.operators.transforms import l2_normalize, norm_report
from ravelin.plans import inputs
from tests.conftest import rows

SMALL = "/root/testdata/sf0.01"
GRID = dict(max_broadcast_bytes=0, cell_items=7, cell_probes=5)


def frame(spark, vectors, name="chunk_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, embedding array<double>")


def table(hits, *columns):
    return rows(hits.select(*(columns or ("query_id", "rank", "chunk_id", "score"))), *(columns or ("query_id", "rank"))[:2])


def brute(queries, items, k, metric):
    out = []
    for q, a in enumerate(queries):
        scored = []
        for i, b in enumerate(items):
            dot, size = float(a @ b), float(np.linalg.norm(a) * np.linalg.norm(b))
            score = {"dot_product": dot, "cosine": dot / size if size else 0.0, "euclidean": -float(np.linalg.norm(a - b))}[metric]
            scored.append((-round(score, 10), i))
        out += [(q, r + 1, i) for r, (_, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("metric", ["cosine", "dot_product", "euclidean"])
def test_both_layouts_equal_brute_force_with_copies(spark, metric):
    rng = np.random.default_rng(0)
    items = rng.normal(size=(40, 5)).round(2)
    items[10:25] = items[3]  # a third of the rows are copies of one vector
    items[30] = 0
    queries = np.vstack([rng.normal(size=(11, 5)).round(2), items[3:4]])
    want = brute(queries, items, 4, metric)
    q, v = frame(spark, queries, "query_id"), frame(spark, items)
    for layout in ({}, GRID):
        assert [r[:3] for r in table(search(q, v, 4, metric, **layout))] == want


def test_keyed_search_never_crosses_keys_in_either_layout(spark):
    rng = np.random.default_rng(1)
    v = frame(spark, rng.normal(size=(60, 4))).withColumn("tenant_id", F.when(F.col("chunk_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("chunk_id") % 7).cast("string"))))
    q = frame(spark, rng.normal(size=(9, 4)), "query_id").withColumn("tenants", F.array(F.lit("hot"), F.lit("t1")))
    a, b = (retrieval.tenant_topk(q, v, 5, **layout) for layout in ({}, GRID))
    assert table(a) == table(b)
    assert {r[0] for r in rows(a.join(v, "chunk_id").select("tenant_id"))} <= {"hot", "t1"}
    alone = search(q, v.where("tenant_id in ('hot', 't1')"), 5)
    assert table(a) == table(alone)


def test_dimension_mismatch_names_both(spark):
    with pytest.raises(Exception, match="3 dimensions, stored vectors 2"):
        search(frame(spark, [[1, 2, 3]], "query_id"), frame(spark, [[1, 2]]), 1).collect()


def test_null_vectors_and_empty_sides(spark):
    q, v = frame(spark, [[1, 0]], "query_id"), frame(spark, [[1, 0], [0, 1]])
    holes = v.unionByName(spark.createDataFrame([(9, None)], v.schema))
    assert [r[2] for r in table(search(q, holes, 5))] == [0, 1]
    assert search(q.limit(0), v, 3).count() == 0
    assert search(q, v.limit(0), 3).count() == 0


def test_self_is_left_out(spark):
    v = frame(spark, np.eye(4))
    hits = retrieval.topk(inputs.as_queries(v), v, 3, exclude_self=True)
    assert all(r[0] != r[2] for r in table(hits)) and hits.count() == 12


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 1000))
def test_metrics_agree_once_normalized(spark, seed):
    rng = np.random.default_rng(seed)
    raw = frame(spark, rng.normal(size=(30, 16)) * rng.uniform(0.2, 5, size=(30, 1)))
    query = frame(spark, rng.normal(size=(1, 16)), "query_id")
    hits = retrieval.compare_metrics(l2_normalize(query), l2_normalize(raw), 5)
    assert rows(retrieval.rank_agreement(hits), "metric") == [("dot_product", "1/1"), ("euclidean", "1/1")]


def test_zero_vector_stays_and_norms(spark):
    v = frame(spark, [[3, 4], [0, 0]])
    assert rows(l2_normalize(v).select("embedding"), "chunk_id") == [([0.6, 0.8],), ([0.0, 0.0],)]
    assert rows(norm_report(v), "label") == [("l2_normalized", 0.0, 1.0), ("raw", 0.0, 5.0)]


def test_probing_every_cell_is_exact_and_fewer_cells_recall_less(spark):
    items = inputs.vectors(spark, SMALL)
    queries = inputs.as_queries(items)
    index = approximate.build_cells(items, 16)
    exact = retrieval.topk(queries, items, 10)
    every = approximate.ann_topk(queries, index, 10, 16)
    assert table(every) == table(exact)
    four = approximate.ann_topk(queries, index, 10, 4)
    assert recall_at_k(four, exact).first()[0] > 0.6
    assert table(approximate.ann_topk(queries, index, 10, 1, exact=True)) == table(exact)


def test_tenant_lists_are_apart(spark):
    items = inputs.vectors(spark, SMALL).withColumn("tenant_id", F.concat(F.lit("t"), F.col("label").cast("string")))
    index = approximate.build_cells(items, 4, by_tenant=True)
    queries = inputs.as_queries(items).withColumn("tenants", F.array(F.lit("t1"), F.lit("t2")))
    got = approximate.ann_topk(queries, index, 5, 4)
    assert table(got) == table(retrieval.tenant_topk(queries, items, 5))


@pytest.mark.parametrize("kind,plain,again", [("scalar", 0.93, 0.99), ("binary", 0.3, 0.5), ("product", 0.25, 0.45)])
def test_recall_floors_of_codes(spark, kind, plain, again):
    items = inputs.vectors(spark, SMALL)
    queries = inputs.as_queries(items)
    codes = quantization.Codes(kind, items)
    exact = retrieval.topk(queries, items, 10, "dot_product")
    recall = lambda hits: recall_at_k(hits, exact).first()[0]
    assert recall(quantization.quantized_topk(queries, items, codes, 10, rescore=False)) >= plain
    assert recall(quantization.quantized_topk(queries, items, codes, 10, 3.0)) >= again
    whole = quantization.quantized_topk(queries, items, codes, 10, 50.0)  # n/k: every item is re-scored
    assert recall(whole) == 1.0


def test_unknown_kind_and_metric_are_refused(spark):
    v = frame(spark, [[1, 0]])
    with pytest.raises(ValueError, match="no code called"):
        quantization.Codes("ternary", v)
    with pytest.raises(ValueError, match="no metric called"):
        search(inputs.as_queries(v), v, 1, "manhattan")


def test_search_plan_has_no_cartesian_and_one_exchange(spark):
    items = inputs.vectors(spark, SMALL)
    text = retrieval.topk(inputs.as_queries(items), items, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert text.count("hashpartitioning(query_id") == 1


@pytest.mark.parametrize("bracket_from", [0, 10**9])
def test_exact_quantiles(spark, bracket_from):
    rng = np.random.default_rng(3)
    values = {"hot": rng.exponential(size=60_000), "cold": rng.normal(size=30_001).round(1)}
    data = [(k, float(x)) for k, xs in values.items() for x in xs]
    df = spark.createDataFrame(data, "k string, x double")
    for k, n, lo, mid, hi in exact_quantiles(df, ["k"], "x", [0.005, 0.5, 0.95], bracket_from).collect():
        assert n == len(values[k])
        assert np.allclose([lo, mid, hi], np.quantile(values[k], [0.005, 0.5, 0.95]), atol=1e-12)


def test_numbered_hot_key(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 700, "hot").otherwise("cold"))
    got = rows(numbered(df, ["id"], ["k"]).select("k", "pos", "id"), "id")
    assert got == [("hot", i + 1, i) if i < 700 else ("cold", i - 699, i) for i in range(1000)]


def test_small_lists_recall_most_while_reading_less_than_half(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("chunk_id"), "embedding")
    index = lists.build_lists(items)
    n = index.lists.count()
    assert index.items.count() == items.count() == index.lists.agg(F.sum("n")).first()[0] and n > items.count() ** 0.5
    queries = items.where("chunk_id % 10 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    opening, rest = lists.probed_lists(queries, index, 10)
    read = opening.unionByName(rest)
    assert read.distinct().count() == read.count() < 0.5 * n * queries.count()
    pairs = lambda hits: {(r["query_id"], r["chunk_id"]) for r in hits.select("query_id", "chunk_id").collect()}
    exact = pairs(search(queries, items, 10))
    assert len(exact & pairs(lists.lists_topk(queries, index, 10))) >= 0.95 * len(exact)
    assert pairs(lists.lists_topk(queries, index, 10, reach=None)) == exact


def test_lists_of_equal_vectors_stay_short(spark, tmp_path):
    crowd = [(i, [1.0, 0.0]) for i in range(700)] + [(i, [0.0, float(i)]) for i in range(700, 1_000)] + [(1_000, [0.0, 0.0]), (1_001, None)]
    items = spark.createDataFrame(crowd, "chunk_id long, embedding array<float>")
    for metric in ("cosine", "euclidean"):
        index = lists.save_lists(lists.build_lists(items, metric, lists=20), str(tmp_path / metric))
        assert index.lists.agg(F.max("n")).first()[0] < 2 * lists.FULL * 1_001 / 20
        queries = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 3.0]), (3, [0.0, 0.0])], "query_id long, embedding array<float>")
        got, want = (rows(h.select("query_id", "rank", "chunk_id", "score"), "query_id", "rank") for h in (lists.lists_topk(queries, index, 5, reach=None), search(queries, items, 5, metric)))
        assert [r[3] for r in got] == [r[3] for r in want] if metric == "cosine" else got == want
    empty = lists.build_lists(items.limit(0))
    assert lists.lists_topk(queries, empty, 5).count() == 0


def test_a_table_searched_against_itself_in_cells(spark):
    """Both sides come from one table, so their columns must not be mixed up."""
    items = frame(spark, np.random.default_rng(5).normal(size=(60, 4))).withColumn("cell", (F.col("chunk_id") % 3).cast("int"))
    queries = items.select(F.col("chunk_id").alias("query_id"), "embedding", "cell")
    for key in (None, "cell"):
        assert table(search(queries, items, 3, key=key, **GRID)) == table(search(queries, items, 3, key=key))


def test_many_probes_of_a_broadcast_are_laid_out_in_cells(spark):
    """Each task of a broadcast would emit k rows for every probe; 70,000 probes of 4 hits stay one row a hit."""
    rng = np.random.default_rng(6)
    items = frame(spark, rng.normal(size=(30, 2)))
    queries = frame(spark, rng.normal(size=(70_000, 2)), "query_id")
    hits = search(queries, items, 4)
    assert "MapInArrow" not in hits._jdf.queryExecution().executedPlan().toString()
    assert hits.count() == 280_000


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("kind", ["float32", "float64", "tiny", "copies", "odd"])
def test_rough_scores_lose_no_item(metric, kind):
    """Whole blocks against every pair in doubles: many ties, crowds of copies, zeros and numbers that are not finite."""
    rng = np.random.default_rng(8)
    p, i = rng.poisson(1, (40, 9)).astype("float64"), rng.poisson(1, (2 * ITEM_BLOCK + 700, 9)).astype("float64")
    if metric == "hamming":
        p, i = (p > 0).astype(float), (i > 0).astype(float)
    elif kind == "float32":
        p, i = p.astype("float32"), i.astype("float32")
    elif kind == "tiny":
        p, i = p * 1e-6, i * 1e-6
    elif kind == "copies":
        p[0], i[:60], i[100:3000] = 0, 0, i[100]
    elif kind == "odd":
        i[5], i[17, 3], i[20], p[3], p[4, 1] = np.nan, np.inf, 1e200, np.nan, -np.inf
    left, right = (Vectors(pa.chunked_array([pa.array(list(x))]), None) for x in (p, i))
    kept = first_copies(right.rows, 10)
    r, c, s = best_pairs(left, right, 10, metric, items=kept)
    first = k_first(r, s, c, 10)
    with np.errstate(all="ignore"):
        every = exact_scores(metric, left, right, np.repeat(np.arange(40), len(i)), np.tile(np.arange(len(i)), 40)).reshape(40, -1)
    want = []
    for q, scores in enumerate(every):
        there = np.flatnonzero(~np.isnan(scores))
        want += [(q, at) for at in there[np.lexsort((there, -scores[there]))][:10].tolist()]
    assert list(zip(r[first].tolist(), c[first].tolist())) == want


def test_a_cell_scores_a_bounded_number_of_pairs(spark):
    """However large the tables; and tables of one size smaller are laid out as before."""
    for rows_, k, metrics in ((615_384, 4, 3), (615_384, 11, 1), (3_000_000, 10, 1)):
        salts, shards = cell_parts(spark, rows_, rows_, k, task_pairs=TASK_PAIRS / metrics)
        assert rows_ * rows_ / (salts * shards) * metrics <= 1.1 * TASK_PAIRS
    assert cell_parts(spark, 10_000, 10_000, 4, task_pairs=TASK_PAIRS) == cell_parts(spark, 10_000, 10_000, 4) == (1, 1)


def test_small_cells_are_not_gathered_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(nearest, "TASK_PAIRS", 60 * 60 / 16)
    items = frame(spark, np.random.default_rng(11).normal(size=(60, 4)))
    hits = search(inputs.as_queries(items), items, 3, max_broadcast_bytes=0)
    assert "REPARTITION_BY_NUM" in hits._jdf.queryExecution().executedPlan().toString()
    assert table(hits) == table(search(inputs.as_queries(items), items, 3))


def test_far_more_items_than_probes_stay_where_they_lie(spark, monkeypatch):
    """More probes than one broadcast takes are no reason to shuffle the items."""
    rng = np.random.default_rng(14)
    items, queries = frame(spark, rng.normal(size=(3000, 4)).round(1)), frame(spark, rng.normal(size=(30, 4)).round(1), "query_id")
    want = table(search(queries, items, 1))
    monkeypatch.setattr(nearest, "BROADCAST_HITS", 10)
    hits = search(queries, items, 1)
    assert "CoGroups" not in hits._jdf.queryExecution().executedPlan().toString()
    assert table(hits) == want


@pytest.mark.parametrize("stored", [False, True])
def test_passes_equal_the_other_layouts(spark, monkeypatch, stored):
    rng = np.random.default_rng(15)
    items = rng.normal(size=(90, 4)).round(1)
    items[20:50] = items[3]
    items, queries = frame(spark, items), frame(spark, rng.normal(size=(12, 4)).round(1), "query_id")
    queries = queries.unionByName(queries.where("query_id < 4"))  # a question that comes twice is one group
    for metric in ("cosine", ["euclidean", "dot_product"]):
        want = table(search(queries, items, 5, metric), *(["metric"] if len(metric) == 2 else []), "query_id", "rank", "chunk_id", "score")
        with monkeypatch.context() as m:
            m.setattr(nearest, "BROADCAST_HITS", 10)
            m.setattr(nearest, "pass_parts", lambda *a: (5, 2, stored))
            hits = search(queries, items, 5, metric)
        assert sorted(want) == sorted(table(hits, *(["metric"] if len(metric) == 2 else []), "query_id", "rank", "chunk_id", "score"))


def test_rows_that_a_large_search_moves():
    """Sentences (180 million, 800,000 questions) and documents are scanned in passes of bounded size; tables of one size meet in cells."""
    passes, tasks, stored = nearest.pass_parts(180_000_000, 810_000, 2, 576, 12, 2457, 14)
    assert 810_000 * 576 / passes <= 2 * nearest.BROADCAST_BYTES and tasks <= 48 and not stored
    passes, tasks, stored = nearest.pass_parts(3_000_000, 810_000, 10, 576, 12, 31, 18)
    assert 810_000 * 10 / passes <= nearest.CELL_HITS and tasks <= 48 and stored
    assert nearest.pass_parts(51_282, 51_282, 10, 576, 8, 3, 7) is None
    assert nearest.pass_parts(615_384, 615_384, 10, 576, 12, 6, 15) is None
    assert nearest.pass_parts(180_000_000, 810_000, 2, 576, 12, 2457, 14, max_bytes=0) is None


@pytest.mark.parametrize("words", [1, 2, 5])
def test_packed_bits_give_the_hits_of_unpacked_ones(words):
    """Both ways, with ties everywhere, equal codes and rows cut to any length."""
    rng = np.random.default_rng(12)
    dim = 64 * words - 7
    near = rng.random((4, dim)) < 0.5
    bits = [near[rng.integers(0, 4, n)] ^ (rng.random((n, dim)) < 0.1) for n in (300, 2 * BIT_ITEMS + 300)]
    bits[1][40:90] = bits[1][40]
    packed = []
    for side in bits:
        octets = np.zeros((len(side), 8 * words), np.uint8)
        octets[:, : (dim + 7) // 8] = np.packbits(side, axis=1, bitorder="little")
        packed.append(pa.chunked_array([pa.array(list(octets.view("<i8")))]))
    for rows_, items in ((None, None), (np.arange(3, 290, 7), np.arange(5, 2000, 3)), (None, np.arange(4))):
        for k in (1, 10):
            found = []
            for decode in (quantization.binary_decoder(dim), as_words):
                left, right = (Vectors(x, decode) for x in packed)
                r, c, s = best_pairs(left, right, k, "hamming", rows_, items)
                first = k_first(r, s, c, k)
                found.append(list(zip(r[first].tolist(), c[first].tolist(), s[first].tolist())))
            assert found[0] == found[1] and found[0]


def test_later_blocks_start_from_the_best_hits_so_far(monkeypatch):
    """Nothing of a block is scored in doubles where the blocks before it hold better hits."""
    rng = np.random.default_rng(16)
    side = lambda name, first, x: pa.table({name: np.arange(first, first + len(x)), "embedding": pa.array(x.tolist(), pa.list_(pa.float64()))})
    near = rng.normal(size=(60, 6)) + 5
    hits = [nearest.Hits(nearest.Probes(side("query_id", 0, near[:20]), ["query_id"], None, "embedding", None), 5, "dot_product")]
    offer = lambda *a: nearest.offer_table(hits, side("chunk_id", *a), None, "chunk_id", "embedding", None)
    offer(100, near)
    want, scored, score = hits[0].result("chunk_id"), [], nearest.exact_scores
    monkeypatch.setattr(nearest, "exact_scores", lambda m, p, i, r, c: scored.append(len(r)) or score(m, p, i, r, c))
    offer(1000, near / 100)
    assert sum(scored) == 0 and hits[0].result("chunk_id").equals(want)
    offer(0, near)  # the same scores under smaller ids
    first = want.column("chunk_id").to_numpy().reshape(20, 5)
    again = hits[0].result("chunk_id").column("chunk_id").to_numpy().reshape(20, 5)
    assert (again == np.stack([first[:, 0] - 100, first[:, 0], first[:, 1] - 100, first[:, 1], first[:, 2] - 100], axis=1)).all()


def test_bits_in_hand_are_few():
    """The differing bits of a strip stay in a core's cache, whatever else the core's other thread holds there."""
    rng = np.random.default_rng(17)
    assert nearest.BIT_STRIP * BIT_ITEMS * 8 <= 1 << 19
    for words in (1, 3, 4):
        left, right = (rng.integers(0, 1 << 63, shape, dtype=np.uint64) for shape in ((37, words), (words, 90)))
        far = nearest.bit_distances(left, right, np.empty((40, 100), np.uint8 if words <= 3 else np.uint32), np.empty((nearest.BIT_STRIP, 100), np.uint64))
        assert (far == np.bitwise_count(left[:, :, None] ^ right[None]).sum(axis=1)).all()


def test_binary_codes_are_searched_packed(spark):
    """Also where a vector's length fills no whole word."""
    rng = np.random.default_rng(13)
    items = frame(spark, rng.normal(size=(50, 70)))
    found = table(quantization.Codes("binary", items).topk(inputs.as_queries(items), 5))
    signs = np.array([r[0] for r in rows(items.orderBy("chunk_id").select("embedding"))]) > 0
    want = []
    for q in range(50):
        far = (signs != signs[q]).sum(axis=1)
        want += [(q, place + 1, int(at), -float(far[at])) for place, at in enumerate(np.lexsort((np.arange(50), far))[:5])]
    assert found == want


def test_list_search_makes_no_row_for_each_query_and_list(spark, monkeypatch):
    items = frame(spark, np.random.default_rng(9).normal(size=(400, 6)))
    queries = inputs.as_queries(items)
    index = lists.build_lists(items, lists=40)
    stored = []

    def counted(df, keep=lists.checkpointed):
        out = keep(df)
        stored.append((set(out.columns) >= {"query_id", "list"}, out.count()))
        return out

    monkeypatch.setattr(lists, "checkpointed", counted)
    hits = lists.lists_topk(queries, index, 2, reach=None)
    assert max(n for pairs, n in stored if pairs) < 400 * 8
    assert table(hits) == table(search(queries, items, 2))


def test_lists_are_probed_for_few_queries_at_a_time(spark):
    from types import SimpleNamespace

    centres = np.random.default_rng(10).normal(size=(30, 4))
    shared = SimpleNamespace(value=(np.arange(30), centres, np.ones(30), np.ones(30), np.full(30, 5)))
    batch = pa.RecordBatch.from_pydict({"query_id": list(range(2000)), "embedding": np.random.default_rng(11).normal(size=(2000, 4)).tolist()})
    out = list(lists._probe(shared, 3, 2, None, False, "embedding")(iter([batch])))
    assert len(out) == -(-2000 // lists.PROBE_ROWS) and {q for b in out for q in b.column(0).to_pylist()} == set(range(2000))


def test_a_sweep_scores_the_pairs_of_a_kind_once(spark, monkeypatch):
    from ravelin.operators import evaluation

    items, calls = frame(spark, np.random.default_rng(12).normal(size=(50, 8))), []
    score = quantization.vectors.score
    monkeypatch.setattr(quantization.vectors, "score", lambda *a: calls.append(a[0]) or score(*a))
    queries = inputs.as_queries(items)
    hits = evaluation.config_hits(queries, items, 3, ("binary",), (1.0, 2.0, 4.0))
    assert len(calls) == 1
    codes = quantization.Codes("binary", items)
    for o in (1.0, 2.0, 4.0):
        want = quantization.quantized_topk(queries, items, codes, 3, o)
        assert rows(hits.where(F.col("oversampling") == o).select("query_id", "chunk_id"), "query_id", "chunk_id") == rows(want.select("query_id", "chunk_id"), "query_id", "chunk_id")
