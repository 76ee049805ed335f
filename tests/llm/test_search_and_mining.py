import math
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from check import rows_of
from ravelin.llm import hamming_dedup, hard_negatives, ranked_search
from ravelin.llm.blocks import dealt, meeting
from tests.llm.helpers import LONG, TEXTS, empty, odd

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def agree(df, db, sql):
    result = db.execute(sql)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in result.description], result.fetchall())


# --- ranked search


def plain_terms(text):
    kept = "".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and c.isalnum() or ord(c) > 0x7F else " " for c in text or "")
    return [t for t in kept.split(" ") if t]


def plain_search(docs, items, top):
    """Every item against every document."""
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    holding = [c for _, c in counted if c]
    n, tokens = len(holding), sum(sum(c.values()) for c in holding)
    out = []
    for item, text in items:
        scores = []
        for d, c in counted:
            m = 75 + (25 * sum(c.values()) * n) // max(1, tokens)
            score = 0
            for t in plain_terms(text):
                df = sum(t in h for h in holding)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return out


def test_ranked_search_equals_its_sql(spark, db):
    agree(ranked_search.query(spark, FOLDER), db, ranked_search.ORACLE)


@pytest.mark.parametrize("docs_a_shard", [1, 3, 1 << 14])
def test_ranked_search_over_odd_rows_and_small_shards(spark, monkeypatch, docs_a_shard):
    monkeypatch.setattr(ranked_search, "DOCS", docs_a_shard)
    items = [(1, "The quick brown FOX fox"), (2, None), (3, ""), (4, "日本語 ünïcode x"), (4, "word5 the The word996"), (5, "nowhere"), (None, "dog barn")]
    copies = TEXTS + [(100 + k, "The quick brown dog", "en") for k in range(40)]
    docs = odd(spark).unionByName(spark.createDataFrame(copies[len(TEXTS) :], "doc_id long, text string, lang string"), allowMissingColumns=True).coalesce(1)
    got = ranked_search.search(ranked_search.build_index(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain_search([(d, t) for d, t, _ in copies], items, ranked_search.TOP)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    none = ranked_search.search(ranked_search.build_index(empty(spark)), spark.createDataFrame(items, "item_id long, text string"))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_search.search(ranked_search.build_index(docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_treap_levels_hold_maxima_and_prune():
    random = np.random.default_rng(5)
    cells = np.unique(random.integers(0, 700 * 64, 3_000))
    rows, docs = cells // 64, cells % 64
    tf = random.integers(1, 9, len(cells))
    rows = np.unique(rows, return_inverse=True)[1]
    norm = np.full(64, 100)
    leaves, children, maxima = ranked_search.build(rows, docs, tf, ranked_search.impacts(tf, norm[docs]), 6)
    assert sum(map(int, np.bitwise_count(children[0]))) == len(leaves) == len(cells)
    assert [len(m) for m in maxima] == [len(c) for c in children] and len(maxima) == 6
    row = {"depth": 6, "terms": [str(k).encode() for k in range(rows.max() + 1)], "norms": norm.tobytes(), "known": np.ones(64, bool).tobytes()}
    row |= {"doc_ids": np.arange(64).tobytes(), "leaves": leaves.tobytes(), "children": [c.tobytes() for c in children], "maxima": [m.tobytes() for m in maxima]}
    treap = ranked_search.Treap(row)
    for _ in range(30):
        asked = {int(k): int(w) for k, w in zip(random.integers(0, len(row["terms"]), 5), random.integers(1, 50, 5), strict=True)}
        want = np.zeros(64, np.int64)
        for k, w in asked.items():
            at = rows == k
            want[docs[at]] += w * ranked_search.impacts(tf[at], norm[docs[at]])
        order = sorted(np.flatnonzero(want).tolist(), key=lambda d: (-want[d], d))[:7]
        got = treap.search([(str(k).encode(), w) for k, w in asked.items()], 0, 7)
        assert got[0].tolist() == order and got[1].tolist() == want[order].tolist()


def test_query_blocks_meet_by_broadcast_and_by_shuffle(spark):
    rows = spark.range(20).withColumnRenamed("id", "block")
    queries, cells = dealt(spark.range(10), 3, "id")
    together = queries.groupBy("cell").agg(F.collect_list("id").alias("ids"), F.count("*").alias("bytes"))
    for bound in (1 << 20, 0):
        met = meeting(rows, together, cells, "bytes", "block", bound).select("block", F.explode("ids"))
        assert met.count() == met.distinct().count() == 200


# --- near-duplicates by multi-index hashing


def plain_fingerprint(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(rows):
    """Every fingerprint against every other."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(prints):
        for b in prints[k + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for doc, p in rows:
        if doc is not None:
            least[find(p)] = min(doc, least.get(find(p), doc))
    return Counter((d, p, least.get(find(p))) for d, p in rows)


def test_hamming_dedup_equals_brute_force(spark, db):
    docs = db.execute("select doc_id, text from documents").fetchall()
    want = plain_components([(d, plain_fingerprint(t)) for d, t in docs])
    got = hamming_dedup.query(spark, FOLDER).collect()
    assert Counter((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in got) == want
    want = plain_components([(d, plain_fingerprint(t)) for d, t, _ in TEXTS])
    got = hamming_dedup.near_components(odd(spark)).collect()
    assert Counter((r["doc_id"], r["bits"] % 2**64, r["component_id"]) for r in got) == want
    assert hamming_dedup.near_components(empty(spark)).count() == 0
    assert hamming_dedup.fingerprint(LONG.encode()) == plain_fingerprint(LONG)


@pytest.mark.parametrize("crowded", [2, 20, 4_096])
def test_crowded_buckets_lose_no_link(spark, crowded):
    random = np.random.default_rng(8)
    prints = [int(x) for x in random.integers(0, 1 << 63, 150)]
    centre = int(random.integers(0, 1 << 63))
    prints += [centre ^ sum(1 << int(b) for b in random.choice(64, random.integers(0, 6), replace=False)) for _ in range(200)]
    prints += [p ^ sum(1 << int(b) for b in random.choice(64, k % 5, replace=False)) for k, p in enumerate(prints[:150])]
    rows = list(enumerate(prints))
    signed = [(d, p - (1 << 64) if p >> 63 else p) for d, p in rows]
    links = hamming_dedup.near_links(spark.createDataFrame(signed, "doc_id long, bits long"), crowded).distinct().collect()
    assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 3 for r in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in links:
        root[find(r["a"] % 2**64)] = find(r["b"] % 2**64)
    least = {}
    for d, p in rows:
        least[find(p)] = min(d, least.get(find(p), d))
    assert Counter((d, p, least[find(p)]) for d, p in rows) == plain_components(rows)


# --- hard negatives


def test_hard_negatives_equal_their_sql(spark, db):
    agree(hard_negatives.query(spark, FOLDER), db, hard_negatives.ORACLE)


def plain_negatives(rows):
    taken = []
    for key, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        taken.append((key, i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = Counter()
    by = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    for key, i, v, label in taken:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, k, other) for k, j, w, other in taken if k != key]
        for p in sorted((s for s in scored if s[3] == label), key=by)[:5]:
            fit = sorted((s for s in scored if s[3] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=by)[:3]
            out.update((i, p[1], rank, s[1], p[0], s[0]) for rank, s in enumerate(fit, 1))
    return out


@pytest.mark.parametrize("sizes", [(4_096, 1_024), (16, 2)])
def test_hard_negatives_equal_brute_force_on_odd_rows(spark, monkeypatch, sizes):
    monkeypatch.setattr(hard_negatives, "BLOCK", sizes[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", sizes[1])
    random = np.random.default_rng(3)
    rows = [(k, [float(x) for x in np.float32(random.normal(0.3, 1, 11))], k % 4) for k in range(300)]
    rows += [(1_000, None, 1), (1_050, [1.0, None], 1), (1_100, [1.0, float("nan")], 1), (1_150, [float("inf")], 1), (1_200, [1.0] * 11, None)]
    rows += [(1_250, [], 1), (1_300, [2.5e5] * 9 + [-3.75], 2), (1_350, [0.5, 0.25], 3), (1_401, [1.5] * 11, 2), (1_402, [1.5] * 11, 2), (1_403, [1.5] * 11, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in ("anchor", "rank", "score", "cell", "place")})
    found = hard_negatives.hard_negatives(df.repartition(5))
    assert Counter(map(tuple, found.collect())) == plain_negatives(rows)
    none = hard_negatives.hard_negatives(df.limit(0))
    assert none.count() == 0 and none.columns == found.columns


def test_hard_negatives_keep_repeated_rows_and_unknown_ids(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (None, [0.9, 0.1], 1), (3, [0.8, 0.1], 1), (None, [0.6, 0.6], 2), (5, [0.6, 0.6], 2)]
    rows = [(i, v, (k - 1) % 10 if i == 0 else k) for i, v, k in rows]  # ids divisible by 7 move to the next label
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert Counter(map(tuple, found)) == plain_negatives(rows) and len(found) == 12


def test_lookups_equal_inner_products():
    random = np.random.default_rng(1)
    for bound, dims in ((1, 3), (300, 64), (2**40, 17), (2**62, 8)):
        a, b = random.integers(-bound, bound, (9, dims)), random.integers(-bound, bound, (301, dims))
        bits = hard_negatives.planes(b)
        assert (hard_negatives.from_planes(bits)[:, :dims] == b).all()
        with np.errstate(over="ignore"):
            assert (np.concatenate([s for _, s in hard_negatives.scores(bits, a)]) == b @ a.T).all()
    values = np.array([[1e30, -1e30, 2.0**55, -(2.0**56), 0.999, -0.001]])
    assert [x % 2**64 for x in hard_negatives.integers(values)[0].tolist()] == [math.floor(256 * x) % 2**64 for x in values[0].tolist()]
