import hashlib
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ravelin.llm import bpe, components, licenses, near_dedup, packing, pii, quality_classifier, quality_rules, secrets, simhash, url_filter
from ravelin.llm.shingles import shingles
from ravelin.llm.words import WordEncoder, default_path
from tests.llm.helpers import LONG, TEXTS, empty, odd

FOLDER = "/root/testdata/sf0.001"
KEY = b"a key of the tests"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def corpus():
    return dict(duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_the_library(library):
    coder = WordEncoder(default_path(), limit=50)
    odd_chars = "".join(chr(c) + "a" for c in (0x1C, 0x85, 0xA0, 0x130, 0x1E9E, 0x2028, 0x3000, 0x345, 0x1F600, 0xAD, 0xD7))
    texts = [t or "" for _, t, _ in TEXTS] + [odd_chars, "it's we'll 'S<|startoftext|>'T", "a" * 3000, "¡Ñandú! ÀÉ÷× 3½²"]
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in coder.encode(texts)] == [ids_of(library, t) for t in texts]


def test_bpe_equals_the_library(spark, library, corpus):
    got = {r["doc_id"]: r for r in bpe.query(spark, FOLDER).collect()}
    assert len(got) == len(corpus)
    for doc, text in corpus.items():
        ids = ids_of(library, text)
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    rows = bpe.encode_decode(odd(spark)).collect()
    want = Counter((d, len(ids_of(library, t)), library.decode(ids_of(library, t), skip_special_tokens=False)) for d, t, _ in TEXTS)
    assert Counter((r["doc_id"], r["n_tokens"], r["decoded"]) for r in rows) == want and rows[0]["score"] == "x"
    assert bpe.encode_decode(empty(spark)).count() == 0


def check_pieces(rows, want):
    """Every document's ids once, in order; sequences gapless and full or of a power of two."""
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), Counter())[r["start"], r["length"]] += 1
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    assert sum(r["length"] for r in rows) == sum(len(x) for x in want)


def test_packing(spark, library, corpus):
    rows = packing.query(spark, FOLDER).collect()
    want = {d: np.array([*ids_of(library, t), 2], "<u4") for d, t in corpus.items()}
    check_pieces(rows, want.values())
    for doc, ids in want.items():
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    check_pieces(packing.pack(odd(spark)).collect(), [[*ids_of(library, t), 2] for _, t, _ in TEXTS])
    assert packing.pack(empty(spark)).count() == 0


def test_hilbert_curve_visits_every_cell_by_single_steps():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    along = grid[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_secrets(spark, corpus):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    extra = ["PassWord : 'abcdefgh' token=secret:abcdefghijk api_key=1234567", "AKIAABCDEFGHIJKL AKIASHORT " + "0" * 40, 'ApiKey="x' + "y" * 9 + '"']

    def base(text):
        found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        return [(k, s, e) for s, _, k, e in sorted(found)]

    texts = list(corpus.values()) + extra
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.kind for r in secrets.BASE_RULES}
    for r in secrets.find_secrets(df).collect():
        assert [tuple(s) for s in r["secrets"] if s["kind"] in kinds] == base(texts[r["doc_id"]])
    token = "ghp_" + "a1B2" * 9
    more = secrets.find_secrets(spark.createDataFrame([(1, f"x {token} y")], "doc_id long, text string")).first()["secrets"]
    assert [tuple(s) for s in more] == [("repository_token", 2, 2 + len(token))]
    assert secrets.find_secrets(odd(spark)).count() == len(TEXTS) and secrets.find_secrets(empty(spark)).count() == 0
    assert secrets.trigram_query(secrets.BASE_RULES[2]) is None
    assert frozenset({"aki", "kia"}) in secrets.trigram_query(secrets.BASE_RULES[1])


def test_url_filter(spark):
    db = duckdb.connect()
    urls = ["http://A.Example.ORG/es/x?q", "https://example.org/en/12", "x.org", None, "", "ftp://org", "http://notexample.org/es/", "http://example.org/es#", "a://b://com/fr/", "http://shop.com/de/1", "http://shop.com/de/1"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    db.register("pages", pages.toPandas())
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    got = url_filter.judge_urls(pages.withColumns({"host": F.lit("x"), "rule": F.lit("y")}), rules).select("page_id", "url", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect())) == sorted(db.execute(url_filter.ORACLE).fetchall())
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    deep = spark.range(5_000).select(F.lit("block").alias("verdict"), F.lit("deep.net").alias("host"), F.repeat(F.lit("/a"), F.col("id").cast("int") + 1).alias("path"))
    page = spark.createDataFrame([(1, "http://x.deep.net" + "/a" * 4_321 + "b")], "page_id long, url string")
    assert url_filter.judge_urls(page, deep).first()["rule"] == "deep.net" + "/a" * 4_321  # as many path lengths as rules
    many = spark.range(3000).select(F.lit("block").alias("verdict"), F.concat(F.lit("h"), "id", F.lit(".net")).alias("host"), F.lit("/").alias("path"))
    bits = url_filter.build_filter(many, 3000)
    passes = url_filter._passes(bits, spark)
    key = lambda host: url_filter._key_hash(F.col(host), F.lit("/"))
    assert many.where(~passes(key("host"))).count() == 0
    others = spark.range(20_000).select(F.concat(F.lit("g"), "id").alias("host"))
    assert others.where(passes(key("host"))).count() < 400


def test_quality_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_classifier.classify(docs.select("doc_id", "text"), labels).join(labels.select("doc_id", "quality"), "doc_id")
    held = got.where("held_out").select("score", "predicted", "quality").collect()
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.9
    model = quality_classifier.fit(odd(spark), labels.limit(0))
    scored = quality_classifier.score(odd(spark), model).collect()
    assert len(scored) == len(TEXTS) and {r["score"] for r in scored} == {0.5}
    assert quality_classifier.score(empty(spark), model).count() == 0
    rows, sizes = quality_classifier.features(["a b a", "", "B!"])
    assert sizes.tolist() == [3, 0, 1] and rows.shape == (4, 5) and (rows[0, [0, 2]] == rows[2, [0, 2]]).all()
    weights = np.arange(1 << quality_classifier.BITS, dtype=np.float32) / (1 << quality_classifier.BITS)
    one = quality_classifier.score(spark.createDataFrame([("a b a",)], "text string"), (weights, 0.25)).first()["score"]
    assert one == pytest.approx(1 / (1 + np.exp(-(0.25 + weights[rows[:3]].sum() / 3))), abs=1e-6)


def brute_rules(text):
    word = re.compile("[^\x20\x09-\x0d]+")
    text = text or ""
    words, seen, dup, places = word.findall(text), set(), 0, {}
    for line in text.split("\n"):
        if word.search(line):
            dup += line in seen
            seen.add(line)
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(8)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def js(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    return np.sqrt(max(0.0, (kl(p) + kl(q)) / 2))


def test_quality_rules(spark, corpus):
    extra = {-1: None, -2: "", -3: " \n \n", -4: "a b c d e f g h " * 9, -5: LONG, -6: "same line here\nsame line here\n\n\nx\x0by"}
    df = spark.createDataFrame([(d, t, "en" if d % 3 else None) for d, t in (corpus | extra).items()], "doc_id long, text string, lang string")
    measured = quality_rules.measure(df.withColumn("kept", F.lit("x")).drop("kept"))
    references = {r["reference"]: r for r in quality_rules.references(measured).collect()}
    texts = corpus | extra
    for r in quality_rules.verdicts(measured, quality_rules.references(measured)).collect():
        want = brute_rules(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality_rules.MEASURES) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
        near = js(r["class_shares"], references[r["reference"]]["class_reference"])
        assert r["class_distance"] == pytest.approx(near, abs=1e-6)
        assert r["kept"] == (not failed and not (want[0] >= 50 and (r["class_distance"] > quality_rules.MOST_CLASSES or r["common_distance"] > quality_rules.MOST_COMMON)))
    assert quality_rules.judge_quality(odd(spark)).count() == len(TEXTS)
    assert quality_rules.judge_quality(empty(spark)).count() == 0 and quality_rules.keep_good(empty(spark)).count() == 0
    assert quality_rules.keep_good(odd(spark)).columns == odd(spark).columns


def test_shingles_and_simhash(spark, corpus):
    texts = [*corpus.values()][:50] + ["", "one", "a b c d", "a b c d e"]
    hashes, sizes = shingles(texts)
    assert sizes.tolist() == [0 if not t.split() else max(1, len(t.split()) - 4) for t in texts]
    for t, f in zip(texts, simhash.fingerprints(texts), strict=True):
        own, _ = shingles([t])
        votes = [sum(1 if int(h) >> b & 1 else -1 for h in own) for b in range(64)]
        assert int(f) == sum(1 << b for b in range(64) if votes[b] > 0)
    docs = sorted(corpus.items())
    for r in simhash.query(spark, FOLDER).collect():
        k = [d for d, _ in docs].index(r["doc_id"])
        text, after = docs[k][1], docs[(k + 1) % len(docs)][1]
        cut = len(text) // 4
        changed = text[: len(text) - cut] + after[:cut]
        f = [int(x) for x in simhash.fingerprints([text, changed, after])]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)) == (f[0], f[1])
        assert (r["near_edited"], r["near_next"]) == (1 - (f[0] ^ f[1]).bit_count() / 64, 1 - (f[0] ^ f[2]).bit_count() / 64)
    assert simhash.fingerprint_edits(odd(spark)).count() == len(TEXTS) and simhash.fingerprint_edits(empty(spark)).count() == 0
    assert simhash.near_classes(simhash.fingerprint_edits(empty(spark))).count() == 0


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    found = {}
    for n in nodes:
        found.setdefault(find(n), set()).add(n)
    return sorted(map(sorted, found.values()))


def test_simhash_tables_find_every_fingerprint_within_the_radius(spark):
    random = np.random.default_rng(1)
    base = random.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64)
    prints = {int(b) for b in base}
    for b in base[:20]:
        for k in (1, 2, 3, 4, 6):
            flipped = int(b) & (1 << 64) - 1
            for place in random.choice(64, k, replace=False):
                flipped ^= 1 << int(place)
            prints.add(flipped - (1 << 64) if flipped >> 63 else flipped)
    prints = sorted(prints)
    classes = {r["bits"]: r["near_class"] for r in simhash.near_classes(spark.createDataFrame([(p,) for p in prints], "bits long")).collect()}
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    got = {}
    for p in prints:
        got.setdefault(classes.get(p, p), set()).add(p)
    assert sorted(map(sorted, got.values())) == groups(near, prints)


def test_simhash_classes_hold_near_copies_beyond_the_radius(spark, tmp_path):
    random = np.random.default_rng(3)
    docs, pairs = [], []
    for k in range(150):
        words = [f"w{x}" for x in random.integers(0, 5_000, 300)]
        other = list(words)
        for at in random.choice(300, int(random.integers(1, 9)), replace=False):
            other[at] = f"new{k}x{at}"
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        a, b = (set(shingles([t])[0].tolist()) for t in (docs[-2][1], docs[-1][1]))
        pairs.append((2 * k, 2 * k + 1, len(a & b) / len(a | b)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in simhash.query(spark, str(tmp_path)).collect()}
    near = [(a, b) for a, b, s in pairs if s >= 0.8]
    apart = [(int(rows[a]["fingerprint"], 16) ^ int(rows[b]["fingerprint"], 16)).bit_count() for a, b in near]
    assert len(near) > 80 and sum(d > 3 for d in apart) > 40
    assert sum(rows[a]["near_class"] == rows[b]["near_class"] for a, b in near) >= 0.99 * len(near)
    for a, b, s in pairs:
        within = (int(rows[a]["fingerprint"], 16) ^ int(rows[b]["fingerprint"], 16)).bit_count() <= 3
        assert s >= 0.8 or within or rows[a]["near_class"] != rows[b]["near_class"]
    assert len({r["near_class"] for r in rows.values()}) >= 150


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100} and got[201] == 200
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup(spark, corpus):
    docs = dict(corpus)
    base = [f"w{i}" for i in range(120)]
    for k in range(40):  # a group of different near copies
        docs[10_000 + k] = " ".join(base[:60] + [f"new{k}"] + base[60:])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    classes = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()}
    idf = near_dedup.shingle_weights(df)
    own = {d: near_dedup._weighted([t], idf)[:2] for d, t in docs.items()}
    order = sorted(docs)
    links = [(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if docs[a] == docs[b] or len(own[a][0]) and len(own[b][0]) and near_dedup.weighted_jaccard(own[a], own[b]) >= 0.8]
    got = {}
    for d, c in classes.items():
        got.setdefault(c, set()).add(d)
    assert sorted(map(sorted, got.values())) == groups(links, order) and all(c == min(m) for c, m in got.items())
    kept = near_dedup.one_of_each(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(got)
    assert near_dedup.near_duplicates(odd(spark)).count() == len(TEXTS) and near_dedup.near_duplicates(empty(spark)).count() == 0
    assert near_dedup.one_of_each(odd(spark)).count() == 6 and near_dedup.one_of_each(empty(spark)).count() == 0


def test_near_dedup_joins_all_close_texts_of_a_mixed_bucket(spark):
    """Texts around one long passage fall into the same buckets, but only some are close; each stray meets every member."""
    random = np.random.Generator(np.random.PCG64(5))
    words = [f"w{k}" for k in range(4_000)]
    passage = [words[k] for k in random.integers(0, 4_000, 80)]
    tails = [[words[k] for k in random.integers(0, 4_000, 24)] for _ in range(12)]
    texts = {k: " ".join(passage + tails[k % 12][: 24 - int(random.integers(0, 4))] + [f"end{k}"] * int(random.integers(0, 3))) for k in range(240)}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(5)
    idf = near_dedup.shingle_weights(df)
    own, bands = {d: near_dedup._weighted([t], idf)[:2] for d, t in texts.items()}, dict(zip(texts, near_dedup.signatures(list(texts.values()), idf), strict=True))
    classes = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()}
    wanted = {d: d for d in texts}

    def top(d):
        while wanted[d] != d:
            d = wanted[d]
        return d

    for a in texts:
        for b in range(a + 1, 240):
            if (bands[a] == bands[b]).any() and near_dedup.weighted_jaccard(own[a], own[b]) >= 0.8:
                low, high = sorted((top(a), top(b)))
                wanted[high] = low
    assert classes == {d: top(d) for d in texts} and 1 < len(set(classes.values())) < 240


def test_outlines_bound_what_two_texts_share(corpus):
    texts = [t or "" for t in corpus.values()][:150]
    idf = np.full(1 << near_dedup.SLOT_BITS, 1.2, dtype=np.float32)
    own = [near_dedup._weighted([t], idf)[:2] for t in texts]
    marks = [near_dedup.outline(x) for x in own]
    for a in range(len(texts)):
        for b in range(a):
            shared = np.minimum(marks[a], marks[b]).sum()
            every = marks[a].sum() + marks[b].sum() - shared
            if every > 0:
                assert shared / every >= near_dedup.weighted_jaccard(own[a], own[b]) - 1e-9
    for mark in [*marks, np.array([0.0, 1e-9, 3.3, 65519.9, 1e6])]:
        short = near_dedup.upper(mark).astype(np.float64)
        assert (short >= mark).all() and (short[mark < 1e4] <= mark[mark < 1e4] * 1.001 + 1e-7).all()


def test_pii(spark, corpus):
    extra = {-1: "Write to Ann.Lee+x@Mail.Example.com or ann.lee+x@mail.example.com, call +1 (212) 555-0147 or (212) 555-0147 from 10.0.25.200.", -2: "Mrs Weber met Paul Weber; Frau Weber paid with 4539 1488 0343 6467. Ольга Петрова too.", -3: None, -4: "", -5: "Version 1.2.3 has 42 parts.", -6: "GB82 WEST 1234 5698 7654 32 and 078-05-1120"}
    texts = corpus | extra
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.replace_pii(df, KEY).collect()}
    originals, shown, pairs = set(), set(), {}
    for d, text in texts.items():
        found = pii.detect(text or "")
        assert rows[d]["n_entities"] == len(found)
        if not found:
            assert rows[d]["text"] == text
            continue
        new = pii.detect(rows[d]["text"])
        assert [k for k, _, _ in new] == [k for k, _, _ in found]
        for (kind, s, e), (_, s2, e2) in zip(found, new, strict=True):
            old, now = [(k, v) for k, v, _, _ in pii._canonical(kind, text[s:e])], [v for _, v, _, _ in pii._canonical(kind, rows[d]["text"][s2:e2])]
            for (k, v), n in zip(old, now, strict=True):
                assert pairs.setdefault((k, v), n) == n and v != n
                originals.add((k, v))
                shown.add((k, n))
                if k == "card":
                    assert (pii._luhn(v) == 0) == (pii._luhn(n) == 0) and len(n) == len(v)
    assert len(shown) == len(originals) and not shown & originals
    assert pairs["given:latin:m", "Paul"].rstrip("aeiou") and rows[-2]["text"].startswith("Mrs ") and "Weber" not in rows[-2]["text"] and "Петрова" not in rows[-2]["text"]
    assert re.search("[А-Я]", rows[-2]["text"])
    crowd = spark.createDataFrame([("ip", f"{a}.{b}.1.1") for a in range(1, 10) for b in range(1, 10)], "kind string, value string")
    chosen = pii.choose_surrogates(crowd, KEY).collect()
    assert len({r["surrogate"] for r in chosen}) == 81 and not {r["surrogate"] for r in chosen} & {r["value"] for r in chosen}
    assert pii.replace_pii(odd(spark), KEY).count() == len(TEXTS) and pii.replace_pii(empty(spark), KEY).count() == 0


def test_pii_finds_emails_of_any_script(spark):
    plain = {"jörg@web.de": 0, "josé.garcia@correo.es": 0, "info@münchen.de": 0, "_john@example.com": 0, "联系user@example.com": 2, "иван@почта.рф": 0, "用户@例子.中国": 0, "jose\u0301@web.de": 0, "Jörg.İ@WEB.DE": 0}
    for text, start in plain.items():
        assert pii.detect(f"a {text}, b") == [("email", 2 + start, 2 + len(text))]
    assert pii.detect("写信到user@example.com联系我") == [("email", 3, 19)] and pii.detect("a@b and @name x@y.") == []
    rows = pii.replace_pii(spark.createDataFrame([(t, t) for t in plain], "was string, text string"), KEY).collect()
    assert len({r["text"] for r in rows}) == len(plain)
    for text, now in ((r["was"], r["text"]) for r in rows):
        start = plain[text]
        old, shown = text[start:].partition("@")[0], now[start:].partition("@")[0]
        assert now != text and len(pii.detect(now)) == 1 and old not in now and len(shown) == len(old)


def test_pii_surrogates_of_a_crowded_shape(spark):
    ips = [("ip", f"{a}.{b}.{c}.{d}") for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 8)]
    mails = [("email", f"{chr(97 + a)}@{chr(97 + b)}.de") for a in range(26) for b in range(26)]
    chosen = pii.choose_surrogates(spark.createDataFrame(ips + mails, "kind string, value string"), KEY).collect()
    originals, given = set(ips + mails), {(r["kind"], r["surrogate"]) for r in chosen}
    assert {(r["kind"], r["value"]) for r in chosen} == originals and len(given) == len(originals) and not given & originals
    for r in chosen:
        assert [k for k, _, _ in pii.detect(pii._poured(r["kind"], r["value"].upper(), r["surrogate"]))] == [r["kind"]]


def test_pii_replaces_later_mentions_of_a_name(spark):
    rows = [(1, "Mrs Weber met Paul Weber. Weber paid, and Weber's car left; then Paul slept. Weberei stays."), (2, "Robert Miller came. Miller left."), (3, "Weber alone is no entity.")]
    new = {r["doc_id"]: r for r in pii.replace_pii(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    assert [new[k]["n_entities"] for k in (1, 2, 3)] == [5, 2, 0] and new[3]["text"] == rows[2][1]
    first = re.fullmatch(r"Mrs (\w+) met (\w+) \1\. \1 paid, and \1's car left; then \2 slept\. Weberei stays\.", new[1]["text"])
    assert first and first[1] != "Weber" and first[2] != "Paul"
    assert re.fullmatch(r"\w+ (\w+) came\. \1 left\.", new[2]["text"]) and "Miller" not in new[2]["text"] and "Robert" not in new[2]["text"]


def test_pii_leaves_words_that_are_no_names():
    for text in (
        "Victoria Park opened. The Park is large; Park rules apply.",
        "Mark This page. This is it.",
        "Hans Der Mann. Der Hund.",
        "St. Helen Road was closed.",
    ):
        assert pii.detect(text) == []
    whole = lambda text: [text[s:e] for _, s, e in pii.detect(text)]
    assert whole("Mr Weber On Monday met us. On Tuesday Weber left.") == ["Mr Weber", "Weber"]
    assert whole("Mr. O'Brien, Ms McDonald and Mr SMITH-JONES; Mr Park stayed.") == ["Mr. O'Brien", "Ms McDonald", "Mr SMITH-JONES", "Mr Park"]
    new, n = pii.replace("Mr WEBER and Paul Weber", lambda kind, value: {"Weber": "Toro", "Paul": "Emil"}[value])
    assert (new, n) == ("Mr TORO and Emil Toro", 2)


def test_pii_and_secrets_in_long_texts_take_linear_time():
    text = " ".join(f"10.{i // 250}.{i % 250}.7 user{i}@mail{i % 9}.example.com" for i in range(20_000))
    start = time.perf_counter()
    assert len(pii.detect(text)) == 40_000
    rule = next(r for r in secrets.RULES if r.kind == "web_token")
    assert not rule.compiled().findall("eyJ" * 300_000)
    assert time.perf_counter() - start < 8


def test_pii_keys(spark):
    rows = spark.createDataFrame([("Mail a.person@firm.org",)], "text string")
    once, again, other = (pii.replace_pii(rows, k).first()["text"] for k in (KEY, KEY, b"another"))
    assert once == again != other
    assert pii.surrogate_key(spark) != pii.surrogate_key(spark)


def test_licenses(spark, corpus):
    planted = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "GNU General Public License, version 3.": "gpl", "Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit", "All rights reserved.": "proprietary"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = licenses.train(docs)
    for r in licenses.scan_licenses(docs, model).collect():
        want = {family for notice, family in planted.items() if notice in r["text"]}
        assert {x["family"] for x in r["licenses"]} == want
    own = [(t, f) for f, texts in licenses.TEMPLATES.items() for t in texts]
    got = licenses.scan_licenses(spark.createDataFrame(own, "text string, family string"), model).collect()
    assert sum([x["family"] for x in r["licenses"]] == [r["family"]] for r in got) / len(own) > 0.9
    talk = spark.createDataFrame([("The license of the driver was void under the terms of the fine.",), ("all rights",)], "text string")
    assert all(not r["licenses"] for r in licenses.scan_licenses(talk, model).collect())
    assert licenses.scan_licenses(odd(spark), model).count() == len(TEXTS) and licenses.scan_licenses(empty(spark), model).count() == 0


def test_licenses_inside_long_lines(spark):
    model = licenses.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    prose = " ".join(["The end of the road lay in the valley, and to the north of the river a mill stood under the trees. If you can see it, you may have a copy of the map, or the owner of this house can tell."] * 3)
    notices = {"All rights reserved.": "proprietary", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache"}
    rows = [(f"{prose} {notice} {tail}".strip(), [family]) for notice, family in notices.items() for tail in ("", prose)]
    rows += [(f"{prose} Released under the MIT License. {prose} Licensed under CC BY-NC 4.0.", ["cc-by-nc", "mit"]), (prose, [])]
    rows.append(("Released under the MIT License. Licensed under the Apache License, Version 2.0.", ["apache", "mit"]))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "text string, families array<string>"), model).collect()
    assert [sorted(x["family"] for x in r["licenses"]) for r in got] == [r["families"] for r in got]


def test_pipeline(spark):
    import corpus_pipeline as cp

    clash = {c: F.lit("x") for c in ("n_entities", "kept_id", "kept_node", "score", "predicted", "held_out", "node", "class_id")}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns(clash)
    columns, kept = docs.columns, []
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, FOLDER).cache()
        kept.append(out.count())
        if name == "packing":
            check_pieces(out.collect(), [[*ids_of(library, t), 2] for t in before.values()])
            break
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.columns == columns and set(after) <= set(before)
        assert out.select(*clash).distinct().count() == 1
        if name == "quality rules":
            assert all(before[d] and not (brute_rules(before[d])[0] < 20) for d in after)
        if name == "near-dedup":
            assert len(set(after.values())) == len(after)
        if name == "pii":
            assert set(after) == set(before) and all(after[d] == t or pii.detect(t) for d, t in before.items())
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert kept[0] >= kept[1] >= kept[2] == kept[3] > 100
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "quality rules", "near-dedup", "pii", "packing"]
