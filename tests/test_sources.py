import json
import os

import pytest
from pyspark.sql import functions as F

from ravelin.sources import files, media, vector_table
from ravelin.operators.transforms import count_by_modality, require_reconciled
from tests.conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_text_json_csv_and_corpus(spark, tmp_path):
    write(tmp_path / "t" / "a.txt", "alpha\nbeta")
    write(tmp_path / "t" / "b.md", "gamma")
    write(tmp_path / "t" / "c.log", "ignored")
    write(tmp_path / "j" / "x.json", json.dumps([{"id": i, "name": f"n{i}", "tags": ["p", "q"]} for i in range(5)]))
    write(tmp_path / "c" / "m.csv", 'name,range\ncosine,"[-1, 1]"\ndot,"any ""real"""\neuclid,[0\n')
    text = files.load_text(spark, str(tmp_path / "t"))
    assert rows(text.select("file_name", "text", "modality"), "file_name") == [("a.txt", "alpha\nbeta", "text"), ("b.md", "gamma", "text")]
    docs = rows(files.load_json(spark, str(tmp_path / "j")).select("text", "doc_id"), "doc_id")
    assert len(docs) == 5 and docs[0][0] == "id: 0\nname: n0\ntags: p, q" and docs[0][1].endswith("x.json#0")
    csv = rows(files.load_csv(spark, str(tmp_path / "c")).select("text"), "doc_id")
    assert [c[0] for c in csv] == ["cosine, [-1, 1]", 'dot, any "real"', "euclid, [0"]
    corpus = files.load_corpus(spark, str(tmp_path / "t"), str(tmp_path / "j"), str(tmp_path / "c"))
    assert rows(count_by_modality(corpus)) == [("csv", 3), ("json", 5), ("text", 2)]
    assert rows(count_by_modality(corpus.withColumn("modality", F.lit(None).cast("string")))) == [("unknown", 10)]


def test_every_csv_has_its_own_header(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,2\n")
    write(tmp_path / "b.csv", 'p,q,"r,s"\n5,6,7\n')
    write(tmp_path / "c.csv", "only\n8\n")
    assert [r[0] for r in rows(files.load_csv(spark, str(tmp_path)).select("text"), "text")] == ["1, 2", "5, 6, 7", "8"]


def test_json_that_is_no_object_is_rejected_and_lines_are_read(spark, tmp_path):
    write(tmp_path / "good.json", '{"k": 1}')
    write(tmp_path / "bad.json", '{"k": ')
    write(tmp_path / "l.jsonl", '{"k": 1}\n{"k": 2}\n')
    assert [r[0] for r in rows(files.load_json(spark, str(tmp_path)).select("text"))] == ["k: 1"]
    assert [r[0].split("/")[-1] for r in rows(files.rejected_json(spark, str(tmp_path)).select("file_path"))] == ["bad.json"]
    assert sorted(r[0] for r in rows(files.load_json(spark, str(tmp_path), lines=True).select("text"))) == ["k: 1", "k: 2"]


def test_shared_folder_is_asked_for_on_a_cluster():
    from ravelin.session import require_local

    require_local("local[8]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        require_local("spark://host:7077")


def test_missing_and_empty_directories(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for load in (files.load_text, files.load_json, files.load_csv):
        assert load(spark, str(tmp_path / "absent")).count() == 0
        assert load(spark, str(tmp_path / "empty")).count() == 0
    assert files.load_tenant_tree(spark, str(tmp_path / "absent")).count() == 0


def test_tenant_tree(spark, tmp_path):
    tmp_path = tmp_path / "it's"
    write(tmp_path / "acme" / "a.txt", "alpha")
    write(tmp_path / "acme" / "deep" / "a b+c.txt", "nested")
    write(tmp_path / "globex" / "g.txt", "gamma")
    write(tmp_path / "stray.txt", "no tenant")
    tree = files.load_tenant_tree(spark, str(tmp_path))
    assert rows(tree.select("doc_id", "tenant_id"), "doc_id") == [("acme/a.txt", "acme"), ("acme/deep/a b+c.txt", "acme"), ("globex/g.txt", "globex")]
    assert files.load_tenant_tree(spark, str(tmp_path), recursive=False).count() == 2


def test_media_cache(spark, tmp_path):
    clip, cache, calls = tmp_path / "m" / "Clip.MP3", str(tmp_path / "cache"), tmp_path / "calls"
    write(clip, "x" * 10)
    write(tmp_path / "m" / "note.txt", "not media")
    calls.mkdir()
    folder = str(calls)

    def producer(path, content):
        open(os.path.join(folder, str(len(os.listdir(folder)))), "w").close()
        if len(content) == 5:
            raise RuntimeError("no credits")
        return f"{len(content)} bytes"

    run = lambda: rows(media.extract_and_remember(spark, media.media_files(spark, str(tmp_path / "m"), "audio"), producer, "audio", cache).select("text", "modality", "cached"))
    assert run() == [("10 bytes", "audio", False)]
    assert run() == [("10 bytes", "audio", True)] and len(list(calls.iterdir())) == 1
    clip.write_text("y" * 20)
    assert run() == [("20 bytes", "audio", False)] and len(list(calls.iterdir())) == 2
    clip.write_text("z" * 5)
    assert run() == [] and run() == [] and len(list(calls.iterdir())) == 4  # failures are not cached


def test_a_file_of_several_pages_gives_as_many_documents(spark, tmp_path):
    for name, content in {"a.pdf": "one|two|three", "b.pdf": "x||y", "c.pdf": "", "d.pdf": "bad"}.items():
        write(tmp_path / "m" / name, content)

    def producer(path, content):
        if content == b"bad":
            raise RuntimeError("broken file")
        return [text or None for text in content.decode().split("|")] if content else []

    cache = str(tmp_path / "cache")
    found = lambda: media.extract_and_remember(spark, media.media_files(spark, str(tmp_path / "m"), "pdf"), producer, "pdf", cache, pages=True)
    shape = lambda df: rows(df.select("file_name", "page", "text", "cached"), "file_name", "page")
    want = [("a.pdf", 0, "one"), ("a.pdf", 1, "two"), ("a.pdf", 2, "three"), ("b.pdf", 0, "x"), ("b.pdf", 2, "y")]
    first = found()
    assert shape(first) == [(*row, False) for row in want]
    assert all(r["doc_id"] == f"{r['file_path']}#{r['page']}" for r in first.collect())
    assert shape(found()) == [(*row, True) for row in want]


def test_vector_table_guards(spark, tmp_path):
    path = str(tmp_path / "v")
    wide = spark.createDataFrame([("a", "t1", [1.0, 0.0]), ("b", "2", [0.0, 1.0])], "chunk_id string, tenant_id string, embedding array<float>")
    thin = wide.withColumn("embedding", F.slice("embedding", 1, 1))
    stored = vector_table.write_vectors(wide, path, 2, normalized=True, multitenant=True)
    assert stored.count() == 2 and dict(stored.dtypes)["tenant_id"] == "string"
    assert vector_table.read_meta(spark, path)["metric"] == "dot_product"
    require_reconciled(wide, stored, "chunk_id")
    with pytest.raises(RuntimeError, match="2 rows produced but 1 stored"):
        require_reconciled(wide, stored.limit(1), "chunk_id")
    with pytest.raises(ValueError, match="has 2 dimensions, the given rows 1"):
        vector_table.write_vectors(thin, path, 1, recreate=False)
    more = spark.createDataFrame([("b", "2", [1.0, 0.0]), ("c", "t1", [0.0, 1.0])], wide.schema)
    added = vector_table.write_vectors(more, path, 2, recreate=False)
    assert rows(added.select("chunk_id", "embedding"), "chunk_id") == [("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])]
    assert vector_table.read_meta(spark, path)["rows"] == 3
    stored = vector_table.write_vectors(wide, path, 2, normalized=True, multitenant=True)
    assert vector_table.open_or_build(spark, path, lambda: thin, 2).count() == 2  # reused, not built
    assert vector_table.open_or_build(spark, path, lambda: thin, 1).count() == 2  # other dimension: rebuilt
    assert vector_table.read_meta(spark, path)["dim"] == 1
    with pytest.raises(Exception, match="expected 3 dimensions, found 2"):
        vector_table.write_vectors(wide, str(tmp_path / "bad"), 3)
    with pytest.raises(Exception, match="not a unit vector"):
        vector_table.write_vectors(wide.withColumn("embedding", F.transform("embedding", lambda x: x * 2)), str(tmp_path / "long"), 2, normalized=True)


def test_tenant_filter_prunes_partitions(spark, tmp_path):
    rows_ = spark.createDataFrame([("a", "t1", [1.0]), ("b", "t2", [1.0])], "chunk_id string, tenant_id string, embedding array<float>")
    stored = vector_table.write_vectors(rows_, str(tmp_path / "v"), 1, multitenant=True)
    plan = stored.where("tenant_id in ('t1')")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan or "PartitionFilters: [(tenant_id" in plan


def test_adding_rows_writes_only_them(spark, tmp_path):
    path = str(tmp_path / "v")
    many = spark.range(4_000).select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.array(F.col("id").cast("float"), F.rand(3).cast("float")).alias("embedding"))
    size = lambda: {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in (tmp_path / "v").iterdir() if p.name != "meta"}
    vector_table.write_vectors(many, path, 2)
    before = size()
    few = many.where("chunk_id like 'c1_'").withColumn("embedding", F.array(F.lit(-1.0).cast("float"), F.lit(0.0).cast("float")))
    table = vector_table.write_vectors(few, path, 2, recreate=False)
    after = size()
    assert all(after[n] == before[n] for n in before) and sum(after.values()) - sum(before.values()) < 0.2 * sum(before.values())
    assert table.count() == 4_000 and table.where("embedding[0] = -1").count() == 10
    gone = vector_table.delete_vectors(few.select("chunk_id"), path)
    assert gone.count() == 3_990 == vector_table.read_meta(spark, path)["rows"] and vector_table.remove_old(spark, path) == []
    twice = few.unionByName(few)
    back = vector_table.write_vectors(twice, path, 2, recreate=False)
    assert back.count() == 4_000 and back.select("chunk_id").distinct().count() == 4_000
    whole = vector_table.compact_vectors(spark, path)
    assert rows(whole.select("chunk_id"), "chunk_id") == rows(back.select("chunk_id"), "chunk_id")
    assert len(vector_table.remove_old(spark, path)) == 4 and len(size()) == 1 and vector_table.read_vectors(spark, path).count() == 4_000


def test_loaders_lose_nothing(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "long.csv").write_text('a,b\n1,2,3\n"x,\ny,z",w,v,u,t\n')
    alone = [r[0] for r in rows(files.load_csv(spark, str(folder)).select("text"), "text")]
    assert alone == ["1, 2, 3", "x,\ny,z, w, v, u, t"]
    (folder / "wide.csv").write_text("a,b,c,d,e,f\n1,2,3,4,5,6\n")
    assert set(alone) < {r[0] for r in rows(files.load_csv(spark, str(folder)).select("text"))}
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "bad.json").write_text('{"a": 1')
    (folder / "list.json").write_text('["x", "y"]')
    (folder / "none.json").write_text('{"a": null}')
    (folder / "good.json").write_text('[{"a": 7}]')
    for schema in (None, "a long"):
        schema = schema and spark.createDataFrame([], schema).schema
        assert [r[0] for r in rows(files.load_json(spark, str(folder), schema).select("text"), "text")] == ["", "a: 7"]
    assert {r[0].rsplit("/", 1)[1] for r in rows(files.rejected_json(spark, str(folder)).select("file_path"))} == {"bad.json", "list.json"}
