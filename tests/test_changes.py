"""Random histories of events and of folders, against a plain dictionary fold."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ravelin.functions.embedders import embed
from ravelin.operators import sync, tenancy
from ravelin.operators.transforms import sentence_chunks
from ravelin.sources import vector_table
from ravelin.streaming import feed
from tests.conftest import rows


def history(seed, n, keys=12):
    """Envelopes as a source would log them: an insert where a row is absent, else a change or a delete, with some noise."""
    rng, alive, out = random.Random(seed), {}, []
    for step in range(n):
        key = rng.randrange(keys)
        now = {"id": key, "tenant_id": f"t{key % 3}", "title": f"title {step}", "body": rng.choice(["", "some words", "ünï"])}
        if key not in alive:
            event = {"op": rng.choice("cr"), "before": None, "after": now}
        elif rng.random() < 0.3:
            event = {"op": "d", "before": alive[key], "after": None}
        else:
            event = {"op": "u", "before": alive[key], "after": now}
        if event["op"] == "d":
            alive.pop(key)
        else:
            alive[key] = now
        out.append(event)
    return out


def fold(events):
    state = {}
    for e in events:
        if e["op"] == "d":
            state.pop(e["before"]["id"], None)
        else:
            state[e["after"]["id"]] = e["after"]["title"]
    return sorted(state.items())


def raw(spark, events, start=0):
    data = [(json.dumps(e) if isinstance(e, dict) else e, start + i) for i, e in enumerate(events)]
    return spark.createDataFrame(data, "value string, seq bigint")


def alive(spark, df):
    return rows(sync.fold_events(sync.parse_events(df)).select("id", "title"), "id")


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_a_dictionary_at_any_point_and_after_replays(spark, seed):
    events = history(seed, 90)
    whole = raw(spark, events)
    for n in (1, 37, 90):
        assert alive(spark, whole.where(F.col("seq") < n)) == fold(events[:n])
    assert alive(spark, whole.unionByName(whole).repartition(7)) == fold(events)


def test_what_is_no_event_is_told_apart(spark):
    events = history(3, 20)
    noise = ["not json", "{}", '{"op": "c"}', '{"op": "d", "after": {"id": 4}}', "[1]", None]
    mixed = raw(spark, events).unionByName(raw(spark, noise, 100))
    assert alive(spark, mixed) == fold(events) and sync.parse_events(mixed).count() == 20
    reasons = dict(rows(sync.rejected_events(mixed).select("value", "rejected")))
    assert {k: reasons[k] for k in noise[:-1]} == {n: "no change envelope" if n in ("not json", "{}", "[1]") else "no row id" for n in noise[:-1]}


def test_change_lines(spark):
    row = {"id": 8, "tenant_id": "quay", "title": "tide table", "body": "b"}
    events = [{"op": op, "before": row if op == "d" else None, "after": None if op == "d" else row} for op in "rcudq"]
    bare = {"op": "d", "before": {"id": 9}, "after": None}
    lines = [r[1] for r in rows(sync.change_log(sync.parse_events(raw(spark, [*events, bare]))), "seq")]
    labels = ["SNAPSHOT", "INSERT  ", "UPDATE  ", "DELETE  ", "q       "]
    assert lines == [f"{label} doc 8 (quay)" + ("" if op == "d" else ": tide table") for label, op in zip(labels, "rcudq", strict=True)] + ["DELETE   doc 9 (None)"]


def folders(seed, n):
    """A folder's states: some files come, some change, some go."""
    rng, now = random.Random(seed), {}
    for step in range(n):
        for name in rng.sample(range(14), 4):
            doc = f"t{name % 3}/f{name}"
            if doc in now and rng.random() < 0.4:
                now.pop(doc)
            else:
                now[doc] = rng.choice([f"text of step {step} and more", "always the same"])
        yield dict(now)


def docs(spark, state):
    data = [(d, d.split("/")[0], t) for d, t in state.items()]
    return spark.createDataFrame(data, "doc_id string, tenant_id string, text string")


def test_diff_and_apply_follow_a_folder(spark):
    before, stored = {}, None
    for now in folders(4, 4):
        a, b = (sync.with_content_hash(docs(spark, s)) for s in (now, before))
        want = {d: "new" if d not in before else "deleted" if d not in now else "unchanged" if now[d] == before[d] else "changed" for d in now | before}
        diff = sync.diff_snapshot(a, b)
        assert dict(rows(diff)) == want
        report = rows(sync.sync_report(diff))
        assert {(s, d) for s, _, d in report if d} == {(s, d) for d, s in want.items() if s != "unchanged"}
        stored = embed(sentence_chunks(docs(spark, {}), 512, 50)) if stored is None else stored
        after = sync.apply_sync(stored, a, diff).select("chunk_id", "doc_id", "tenant_id", "text", "embedding")
        stored = spark.createDataFrame(after.collect(), after.schema)
        assert dict(rows(stored.select("doc_id", "text"))) == now
        counts = dict(rows(sync.point_counts(stored)))
        assert counts == {None: len(now)} | {t: sum(d.startswith(t) for d in now) for t in {d[:2] for d in now}}
        before = now


def test_one_call_keeps_the_stored_table_in_step_and_writes_nothing_without_a_change(spark, tmp_path):
    path = str(tmp_path / "table")
    for now in folders(6, 3):
        sync.sync_table(docs(spark, now), path, 64)
        assert dict(rows(vector_table.read_vectors(spark, path).select("doc_id", "text"))) == now
        named = vector_table.read_meta(spark, path)["data"]
        assert {r[0] for r in rows(sync.sync_table(docs(spark, now), path, 64).select("status"))} == {"unchanged"}
        assert vector_table.read_meta(spark, path)["data"] == named
    assert len(list((tmp_path / "table").iterdir())) == len(named.split(",")) + 1


def test_swapped_texts_are_changes(spark):
    a, b = (sync.with_content_hash(docs(spark, s)) for s in ({"t/a": "1", "t/b": "2"}, {"t/a": "2", "t/b": "1"}))
    assert rows(sync.diff_snapshot(a, b), "doc_id") == [("t/a", "changed"), ("t/b", "changed")]


def test_snapshot_round_trip(spark):
    table = spark.createDataFrame([(i, f"t{i}", f"title {i}", "b") for i in range(5)], "id bigint, tenant_id string, title string, body string")
    events = sync.parse_events(sync.snapshot_to_events(table)).withColumn("seq", F.lit(0))
    assert {r[0] for r in rows(events.select("op"))} == {"r"}
    assert rows(sync.fold_events(events).select(*table.columns), "id") == rows(table, "id")


def drain(spark, source, log, progress, schema=None, **options):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source) if schema else feed.file_source(spark, source, 1)
    feed.stream_apply(stream, log, progress, **options).awaitTermination()
    return rows(feed.current_state(feed.read_log(spark, log)).select("id", "text"), "id")


def texts(events):
    last = {(e["after"] or e["before"])["id"]: e for e in events}
    return [(k, f"{e['after']['title']}\n\n{e['after']['body']}") for k, e in sorted(last.items()) if e["op"] != "d"]


def test_stream_follows_the_feed_and_sets_bad_events_aside(spark, tmp_path):
    source, log, progress = (str(tmp_path / n) for n in ("in", "log", "progress"))
    events = history(9, 60, keys=6)
    raw(spark, [*events[:25], "not json", None]).coalesce(1).write.mode("append").parquet(source)
    assert drain(spark, source, log, progress) == texts(events[:25])
    raw(spark, events[10:], 10).coalesce(1).write.mode("append").parquet(source)  # fifteen of them a second time
    assert drain(spark, source, log, progress) == texts(events)
    assert [r[0] for r in rows(spark.read.parquet(f"{log}-rejected").select("value"))] == ["not json"]
    raw(spark, events[:40]).coalesce(1).write.mode("append").parquet(source)  # all seen before
    assert drain(spark, source, log, progress, trigger={"availableNow": True}) == texts(events)
    compacted = feed.current_state(feed.compact(spark, log, str(tmp_path / "compact")))
    assert rows(compacted.select("id", "text"), "id") == texts(events)


def test_late_and_replayed_events_of_two_partitions_give_one_state(spark, tmp_path):
    rng = random.Random(11)
    events = history(12, 80, keys=8)
    # Each row stays on a partition, whose clock may go back; files mix the partitions, come late, and come again.
    fed = [(json.dumps(e), 1_000 + rng.randrange(5), (e["after"] or e["before"])["id"] % 2, i) for i, e in enumerate(events)]
    schema = "value string, seq bigint, part int, place bigint"
    files = [[r for r in fed if r[3] % 2 == 0 or r[3] < 30], [r for r in fed if r[3] < 60], fed[:20], fed, fed[40:]]
    for replay in (0, 1):
        source, log, progress = (str(tmp_path / f"{n}{replay}") for n in ("in", "log", "progress"))
        order = files if not replay else [fed, *files[::-1]]
        for some in order:
            spark.createDataFrame(rng.sample(some, len(some)), schema).coalesce(1).write.mode("append").parquet(source)
        # a place that was passed over counts as late, so the whole feed comes first or each partition's last events do
        state = drain(spark, source, log, progress, schema)
        last = {}
        for e, r in zip(events, fed, strict=True):
            last[(e["after"] or e["before"])["id"]] = e
        assert state == texts(events)


def test_retrieval_follows_the_change(spark):
    events = [
        {"op": "c", "before": None, "after": {"id": 5, "tenant_id": "quay", "title": "old berth list", "body": "b"}},
        {"op": "c", "before": None, "after": {"id": 6, "tenant_id": "dock", "title": "rope store", "body": "b"}},
        {"op": "u", "before": None, "after": {"id": 5, "tenant_id": "quay", "title": "berth list for winter", "body": "b"}},
        {"op": "d", "before": {"id": 6, "tenant_id": "dock"}, "after": None},
    ]
    asked = spark.createDataFrame([("w", "winter berth", ["quay"]), ("x", "rope store", ["dock"])], "query_id string, text string, tenants array<string>")
    got = rows(sync.retrieve_after_change(asked, sync.parse_events(raw(spark, events))).select("query_id", "chunk_id", "text"), "query_id")
    assert got == [("w", "pg-5", "berth list for winter\n\nb"), ("x", None, None)]


def test_time_claims_are_read_at_the_top_level_only(spark):
    base = '"iss": "i", "aud": "a", "groups": ["g"]'
    claims = [f'{{{base}, "exp": {x}}}' for x in ("99999999999", '"99999999999"', "5", "[9e9]", "1e11", "true")] + [f'{{{base}, "exp": "99999999999", "x": {{"exp": 5}}}}', f"{{{base}}}"]
    scopes = tenancy.claims_to_scope(spark.createDataFrame([(i, c) for i, c in enumerate(claims)], "n int, claims string"), "i", "a", F.lit(1_700_000_000))
    assert [r[1] for r in rows(scopes.select("n", "rejected"), "n")] == [None, "unreadable time", "expired", "unreadable time", None, "unreadable time", "unreadable time", None]


def test_hash_travels_with_the_chunks(spark, tmp_path, monkeypatch):
    """stored chunks are not joined with all texts again; a chunker that drops the hash gets it by a join."""
    written, write = [], vector_table.write_vectors
    monkeypatch.setattr(vector_table, "write_vectors", lambda df, *a, **o: (written.append(df), write(df, *a, **o))[1])
    now = docs(spark, {"t/a": "one. two", "t/b": "three"})
    sync.sync_table(now, str(tmp_path / "own"), 64)
    bare = lambda d, size, overlap: sentence_chunks(d.select("doc_id", "tenant_id", "text"), size, overlap)
    sync.sync_table(now, str(tmp_path / "bare"), 64, chunker=bare)
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("Join ") for df in written]
    assert joins[0] == 1 < joins[1]
    columns = ["chunk_id", "text", "content_hash"]
    assert rows(written[0].select(columns), "chunk_id") == rows(written[1].select(columns), "chunk_id")
