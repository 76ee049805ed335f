"""Continuous change feed: source -> state of each row id -> micro-batches -> change log -> latest-wins state.

The log is append-only: one directory per micro-batch, overwritten as a whole, so a batch replayed
after a failure leaves the same rows. Spark records the batch as done only after the write returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.functions.embedders import Embedder, embed
from ravelin.operators.sync import latest_events, parsed_or_rejected
from ravelin.operators.transforms import row_to_document


def kafka_source(spark: SparkSession, servers: str, topic: str, per_trigger: int = 1_000_000) -> DataFrame:
    """The change topic from its beginning, at most `per_trigger` events a batch: (value, seq, part, place).

    `seq` is the event's time, `part` its partition and `place` its offset there.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("seq"), F.col("partition").alias("part"), F.col("offset").alias("place"))


def file_source(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same envelope from parquet files with columns (value, seq)."""
    return spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", files_per_batch).parquet(path)


#: Events that are none share their state among so many keys; nothing is kept for them.
REJECTED_KEYS = 64
_ROW = "id long, tenant_id string, title string, body string, updated_at timestamp"
_OUT = f"rejected string, value string, op string, {_ROW}, seq long, version long"
_COLUMNS = ["rejected", "value", "op", "id", "tenant_id", "title", "body", "updated_at", "seq", "version"]
_STATE = "parts array<int>, places array<long>, part int, seq long, version long"


def _follow(key, frames, state):
    """The newest event of one row id in this batch, if it is newer than all before it; rejected ones as they are.

    Within a partition the later place wins and a place seen before is a replay; between partitions the later time, then
    the greater partition. `version` counts the events that won, so it orders the log whatever the clocks say.
    """
    if key[0] is None:
        for frame in frames:
            yield frame.assign(version=0)[_COLUMNS]
        return
    parts, places, part, seq, version = state.get if state.exists else ([], [], -1, -(2**63), 0)
    last, best = dict(zip(parts, places, strict=True)), None
    for frame in frames:
        ordered = frame.sort_values(["part", "place"], kind="stable")
        for row, own, place, time in zip(range(len(ordered)), ordered["part"].tolist(), ordered["place"].tolist(), ordered["seq"].tolist(), strict=True):
            if place <= last.get(own, -(2**63)):
                continue
            last[own] = place
            if own == part or (time, own) > (seq, part):
                part, seq, best = own, time, ordered.iloc[[row]]
    if best is not None:
        version += 1
    state.update((list(last), list(last.values()), part, seq, version))
    if best is not None:
        yield best.assign(version=version)[_COLUMNS]


def newest_events(stream: DataFrame) -> DataFrame:
    """Of every batch each row id's event that is newer than all that were seen, and the rejected ones.

    `stream` has (value, seq) and, where the source has partitions, (part, place). The last place of each partition is
    kept for each row id, so late and replayed events change nothing in whatever batch they come.
    """
    if "part" not in stream.columns:
        stream = stream.withColumns({"part": F.lit(0), "place": F.col("seq")})
    rows = parsed_or_rejected(stream)
    kept = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    good = F.col("rejected").isNull()
    fields = [F.when(good, kept[c]).alias(c) for c in ("id", "tenant_id", "title", "body", "updated_at")]
    salt = F.when(~good, F.pmod(F.xxhash64("value"), F.lit(REJECTED_KEYS))).otherwise(F.lit(0))
    flat = rows.select("rejected", F.when(~good, F.col("value")).alias("value"), "op", *fields, "seq", "part", "place", salt.alias("_salt"))
    return flat.groupBy("id", "_salt").applyInPandasWithState(_follow, _OUT, _STATE, "append", "NoTimeout")


def log_rows(newest: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """The log's rows of a batch: those that live on carry their document and vector."""
    last = newest.where("rejected is null").withColumn("deleted", F.col("op") == "d")
    fields = [F.when(~F.col("deleted"), F.col(c)).alias(c) for c in ("tenant_id", "title", "body")]
    docs = row_to_document(last.select("id", "seq", "version", "deleted", *fields), "seq", "version", "deleted", F.col("id").alias("_row"))
    indexed = embed(docs, embedder=embedder)
    alive = [F.when(~F.col("deleted"), F.col(c)).alias(c) for c in ("doc_id", "tenant_id", "title", "text", "embedding")]
    return indexed.select(F.col("_row").alias("id"), "seq", "version", "deleted", *alive)


def log_batch(events: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """A table of events as log rows: the last one of each row id by `seq`, which is its version too."""
    last = latest_events(events)
    row = F.col("after")
    flat = last.select(F.lit(None).cast("string").alias("rejected"), "op", "id", *(row[c].alias(c) for c in ("tenant_id", "title", "body")), "seq", F.col("seq").alias("version"))
    return log_rows(flat, embedder)


def stream_apply(stream: DataFrame, path: str, checkpoint: str, embedder: Embedder | None = None, trigger: dict | None = None, rejected: str | None = None):
    """Feed the log at `path`; returns the running query.

    `trigger` is that of a stream writer, such as {"processingTime": "30 seconds"}; by default what is there is drained
    and the query ends. Events that cannot be read go to the folder `rejected` (by default `<path>-rejected`), one
    directory a batch.
    """
    refused = rejected or f"{path.rstrip('/')}-rejected"

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        log_rows(batch, embedder).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.where("rejected is not null").select("value", "seq", "rejected").write.mode("overwrite").parquet(f"{refused}/batch={batch_id}")
        batch.unpersist()

    return (
        newest_events(stream)
        .writeStream.outputMode("append")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def current_state(log: DataFrame) -> DataFrame:
    """Latest entry per row id over all batches, deleted rows left out."""
    columns = [c for c in log.columns if c not in ("id", "batch")]
    last = log.groupBy("id").agg(F.max_by(F.struct(*columns), "version").alias("_l")).select("id", "_l.*")
    return last.where(~F.col("deleted")).drop("deleted")


def compact(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Write the current state, tombstones kept, as the first batch of a fresh log at `target`."""
    log = read_log(spark, path)
    columns = [c for c in log.columns if c not in ("id", "batch")]
    last = log.groupBy("id").agg(F.max_by(F.struct(*columns), "version").alias("_l")).select("id", "_l.*")
    last.write.mode("overwrite").parquet(f"{target}/batch=-1")
    return read_log(spark, target)
