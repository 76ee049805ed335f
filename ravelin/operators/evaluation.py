"""Measurements over hits, labels and run logs."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.operators.approximate import CellIndex, probe_cells
from ravelin.operators.nearest import ranked
from ravelin.operators.ordering import exact_quantiles
from ravelin.operators.quantization import Codes, pair_scores, quantized_topk
from ravelin.operators.transforms import assemble_context, best_per
from ravelin.session import checkpointed


def recall_at_k(found: DataFrame, truth: DataFrame, keys: Sequence[str] = (), item_id: str = "chunk_id") -> DataFrame:
    """Mean over the truth's queries of |found ∩ truth| / |truth|, for every value of `keys` in `found`.

    A query without hits adds nothing to the sum and still counts in the mean.
    """
    keys = list(keys)
    wanted = checkpointed(truth.select("query_id", item_id).distinct())  # read three times below; the search behind it runs once
    size = wanted.groupBy("query_id").agg(F.count("*").alias("_t"))
    asked = size.count()
    flagged = found.select(*keys, "query_id", item_id).distinct().join(
        wanted.withColumn("_hit", F.lit(1)), ["query_id", item_id], "left"
    )
    by_query = flagged.groupBy(*keys, "query_id").agg(F.count("_hit").alias("_h")).join(size, "query_id")
    return by_query.groupBy(*keys).agg((F.sum(F.col("_h") / F.col("_t")) / F.lit(asked)).alias("recall"))


def config_hits(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    kinds: Sequence[str] = ("none", "scalar", "binary"),
    oversamplings: Sequence[float] = (1.0, 2.0, 4.0),
    metric: str = "dot_product",
    index: CellIndex | None = None,
    probes: Sequence[int | None] = (None,),
) -> DataFrame:
    """Hits of every (kind, rescore, oversampling, probes): one code search per kind and number of probed cells.

    Every setting is a prefix of that search. `probes` None scans all codes; a number needs `index`.
    """
    out = None
    for kind in kinds:
        carry = ["cell"] if index else []
        table = Codes(kind, index.items if index else items, carry=carry)
        settings = [(False, None)] if kind == "none" else [(False, None)] + [(True, o) for o in oversamplings]
        widest = _wide(k, max(oversamplings)) if kind != "none" else k
        for cells in probes:
            asked = queries if cells is None else probe_cells(queries, index, cells)
            wide = checkpointed(table.topk(asked, widest, key=None if cells is None else "cell"))
            if len(settings) > 1:  # the widest list's pairs are scored once; every setting takes its part of them
                scored = checkpointed(pair_scores(wide.withColumnRenamed("rank", "_place"), queries, items, metric, carry=["_place"]))
            for rescore, oversampling in settings:
                if rescore:
                    hits = ranked(scored.where(F.col("_place") <= _wide(k, oversampling)), k, ["query_id"])
                else:
                    hits = wide.where(F.col("rank") <= k)
                rows = hits.select(
                    F.lit(kind).alias("quantization"),
                    F.lit(rescore).alias("rescore"),
                    F.lit(oversampling).cast("double").alias("oversampling"),
                    F.lit(cells).cast("int").alias("probes"),
                    "query_id",
                    "chunk_id",
                )
                out = rows if out is None else out.unionByName(rows)
    return out


def _wide(k: int, oversampling: float) -> int:
    return -int(-k * oversampling // 1)


def ann_sweep(hits: DataFrame, truth: DataFrame, keys: Sequence[str] = ("quantization", "rescore", "oversampling")) -> DataFrame:
    """Recall of every configuration against one exact search, rounded to 3 digits."""
    known = checkpointed(hits.withColumn("_config", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))
    by_config = recall_at_k(known, truth, ["_config"])
    names = known.select("_config", *keys).distinct()
    return by_config.join(F.broadcast(names), "_config").select(*keys, F.round("recall", 3).alias("recall"))


def code_configs(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    kinds: Sequence[str] = ("none", "scalar", "binary"),
    oversamplings: Sequence[float] = (2.0,),
    metric: str = "dot_product",
) -> dict[str, Callable[[], DataFrame]]:
    """Searches for `timed_sweep` by name: each kind's codes alone, and re-scored at each oversampling. Codes are stored first."""
    out = {}
    for kind in kinds:
        codes = Codes(kind, items)
        codes.table = checkpointed(codes.table)
        out[kind] = partial(codes.topk, queries, k)
        if kind != "none":
            for o in oversamplings:
                out[f"{kind} x{float(o)}"] = partial(quantized_topk, queries, items, codes, k, o, metric=metric)
    return out


def timed_sweep(
    configs: Mapping[str, Callable[[], DataFrame]],
    truth: DataFrame,
    repeats: int = 3,
    item_id: str = "chunk_id",
    clock: Callable[[], float] = time.perf_counter,
) -> DataFrame:
    """Recall and latency of named searches, as rows (config_id, recall, latency_ms) that `best_config` takes.

    Each search runs once to warm up, which also gives its hits, and then `repeats` times in full; the latency is the
    median run divided by the questions of the truth. A search without hits has recall 0.
    """
    spark, log, hits = truth.sparkSession, [], None
    truth = checkpointed(truth.select("query_id", item_id))  # counted here and compared below; the search behind it runs once
    asked = truth.select("query_id").distinct().count()
    for name, run in configs.items():
        for turn in range(repeats + 1):
            start = clock()
            if turn:
                run().write.format("noop").mode("overwrite").save()
            else:
                first = checkpointed(run().select(F.lit(name).alias("config_id"), "query_id", item_id))
            log.append((name, turn, clock() - start))
        hits = first if hits is None else hits.unionByName(first)
    spent = median_after_warmup(spark.createDataFrame(log, "series string, run int, seconds double"), 1)
    recall = recall_at_k(hits, truth, ["config_id"], item_id)
    return spent.withColumnRenamed("series", "config_id").join(recall, "config_id", "left").select(
        "config_id",
        F.round(F.coalesce("recall", F.lit(0.0)), 3).alias("recall"),
        F.round(F.col("median_s") * 1000 / F.lit(max(asked, 1)), 6).alias("latency_ms"),
    )


def best_config(rows: DataFrame, target: float = 0.95) -> DataFrame:
    """The fastest configuration whose rounded recall reaches the target; an empty result when none does."""
    eligible = rows.where(F.col("recall") >= target)
    return eligible.orderBy("latency_ms", "config_id").limit(1)


def fact_found(hits: DataFrame, labels: DataFrame, order: str = "rank") -> DataFrame:
    """Per labelled question: does the retrieved text hold the expected fact (any case)? No hits is a miss."""
    contexts = assemble_context(hits, order)
    joined = labels.join(contexts, "query_id", "left")
    return joined.select("query_id", F.coalesce(F.contains(F.lower("context"), F.lower("expected")), F.lit(False)).alias("found"))


def fact_recall(hits: DataFrame, labels: DataFrame, order: str = "rank") -> DataFrame:
    return fact_found(hits, labels, order).agg(F.avg(F.col("found").cast("int")).alias("recall"))


def compare_strategies(strategies: Sequence[tuple[str, DataFrame, int]], labels: DataFrame) -> DataFrame:
    """One row per (name, hits, extra model calls per query), in order: recall to 2 digits."""
    out = None
    for ord_, (name, hits, calls) in enumerate(strategies):
        row = fact_recall(hits, labels).select(
            F.lit(ord_).alias("ord"), F.lit(name).alias("strategy"), F.round("recall", 2).alias("recall"), F.lit(calls).alias("extra_calls")
        )
        out = row if out is None else out.unionByName(row)
    return out


def best_strategy(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("recall"), "extra_calls", "ord").limit(1)


def out_of_scope_rate(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """Share of unanswerable questions that still get a hit."""
    answered = questions.select("query_id").join(hits.select("query_id").distinct().withColumn("_hit", F.lit(1)), "query_id", "left")
    return answered.agg((F.count("_hit") / F.count("*")).alias("rate"))


def cutoff_sweep(hits: DataFrame, labels: DataFrame, oos_hits: DataFrame, oos: DataFrame, cutoffs: Sequence[float]) -> DataFrame:
    """In-scope recall and out-of-scope rate at each cutoff, with the recommended cutoff on every row.

    Recommended: among the rows that keep the first row's recall, the lowest cutoff of those with the
    least noise. The cutoffs travel inside each hit as an array filtered by its score.
    """
    grid = F.array(*[F.lit(float(c)) for c in cutoffs])

    def kept(rows: DataFrame) -> DataFrame:
        return rows.withColumn("cutoff", F.explode(F.filter(grid, lambda c: F.col("score") >= c)))

    contexts = (
        kept(hits)
        .groupBy("query_id", "cutoff")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda h: h["text"]), " ").alias("context"))
    )
    found = (
        contexts.join(labels, "query_id")
        .where(F.contains(F.lower("context"), F.lower("expected")))
        .groupBy("cutoff")
        .agg(F.count("*").alias("_found"))
    )
    noisy = kept(oos_hits).join(oos.select("query_id"), "query_id", "left_semi")
    answered = noisy.groupBy("cutoff").agg(F.count_distinct("query_id").alias("_answered"))
    asked, unanswerable = labels.count(), oos.count()
    spark = hits.sparkSession
    table = spark.createDataFrame([(i, float(c)) for i, c in enumerate(cutoffs)], "ord int, cutoff double")
    rows = (
        table.join(found, "cutoff", "left")
        .join(answered, "cutoff", "left")
        .select(
            "ord",
            "cutoff",
            F.round(F.coalesce("_found", F.lit(0)) / F.lit(asked), 2).alias("in_scope_recall"),
            F.round(F.coalesce("_answered", F.lit(0)) / F.lit(unanswerable), 2).alias("out_of_scope_answered"),
        )
    )
    every = Window.partitionBy(F.lit(1))  # one row per cutoff
    full = F.min_by("in_scope_recall", "ord").over(every)
    safe = rows.withColumn("_safe", F.col("in_scope_recall") >= full)
    quiet = safe.withColumn("_quiet", F.min(F.when(F.col("_safe"), F.col("out_of_scope_answered"))).over(every))
    pick = F.min(F.when(F.col("_safe") & (F.col("out_of_scope_answered") == F.col("_quiet")), F.col("cutoff"))).over(every)
    return quiet.select("cutoff", "in_scope_recall", "out_of_scope_answered", pick.alias("recommended"))


def context_recall(runs: DataFrame, examples: DataFrame) -> DataFrame:
    """1 where the expected keyword appears in the run's joined contexts (any case); no keyword scores 0."""
    joined = runs.join(examples, "query_id")
    text = F.lower(F.array_join("contexts", " "))
    hit = (F.coalesce(F.length("expected_keyword"), F.lit(0)) > 0) & F.contains(text, F.lower("expected_keyword"))
    return joined.select("query_id", F.coalesce(hit, F.lit(False)).cast("int").alias("score"))


def judge_score(raw: Column) -> Column:
    """A judge's reply as a score in [0, 1]; what does not parse (or is not a number) scores 0."""
    value = F.trim(raw).try_cast("double")
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(clamped)


def parse_judge_score(rows: DataFrame, raw: str = "raw_score") -> DataFrame:
    return rows.withColumn("score", judge_score(F.col(raw)))


def run_summary(run_log: DataFrame) -> DataFrame:
    """Per mode: wall seconds, queries/s, p50 and p95 of successful latencies, errors.

    `run_log` holds (mode, started, latency, ok), times in seconds; wall time runs from the first start to the last end.
    """
    base = run_log.groupBy("mode").agg(
        (F.max(F.col("started") + F.col("latency")) - F.min("started")).alias("_wall"),
        F.count("*").alias("queries"),
        F.count_if(~F.col("ok")).alias("errors"),
    )
    spread = exact_quantiles(run_log.where("ok"), ["mode"], "latency", [0.5, 0.95]).drop("n")
    return base.join(spread, "mode", "left").select(
        "mode",
        F.round("_wall", 1).alias("wall_s"),
        F.round(F.when(F.col("_wall") > 0, F.col("queries") / F.col("_wall")), 2).alias("queries_per_s"),
        F.round("q0", 1).alias("p50_s"),
        F.round("q1", 1).alias("p95_s"),
        "errors",
    )


def speedup(rows: DataFrame, seconds: str = "seconds", work: str | None = None) -> DataFrame:
    """First row's rounded seconds over each row's, to 2 digits (null at 0 s); with `work`, also work per second.

    The measurement table has one row per strategy.
    """
    base = F.first(seconds).over(Window.partitionBy(F.lit(1)).orderBy("ord"))
    out = rows.withColumn("speedup", F.round(F.when(F.col(seconds) > 0, base / F.col(seconds)), 2))
    if work:
        out = out.withColumn(f"{work}_per_sec", F.round(F.when(F.col(seconds) > 0, F.col(work) / F.col(seconds)), 1))
    return out


def median_after_warmup(run_log: DataFrame, warmup: int = 1) -> DataFrame:
    """Median seconds of each series without its first `warmup` runs; log of (series, run, seconds)."""
    first = best_per(run_log, ["series"], [F.asc("run")], warmup).select("series", "run")
    return exact_quantiles(run_log.join(first, ["series", "run"], "left_anti"), ["series"], "seconds", [0.5]).select(
        "series", F.col("q0").alias("median_s")
    )


def tool_calls_per_run(event_log: DataFrame, tool_type: str) -> DataFrame:
    """Tool calls and duration in seconds of each run; log of (run, type, at), `at` in seconds."""
    return event_log.groupBy("run").agg(
        F.count_if(F.col("type") == tool_type).alias("tool_calls"), F.round(F.max("at") - F.min("at"), 1).alias("seconds")
    )
