"""Headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from ravelin import plans  # noqa: E402
from ravelin.functions.embedders import embed  # noqa: E402
from ravelin.operators.transforms import sentence_chunks  # noqa: E402
from ravelin.plans import inputs  # noqa: E402
from ravelin.session import build_session  # noqa: E402

HEADLINE = (
    "topk_cosine",
    "compare_metrics",
    "rescored_topk_scalar",
    "rescored_topk_binary",
    "ann_topk",
    "topk_text",
    "tenant_topk",
    "fuse_rrf",
    "recursive_topk",
    "rerank_bm25",
    "fan_out",
    "walk",
    "build_graph",
    "diff_snapshot",
    "apply_sync",
    "fold_events",
    "stream_apply",
    "cutoff_sweep",
    "run_summary",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk and embed the whole corpus."""
    return embed(sentence_chunks(inputs.documents(spark, folder), 512, 50))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]", cpus, **{"spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans.load_all()
    run(embed(inputs.questions(spark, folder)))  # start the session and the Python workers
    timed = {"ingest": ingest, **{name: plans.PLANS[name] for name in HEADLINE}}
    seconds = {}
    for name, plan in timed.items():
        start = time.perf_counter()
        run(plan(spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    recall = {
        f"{r['quantization']}{'' if not r['rescore'] else '+rescore x' + str(r['oversampling'])}": r["recall"]
        for name in ("ann_sweep", "ann_sweep_product")
        for r in plans.PLANS[name](spark, folder).collect()
    }
    swept = plans.PLANS["ann_sweep_cells"](spark, folder).where("quantization = 'none'").collect()
    cells = {str(r["probes"]): r["recall"] for r in sorted(swept, key=lambda r: r["probes"])}
    chunks, questions = ingest(spark, folder).count(), inputs.questions(spark, folder).count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "ingest_chunks_per_s": round(chunks / seconds["ingest"], 1),
                "topk_text_questions_per_s": round(questions / seconds["topk_text"], 1),
                "recall_at_10": recall,
                "recall_at_10_by_probes_of_16": cells,
            }
        )
    )


if __name__ == "__main__":
    main()
