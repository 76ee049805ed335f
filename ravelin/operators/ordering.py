"""Exact positions and quantiles that never gather a whole key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ravelin.session import broadcast_if_small, checkpointed

SKETCH_ACCURACY = 10_000
BRACKET_FROM = 100_000


def cumulated(df: DataFrame, order: Sequence[str], keys: Sequence[str], weight: Column, name: str) -> DataFrame:
    """Running sum of `weight` in `order` within `keys`.

    The rows are range-partitioned once and stored, so the partition of each row is fixed; every
    partition is summed on its own and shifted by the sum of its key in the partitions before it.
    A key of any size is spread over as many partitions as its rows fill.
    """
    keys, order = list(keys), list(order)
    placed = checkpointed(
        df.withColumn("_weight", weight)
        .repartitionByRange(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    sums = placed.groupBy(*keys, "_part").agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("_local", F.sum("_weight").over(inside))
    return (
        local.join(broadcast_if_small(shifts), [*keys, "_part"])
        .withColumn(name, F.col("_local") + F.col("_shift"))
        .drop("_part", "_local", "_shift", "_weight")
    )


def numbered(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "pos") -> DataFrame:
    """Positions from 1 in `order` within `keys`; `order` must be a total order."""
    return cumulated(df, order, keys, F.lit(1).cast("bigint"), name)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], bracket_from: int = BRACKET_FROM
) -> DataFrame:
    """Linearly interpolated quantiles `q0, q1, …` and the count `n` of values per key; nulls and NaN are left out.

    A sketch brackets every wanted rank; a counting pass fixes how many rows lie below each bracket,
    and only the values inside a bracket, reduced to (value, count), are put in order. Keys with fewer
    than `bracket_from` rows, where a bracket would be no wider than a few ranks, are ordered whole.
    """
    qs = list(qs)
    keys = list(keys) or ["_all"]
    rows = df.withColumn("_all", F.lit(0)).select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    slack = 3.0 / SKETCH_ACCURACY
    bounds = [max(0.0, q - slack) for q in qs] + [min(1.0, q + slack) for q in qs]
    sketch = broadcast_if_small(
        rows.groupBy(*keys).agg(
            F.count("*").alias("n"),
            F.percentile_approx("_v", F.array(*[F.lit(b) for b in bounds]), SKETCH_ACCURACY).alias("_b"),
        )
    )
    bounded = F.col("n") >= bracket_from
    low = [F.when(bounded, F.col("_b")[i]).otherwise(F.lit(float("-inf"))) for i in range(len(qs))]
    high = [F.when(bounded, F.col("_b")[len(qs) + i]).otherwise(F.lit(float("inf"))) for i in range(len(qs))]
    inside = F.lit(False)
    for lo, hi in zip(low, high):
        inside = inside | F.col("_v").between(lo, hi)
    joined = rows.join(sketch, keys).withColumn("_in", inside)
    below = joined.groupBy(*keys).agg(
        *[F.count_if(~F.col("_in") & (F.col("_v") < lo)).alias(f"_below{i}") for i, lo in enumerate(low)]
    )
    values = joined.where("_in").groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    ordered = cumulated(values, ["_v"], keys, F.col("_c"), "_upto")
    ordered = ordered.join(sketch, keys).join(broadcast_if_small(below), keys)
    picks, results = [], []
    for i, q in enumerate(qs):
        spot = F.lit(q) * (F.col("n") - 1)
        end = F.col("_upto") + F.col(f"_below{i}")
        near = F.col("_v").between(low[i], high[i])
        for side, rank in (("l", F.floor(spot)), ("h", F.ceil(spot))):
            hit = near & (rank >= end - F.col("_c")) & (rank < end)
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}{i}"))
        between = F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (spot - F.floor(spot))
        lost = F.raise_error(F.lit("quantile fell outside its bracket")).cast("double")
        results.append(F.when(F.col(f"_l{i}").isNotNull() & F.col(f"_h{i}").isNotNull(), between).otherwise(lost).alias(f"q{i}"))
    picked = ordered.groupBy(*keys, "n").agg(*picks)
    return picked.select(*[k for k in keys if k != "_all"], "n", *results)
