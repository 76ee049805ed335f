"""A hashed key filter: what an exact join shuffles follows the keys asked for, not the table they are looked up in."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ravelin.session import BROADCAST_ROWS

# Task functions travel by value, so executors need numpy and Arrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bits of a filter for each wanted row, and at most (32 MB); with more keys than that allows more rows reach the exact join.
KEY_BITS, MOST_BITS = 64, 1 << 28


def sifted(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """`rows` without most of those whose key no row of `wanted` has; an exact join must follow.

    `wanted` must be stored. Where that join can broadcast them, nothing is left out before it.
    """
    kind, n = rows.schema[key].dataType, wanted.count()
    if n <= BROADCAST_ROWS or kind != wanted.schema[key].dataType or not isinstance(kind, (StringType, IntegralType)):
        return rows  # keys of other types may be equal and yet have other hashes
    bits = min(MOST_BITS, 1 << (KEY_BITS * n - 1).bit_length())
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    set_bit = F.expr("shiftleft(1L, cast(_at & 63 as int))")
    words = wanted.select(place.alias("_at")).groupBy(F.shiftright("_at", 6).alias("word")).agg(F.bit_or(set_bit).alias("bits")).toArrow()
    filled = np.zeros(bits // 64, np.uint64)
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(filled)

    @F.arrow_udf("boolean")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for places in batches:
            at = places.to_numpy(zero_copy_only=False).astype(np.uint64)
            yield pa.array((known[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool))

    return rows.where(held.asNondeterministic()(place))  # or Spark would look up the keys of the join's other side too
