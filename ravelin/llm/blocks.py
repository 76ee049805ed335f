"""A stated query set against all rows: blocks of queries meet blocks of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ravelin.llm.common import temp

#: Query blocks of this many bytes in all are broadcast; beyond it they meet the row blocks by a shuffle.
BROADCAST_BYTES = 32 << 20

_SALT = temp("salt")


def dealt(queries: DataFrame, size: int, key: str) -> tuple[DataFrame, int]:
    """`queries` with a `cell` of about `size` rows, dealt by the hash of the unique `key`, and the number of cells."""
    cells = max(1, -(-queries.count() // size))
    return queries.withColumn("cell", F.pmod(F.xxhash64(key), F.lit(cells)).cast("long")), cells


def meeting(rows: DataFrame, queries: DataFrame, cells: int, payload: str, salt: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row (a block) with the one row of `queries` of each `cell` 0 .. cells - 1.

    The column `payload`, the bytes of a query block, is added up first. Within the bound the query blocks are broadcast
    and the rows stay where they are; beyond it both are dealt over (cell, salt), where a row's salt is the hash of its
    column `salt`, so that every cell spreads over as many tasks as there are salts.
    """
    spread = rows.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
    size = queries.agg(F.sum(payload)).first()[0] or 0
    if size <= broadcast_bytes:
        return spread.join(F.broadcast(queries), "cell")
    salts = max(1, rows.count() // 4)
    spread = spread.withColumn(_SALT, F.pmod(F.xxhash64(salt), F.lit(salts)).cast("long"))
    copies = queries.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return spread.join(copies, ["cell", _SALT]).drop(_SALT)
