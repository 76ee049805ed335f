"""Every registered plan on the smallest tables against its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry
from ravelin import plans
from check import rows_of

FOLDER = "/root/testdata/sf0.001"
# Product codes and cells are learned, so only their rows are counted here; recall floors are in test_search.
LEARNED = {"product_quantize", "quantized_topk_product", "rescored_topk_product", "ann_topk", "ann_topk_lists", "ann_sweep_cells", "ann_sweep_product"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def test_every_plan_without_sql_is_a_learned_one():
    assert set(plans.PLANS) - set(plans.ORACLES) == LEARNED
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(plans.PLANS))
def test_plan(spark, db, name):
    df = registry.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name in LEARNED:
        assert got[1]
        return
    result = db.execute(registry.oracle_sql()[name])
    assert got == rows_of([c[0] for c in result.description], result.fetchall())
