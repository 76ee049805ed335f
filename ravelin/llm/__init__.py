"""Operators for preparing training text, and their queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Query name and the module whose `query(spark, folder)` runs it; a module's ORACLE is its SQL where SQL can express it.
MODULES = {
    "op1_quality_classifier": "quality_classifier",
    "op2_packing": "packing",
    "op3_bpe": "bpe",
    "op4_pii": "pii",
    "op5_simhash": "simhash",
    "op6_secrets": "secrets",
    "op7_licenses": "licenses",
    "op8_quality_rules": "quality_rules",
    "op9_near_dedup": "near_dedup",
    "op10_url_filter": "url_filter",
    "op11_ranked_search": "ranked_search",
    "op12_simhash_dedup": "hamming_dedup",
    "op13_hard_negatives": "hard_negatives",
}


def _module(name: str):
    return import_module(f"{__name__}.{MODULES[name]}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _module(name).query for name in MODULES}


def oracles() -> dict[str, str]:
    return {name: sql for name in MODULES if (sql := getattr(_module(name), "ORACLE", None))}
