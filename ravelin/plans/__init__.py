"""Ready plans: every operator bound to a table folder, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def plan(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    def register(run: Plan) -> Plan:
        PLANS[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def load_all() -> None:
    from ravelin.plans import changes, corpus, knowledge, measures, ranking, vectors  # noqa: F401
