"""All queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.plans import dashboards, diner, pizza, retail, subs
from tallyloom.plans.present import present
from tallyloom.session import tune
from tallyloom.sources.fixtures import Fixtures

MODULES = (diner, pizza, subs, retail, dashboards)
QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {name: plan for m in MODULES for name, plan in m.QUERIES.items()}
ORACLE: dict[str, str] = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}


def runner(plan: Callable[[Fixtures], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(plan(Fixtures(tune(spark), sf_dir)))

    return run
