"""Layer checks: run the declared tests against built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.operators.joins import Dim
from tripmart.operators.quality import run_tests
from tripmart.plans import expectations as X
from tripmart.plans.gold import Gold


def silver_checks(silver: DataFrame, zones_bronze: Dim, broadcast_limit: int) -> DataFrame:
    return run_tests({X.SILVER: silver, "stg_zones": zones_bronze.df}, X.SILVER_TESTS,
                     parents={"stg_zones": zones_bronze}, broadcast_limit=broadcast_limit)


def gold_checks(gold: Gold, only: set[str] | None = None) -> DataFrame:
    """The gold tests, or those of the tables ``only``; ``gold.fact`` must carry ``trip_key``."""
    dims = gold.dims()
    tables = {X.FACT: gold.fact, **{k: d.df for k, d in dims.items()}}
    tests = [t for t in X.GOLD_TESTS if only is None or t.table in only]
    return run_tests(tables, tests, parents=dims, broadcast_limit=gold.params.max_broadcast_rows)


class Blocked(RuntimeError):
    """Declared tests found violations that hold back the next step; ``results`` has all test rows so far."""

    def __init__(self, results: list):
        self.results = results
        bad = [f"{r.table_name}.{r.column_name} {r.test_name}: {r.violations}" for r in results if r.violations]
        super().__init__("; ".join(bad))


def violated(results: list, tolerated: tuple, but: tuple = ()) -> bool:
    """True if a test outside ``tolerated`` and the tables ``but`` found violations."""
    return any(r.violations and (r.table_name, r.column_name, r.test_name) not in tolerated
               and r.table_name not in but for r in results)
