"""Registry of the reports the driver runs: Spark plan + independent SQL oracle.

Each report builds its inputs from the driver tables (``sources.fixtures``)
and calls a library operator. Its oracle is written separately, in the
reference's own SQL form (self-joins, ``NOT IN``, ``TOP``), over the same
relations as DuckDB CTEs, so the comparison checks the operator rather than
repeating it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dbtelemetry.sources.fixtures import Relations, with_relations


@dataclass(frozen=True)
class Report:
    name: str
    build: Callable[[Relations], DataFrame]
    relations: tuple[str, ...]
    oracle_body: str | None
    doc: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Relations(spark, sf_dir))

    def oracle(self) -> str | None:
        if self.oracle_body is None:
            return None
        return with_relations(self.relations, self.oracle_body)


REPORTS: dict[str, Report] = {}


def report(name: str, relations: tuple[str, ...], oracle: str | None):
    """Register ``fn(rel) -> DataFrame`` under ``name`` with its oracle SQL body."""

    def deco(fn):
        if name in REPORTS:
            raise ValueError(f"duplicate report {name}")
        REPORTS[name] = Report(name, fn, tuple(relations), oracle, (fn.__doc__ or "").strip())
        return fn

    return deco
