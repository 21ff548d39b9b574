"""Query registry: ``@query(name, oracle=SQL)`` registers a (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabulon.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def sround(expr: str, d: int) -> str:
    """DuckDB text reproducing Spark's ``round(x, d)`` on doubles.

    Spark rounds HALF_UP the shortest decimal text of the double (2.675 -> 2.68);
    DuckDB rounds the binary value (2.675 -> 2.67). Going through that text and an
    exact decimal gives Spark's result.
    """
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,18)), {d}) as double)"
