"""Registered queries (one per operator of the survey inventory) and DuckDB oracles."""

from tabulon.catalog.registry import ORACLES, QUERIES
from tabulon.catalog import tour, profiling, features, modeling  # noqa: F401
from tabulon.catalog.modeling import flagship  # noqa: F401  (registration side effects)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)

