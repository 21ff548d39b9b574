"""Operators for training-data pipelines, and their registered queries."""

from tabulon.llm.catalog import oracle_sql, queries  # noqa: F401
