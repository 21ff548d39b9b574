"""Read a DataFrame's physical plan (``explain('formatted')``) and check its shape.

Used by the plan tests: joins against small tables broadcast, no Python UDF
node sits in a hot path, sort+limit plans as a top-k, filters and projections
reach the Parquet scan.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "FlatMapGroupsInArrow", "MapInArrow", "PythonUDF")


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def has_node(df: DataFrame, name: str) -> bool:
    return re.search(rf"\b{re.escape(name)}\b", physical_plan(df)) is not None


def python_udf_nodes(df: DataFrame) -> list[str]:
    text = physical_plan(df)
    return [n for n in _PY_NODES if n in text]


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\]", physical_plan(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)", physical_plan(df))
