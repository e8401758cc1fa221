"""Plan checks from ``DataFrame.explain`` output (what a Spark user reads to verify a plan)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Physical operators that mean rows leave the JVM for a Python worker.
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                "FlatMapGroupsInPandas", "PythonRDD", "MapInArrow")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df)
    return [n for n in PYTHON_NODES if n in text]


def scans_of(df: DataFrame, table: str) -> int:
    """Number of parquet scans of ``<table>.parquet`` in the physical plan."""
    text = plan_text(df)
    return len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{table}\.parquet\]", text))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan_text(df))
