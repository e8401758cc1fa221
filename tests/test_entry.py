"""The driver contract of ``__spark_entry__``: entry, queries, oracle_sql."""

import inspect

from pyspark.sql import DataFrame

import __spark_entry__ as entry


def test_entry_schema_is_stable(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert isinstance(a, DataFrame)
    assert a.schema == b.schema
    assert [f.name for f in a.schema] == ["hour", "forecast_sum", "forecast_prod"]
    assert a.count() == 11


def test_queries_and_oracles_line_up():
    q, o = entry.queries(), entry.oracle_sql()
    assert q and set(o) <= set(q)
    for name, fn in q.items():
        assert len(inspect.signature(fn).parameters) == 2, name
        if fn.__module__ == "boreal.plans.bindings":
            assert o[name].strip(), name


def test_every_query_returns_a_dataframe(spark):
    from conftest import SF_SMALL
    for name, fn in entry.queries().items():
        if fn.__module__ != "boreal.plans.bindings":
            continue
        df = fn(spark, SF_SMALL)
        assert isinstance(df, DataFrame), name
        assert len(df.columns) == len(set(c.lower() for c in df.columns)), name
