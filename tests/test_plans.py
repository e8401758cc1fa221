"""Plan assertions on the registered jobs: JVM-only, pushed filters, pruned scans, broadcast semi
joins, one scan of the facts for the forecast, no Cartesian products."""

import pytest

import __spark_entry__ as entry
from boreal.operators.joins import estimated_bytes
from boreal.plans import bindings as B
from boreal.plans.inspect import plan_text, pushed_filters, python_nodes, read_schemas, scans_of
from conftest import SF_ORACLE, SF_SMALL

QUERIES = {k: f for k, f in entry.queries().items() if f.__module__ == "boreal.plans.bindings"}
SINKS = {"delimited_roundtrip", "csv_sink_roundtrip", "text_sink_roundtrip", "key_list_readings",
         "below_average_table", "delimited_rejects"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SINKS))
def test_no_python_and_no_cartesian(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert python_nodes(df) == []
    text = plan_text(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_period_filter_pushed_and_scan_pruned(spark):
    df = QUERIES["yearly_extrema"](spark, SF_SMALL)
    pf = " ".join(pushed_filters(df))
    assert "GreaterThanOrEqual(l_shipdate" in pf and "LessThan(l_shipdate" in pf
    assert read_schemas(df) == ["struct<l_extendedprice:double,l_shipdate:timestamp_ntz>"]


def test_threshold_pushed(spark):
    df = QUERIES["monthly_exceedance_count"](spark, SF_SMALL)
    assert "GreaterThan(l_quantity,10.0)" in " ".join(pushed_filters(df))
    assert read_schemas(df) == [
        "struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>"]


def test_semi_joins_are_broadcast(spark):
    for name in ("in_subquery", "regional_monthly_mean", "in_subquery_distinct"):
        text = plan_text(QUERIES[name](spark, SF_SMALL))
        assert "BroadcastHashJoin LeftSemi" in text or (
            "BroadcastHashJoin" in text and "LeftSemi" in text), name


def test_forecast_reads_facts_once(spark):
    df = QUERIES["kernel_regression"](spark, SF_SMALL)
    assert scans_of(df, "lineitem") == 1
    text = plan_text(df)
    assert "BroadcastHashJoin" in text
    # partial aggregation before the only shuffle of reading-sized data
    assert "partial_sum" in text


def test_star_join_plans(spark):
    # small dimensions: one pass over the facts, dimensions broadcast, one exchange (on the name)
    df = QUERIES["star_join_weighted_sum"](spark, SF_SMALL)
    text = plan_text(df, "simple")
    assert scans_of(df, "lineitem") == 1
    fact_side = text.split("BroadcastExchange")[0]  # the plan above the first broadcast input
    assert fact_side.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(name" in fact_side
    # sides too large: the facts are summed per (supplier, part) before any join
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(QUERIES["star_join_weighted_sum"](spark, SF_SMALL), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "partial_sum(l_quantity" in text


@pytest.mark.parametrize("name, join", [("fk_orphans", "LeftAnti"), ("fk_set_null", "LeftOuter")])
def test_integrity_reads_each_side_once(spark, name, join):
    df = QUERIES[name](spark, SF_SMALL)
    text = plan_text(df)
    assert join in text and "BroadcastHashJoin" in text
    assert scans_of(df, "part") == 1 and scans_of(df, "lineitem") == 1


def test_aggregated_sides_join_without_extra_exchange(spark):
    # Too large to broadcast: the sort-merge join reuses the hash partitioning of the aggregates.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(QUERIES["extremes_total_band_join"](spark, SF_SMALL), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 2  # one per aggregate, none for the join


def test_semi_join_reads_each_side_once(spark):
    df = QUERIES["in_subquery_distinct"](spark, SF_ORACLE)
    assert "LeftSemi" in plan_text(df)
    assert scans_of(df, "lineitem") == 1 and scans_of(df, "part") == 1
    assert scans_of(QUERIES["manager_employee"](spark, SF_ORACLE), "supplier") == 2


@pytest.fixture()
def threshold(spark):
    """Sets Catalyst's broadcast threshold for one test."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    yield lambda value: spark.conf.set(key, str(value))
    spark.conf.set(key, old)


def exchanged(text: str) -> list[str]:
    return [line.strip() for line in text.splitlines() if "Exchange " in line]


@pytest.mark.parametrize("name, join", [("fk_orphans", "LeftSemi"), ("fk_set_null", "LeftOuter")])
def test_child_rows_stay_where_orphan_keys_fit_a_broadcast(spark, threshold, name, join):
    """Parent keys too large to broadcast, orphan keys not: the child rows meet the staged orphans, nothing is shuffled."""
    parents = B._parents(spark, SF_SMALL).select("p_partkey")
    threshold(estimated_bytes(parents.distinct()) - 1)
    df = QUERIES[name](spark, SF_SMALL)
    text = plan_text(df, "simple")
    assert "BroadcastHashJoin" in text and join in text and "orphan-keys" in plan_text(df)
    assert exchanged(text) == [] or all("BroadcastExchange" in x for x in exchanged(text))
    assert scans_of(df, "part") == 0 and scans_of(df, "lineitem") == 1


@pytest.mark.parametrize("name, join", [("fk_orphans", "LeftSemi"), ("fk_set_null", "LeftOuter")])
def test_child_rows_are_shuffled_once_at_most(spark, threshold, name, join):
    threshold(-1)
    text = plan_text(QUERIES[name](spark, SF_SMALL), "simple")
    assert "SortMergeJoin" in text and join in text
    assert len(exchanged(text)) == 2  # child rows and orphan keys, once each


def test_theta_join_shuffles_staged_values_only(spark):
    """The table is scanned for the rows of the result; its distinct values come from a written table."""
    df = QUERIES["theta_self_join"](spark, SF_SMALL)
    assert scans_of(df, "part") == 1 and "theta-ranges" in plan_text(df) and "rangepartitioning" not in plan_text(df)
