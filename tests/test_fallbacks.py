"""Every join forced onto its shuffle path (no side estimated small) gives the broadcast path's answer."""

import pytest
from pyspark.sql import functions as F

from boreal.functions.text import normalized_equals
from boreal.operators import integrity as I
from boreal.operators import warehouse as W
from boreal.operators.joins import fits_broadcast, semi_join
from boreal.plans import bindings as B
from boreal.plans.inspect import plan_text
from conftest import SF_SMALL

OFF = "spark.sql.autoBroadcastJoinThreshold"


def _t(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def _key(row):
    return tuple((v is None, "" if v is None else v) for v in row)


@pytest.fixture(params=["-1"])
def every_side_too_big(spark, request):
    """No side is estimated small enough: all joins take their shuffle path."""
    old = spark.conf.get(OFF)
    spark.conf.set(OFF, request.param)
    yield
    spark.conf.set(OFF, old)


def both(spark, make):
    """The rows of a job as planned by size, and with every join shuffled."""
    old = spark.conf.get(OFF)
    plain = make().collect()
    spark.conf.set(OFF, "-1")
    try:
        shuffled = make()
        assert "SortMergeJoin" in plan_text(shuffled) and "BroadcastHashJoin" not in plan_text(shuffled)
        forced = shuffled.collect()
    finally:
        spark.conf.set(OFF, old)
    a, b = sorted(map(tuple, plain), key=_key), sorted(map(tuple, forced), key=_key)
    assert a == b and a


def test_size_estimate_follows_the_threshold(spark):
    sup = _t(spark, "supplier")
    assert fits_broadcast(sup)
    old = spark.conf.get(OFF)
    try:
        for value in ("-1", "10"):
            spark.conf.set(OFF, value)
            assert not fits_broadcast(sup)
    finally:
        spark.conf.set(OFF, old)


def test_semi_join_paths(spark):
    li, sup = _t(spark, "lineitem"), _t(spark, "supplier").where(F.col("s_nationkey") < 10)
    assert "BroadcastHashJoin" in plan_text(semi_join(li, sup, "l_suppkey", "s_suppkey"))
    both(spark, lambda: semi_join(li, sup, "l_suppkey", "s_suppkey"))


def test_join_filter_path(spark):
    li, sup = _t(spark, "lineitem"), _t(spark, "supplier")
    cond = normalized_equals("s_name", "supplier#000000007")
    both(spark, lambda: W.join_filter(li, "l_suppkey", sup, "s_suppkey", cond, ("s_name",)))


@pytest.mark.parametrize("fn", [I.fk_orphans, I.fk_set_null])
def test_integrity_paths(spark, fn):
    li, part = _t(spark, "lineitem"), _t(spark, "part").where(F.col("p_size") > 5)
    both(spark, lambda: fn(li, "l_partkey", part, "p_partkey"))


def test_star_join_path(spark):
    args = (_t(spark, "supplier"), _t(spark, "nation"), _t(spark, "lineitem"), _t(spark, "part"),
            normalized_equals("n_name", "nation_3"))
    kw = dict(supplier_id="s_suppkey", supplier_name="s_name", supplier_city="s_nationkey",
              city_id="n_nationkey", supply_supplier="l_suppkey", supply_part="l_partkey",
              supply_quantity="l_quantity", part_id="p_partkey", part_weight="p_size")
    both(spark, lambda: W.star_join_weighted_sum(*args, **kw))


LAZY = ["in_subquery", "in_subquery_distinct", "count_in_subquery", "join_filter", "manager_employee",
        "star_join_weighted_sum", "fk_orphans", "fk_set_null", "regional_monthly_mean", "kernel_regression"]


@pytest.mark.parametrize("name", LAZY)
def test_no_job_before_the_action(spark, name):
    B.QUERIES[name](spark, SF_SMALL).explain("formatted")  # reads file footers once, if ever
    tracker = spark.sparkContext.statusTracker()
    group = f"lazy-{name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = B.QUERIES[name](spark, SF_SMALL)
        plan_text(df)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_key_is_split_on_the_shuffle_path(spark):
    """A child key holding a third of all rows: AQE splits its partition in the shuffled semi join
    (no broadcast), and the answer is unchanged."""
    n = 30000
    child = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"))
    keys = spark.range(0, 1000, 2).select(F.col("id").alias("k"))
    conf = {OFF: "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = semi_join(child, keys, "k")
        got = len(out.collect())
        final = plan_text(out, "simple")  # the executed adaptive plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = sum(1 for i in range(n) if (7 if i % 3 == 0 else i % 1000) % 2 == 0)
    assert got == want
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final


@pytest.fixture(scope="module")
def small_oracle():
    from oracle_util import duck
    return duck(SF_SMALL)


ALL_QUERIES = sorted(B.QUERIES)


@pytest.mark.parametrize("name", ALL_QUERIES)
def test_every_query_on_shuffle_paths(spark, every_side_too_big, small_oracle, name):
    import __spark_entry__ as entry
    from oracle_util import compare
    df = entry.queries()[name](spark, SF_SMALL)
    assert "CartesianProduct" not in plan_text(df)
    ok, msg = compare(df, entry.oracle_sql()[name], small_oracle)
    assert ok, f"{name}: {msg}"


def _agg_below_join(text: str, first_key: str, *more: str) -> bool:
    """A partial HashAggregate keyed by ``first_key`` (and ``more``) runs below the first
    sort-merge join, i.e. rows are summed before they are shuffled for the join."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    return any(f"HashAggregate(keys=[{first_key}" in line and "partial_sum" in line
               and all(k in line for k in more) for line in lines[at:])


def test_large_forecast_pre_aggregates_before_joining_stations(spark, every_side_too_big):
    text = plan_text(B.QUERIES["kernel_regression"](spark, SF_SMALL), "simple")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    # keys: station, the day distance (a grouping expression) and the hour
    assert _agg_below_join(text, "station", "hour")


def test_large_star_join_pre_aggregates_before_parts(spark, every_side_too_big):
    text = plan_text(B.QUERIES["star_join_weighted_sum"](spark, SF_SMALL), "simple")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert _agg_below_join(text, "l_suppkey", "l_partkey", "l_quantity")


def test_large_region_list_aggregates_before_the_semi_join(spark, every_side_too_big):
    text = plan_text(B.QUERIES["regional_monthly_mean"](spark, SF_SMALL), "simple")
    assert "SortMergeJoin" in text and "LeftSemi" in text
    # keys: year and month (grouping expressions) and the station
    assert _agg_below_join(text, "_groupingexpression", "l_suppkey", "l_quantity")
